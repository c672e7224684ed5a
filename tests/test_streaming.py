from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacewise.functions.measures import day
from pacewise.operators import clean
from pacewise.operators.conformed import daily_metrics_by_key
from pacewise.sources import schemas as S
from pacewise.streaming import ingest as I

PERF = "date,ad_set_id,ad_set_name,impressions,clicks,spend,ctr,cpm,frequency"
CONV = "conversion_id,date,ad_set_id,conversion_type,value,attribution_window,user_segment"
BUDGET = "date,ad_set_id,planned_spend,actual_spend,budget_utilization,pacing_status"


@pytest.fixture
def stream(tmp_path):
    for table, head in ((S.PERFORMANCE, PERF), (S.BUDGET, BUDGET), (S.CONVERSIONS, CONV)):
        export(tmp_path, table, "0", head, [])
    return I.Stream(str(tmp_path / "exports"), str(tmp_path / "layers"), late_after="2 days")


def export(tmp_path, table, name, head, lines):
    folder = tmp_path / "exports" / table / f"export={name}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.csv").write_text("\n".join([head, *lines]) + "\n")


def spend(spark, stream):
    rows = I.silver(spark, stream, S.PERFORMANCE).collect()
    return sorted((str(r.date), r.ad_set_id, r.clicks, r.spend) for r in rows)


def p(d, ad, clicks, amount):
    return f"{d:02}/08/2024,{ad},n,100,{clicks},{amount},1,1,1"


def test_late_repeated_and_corrected_rows(spark, stream, tmp_path):
    export(tmp_path, S.PERFORMANCE, "1", PERF, [p(1, "A", 1, 10), p(1, "A", 2, 20), p(2, "B", 3, 30), p(9, "C", 1, 1)])
    export(tmp_path, S.CONVERSIONS, "1", CONV, ["C1,01/08/2024,A,booking_completed,300,1_day_click,x"])
    first = I.ingest(spark, stream)
    assert first["days"] == 3
    assert spend(spark, stream) == [
        ("2024-08-01", "A", 1, 10.0), ("2024-08-01", "A", 2, 20.0), ("2024-08-02", "B", 3, 30.0), ("2024-08-09", "C", 1, 1.0),
    ]
    # A is corrected to one row, B is repeated, D comes late, E is new.
    export(tmp_path, S.PERFORMANCE, "2", PERF, [p(1, "A", 5, 50), p(2, "B", 3, 30), p(2, "B", 3, 30), p(2, "D", 4, 40), p(10, "E", 1, 2)])
    second = I.ingest(spark, stream)
    assert second["days"] == 3 and second[S.CONVERSIONS] == 0
    want = [
        ("2024-08-01", "A", 5, 50.0), ("2024-08-02", "B", 3, 30.0), ("2024-08-02", "D", 4, 40.0),
        ("2024-08-09", "C", 1, 1.0), ("2024-08-10", "E", 1, 2.0),
    ]
    assert spend(spark, stream) == want
    gold = {(str(r.date), r.ad_set_id): r for r in I.gold(spark, stream).collect()}
    assert gold["2024-08-01", "A"].revenue == 300.0 and gold["2024-08-01", "A"].roas == 6.0
    assert len(gold) == 5
    third = I.ingest(spark, stream)
    assert not any(third.values()) and spend(spark, stream) == want
    # Days are closed when rows later by two days have come; D was too late for that count.
    closed = {(str(r.date), r.rows, r.last_export) for r in I.closed_days(spark, stream).collect()}
    assert closed == {("2024-08-01", 2, "1"), ("2024-08-02", 1, "1")}


def test_the_outcome_does_not_depend_on_batches(spark, stream, tmp_path):
    """Exports one by one, all at once, and in the wrong order end up the same."""
    exports = {
        str(n): [p(d, ad, n, 10 * n + i) for i, (d, ad) in enumerate([(1, "A"), (2, "A"), (n, "B"), (4, "")])]
        for n in (1, 2, 3)
    }
    for name, lines in exports.items():
        export(tmp_path, S.PERFORMANCE, name, PERF, lines)
    I.ingest(spark, stream)
    once = spend(spark, stream)
    outcomes = []
    for k, order in enumerate((("1", "2", "3"), ("3", "1", "2"))):
        root = tmp_path / f"other{k}"
        for table, head in ((S.PERFORMANCE, PERF), (S.BUDGET, BUDGET), (S.CONVERSIONS, CONV)):
            export(root, table, "0", head, [])
        other = I.Stream(str(root / "exports"), str(root / "layers"), files_per_batch=1)
        for name in order:
            export(root, S.PERFORMANCE, name, PERF, exports[name])
            I._run_stream(spark, other, S.PERFORMANCE)
        outcomes.append(spend(spark, other))
    assert outcomes == [once, once]
    assert [r for r in once if r[1] == "A"] == [("2024-08-01", "A", 3, 30.0), ("2024-08-02", "A", 3, 31.0)]


def test_a_batch_that_failed_is_finished(spark, stream, tmp_path, monkeypatch):
    export(tmp_path, S.PERFORMANCE, "1", PERF, [p(1, "A", 1, 10), p(2, "A", 1, 20)])
    I._run_stream(spark, stream, S.PERFORMANCE)
    export(tmp_path, S.PERFORMANCE, "2", PERF, [p(2, "A", 2, 99), p(3, "A", 3, 30)])
    whole = I._overwrite_days

    def fails(df, path):
        # The day that the batch merges is gone, as between removing and moving files.
        whole(df.where(F.col("date") == dt.date(2024, 8, 2)).withColumn("spend", F.lit(-1.0)), path)
        raise OSError("lost")

    monkeypatch.setattr(I, "_overwrite_days", fails)
    with pytest.raises(Exception, match="lost"):
        I._run_stream(spark, stream, S.PERFORMANCE)
    monkeypatch.setattr(I, "_overwrite_days", whole)
    I._run_stream(spark, stream, S.PERFORMANCE)
    assert spend(spark, stream) == [("2024-08-01", "A", 1, 10.0), ("2024-08-02", "A", 2, 99.0), ("2024-08-03", "A", 3, 30.0)]


def test_bad_dates_are_kept_apart_and_layers_equal_a_batch_run(spark, stream, tmp_path):
    lines = ["2024-08-01,A,10,5,0.5,on_pace", "02/08/2024,A,10,5,0.5,On_Pace", "02/08/2024,,1,1,1,x"]
    export(tmp_path, S.BUDGET, "1", BUDGET, lines)
    export(tmp_path, S.CONVERSIONS, "1", CONV, ["C1,02/08/2024,A,booking_completed,7,1_day_click,x", "C2,,A,x,1,y,z"])
    I.ingest(spark, stream)
    bad = spark.read.parquet(stream.path("rejects", S.BUDGET)).collect()
    assert [(r.date, r.export) for r in bad] == [("2024-08-01", "1")]
    raw = {
        t: spark.read.schema(S.raw_schema(t)).csv(f"{stream.source}/{t}", header=True).drop("export").withColumn(S.DATE, day(S.DATE))
        for t in I.CLEANERS
    }
    silver = [I.CLEANERS[t](raw[t]) for t in I.CLEANERS]
    for table, want in zip(I.CLEANERS, silver):
        got = I.silver(spark, stream, table)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    daily = daily_metrics_by_key(*silver)
    assert sorted(map(str, I.gold(spark, stream).collect())) == sorted(map(str, daily.collect()))
    assert clean.clean_budget in I.CLEANERS.values()


def test_nothing_to_read(spark, stream):
    counts = I.ingest(spark, stream)
    assert counts["days"] == 0 and I.gold(spark, stream).count() == 0
    assert I.silver(spark, stream, S.PERFORMANCE).count() == 0 and I.closed_days(spark, stream).count() == 0
