from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from pacewise.functions.measures import day
from pacewise.operators import changes, clean, rolled
from pacewise.operators.conformed import daily_metrics
from pacewise.plans import incremental
from pacewise.sources import schemas as S
from pacewise.sources import tables as T
from tests.samples import write


def d(n):
    return dt.date(2024, 8, n)


@pytest.fixture
def layers(spark):
    names = [f"{x}_{uuid.uuid4().hex[:8]}" for x in ("bronze", "silver", "gold")]
    T.ensure_layers(spark, names)
    return names


def test_changed_days(spark):
    rows = [(d(1), 1), (d(1), 2), (d(2), 3), (None, 4), (d(3), 5)]
    old = changes.fingerprints(spark.createDataFrame(rows, "date date, x int"))

    def changed(new):
        return changes.changed_days(old, changes.fingerprints(spark.createDataFrame(new, "date date, x int")))

    assert changed(list(reversed(rows))) == []
    assert changed([*rows, (d(1), 2)]) == [d(1)]
    assert changed(rows[1:]) == [d(1)] and changed(rows[:-1]) == [d(3)]
    assert changed([*rows, (d(9), 1)]) == [d(9)] and changed([(None, 5), *rows[:3], rows[4]]) == [None]
    assert changed([(d(1), 1), (d(1), 3), (d(2), 2), (None, 4), (d(3), 5)]) == [d(1), d(2)]
    assert changes.changed_days(old.limit(0), old) == [d(1), d(2), d(3), None]


def test_reach(spark):
    assert changes.days_before([d(9), None], 2) == [d(7), d(8), d(9), None]
    was = spark.createDataFrame([("A", d(1)), ("A", d(5)), ("B", d(4)), (None, d(2))], "ad_set_id string, date date")
    now = spark.createDataFrame([("A", d(1)), ("B", d(4)), ("B", d(6)), (None, d(7))], "ad_set_id string, date date")
    # A's last row goes, B and the nameless get one.
    assert changes.days_of_previous_rows([d(5), d(6), d(7)], was, now) == [d(1), d(2), d(4), d(5), d(6), d(7)]
    assert changes.days_of_previous_rows([], was) == []


def test_days_are_replaced_alone(spark, layers):
    name = f"{layers[2]}.t"
    base = [(1, d(1)), (2, d(2)), (3, None), (4, d(4))]
    T.replace_days(spark.createDataFrame(base, "x int, date date"), name, [])
    part = {r.date: r.f for r in spark.table(name).select("date", F.input_file_name().alias("f")).collect()}
    new = spark.createDataFrame([(20, d(2)), (21, d(2))], "x int, date date")
    assert T.replace_days(new, name, [d(2), None, d(4)]) == 2
    after = spark.table(name)
    assert sorted((r.x, r.date) for r in after.collect()) == [(1, d(1)), (20, d(2)), (21, d(2))]
    assert after.where("x = 1").select(F.input_file_name()).first()[0] == part[d(1)]
    # A frame that reads the table can replace its days.
    doubled = T.on_days(spark.table(name), [d(2)]).withColumn("x", F.col("x") * 2)
    T.replace_days(doubled, name, [d(2)])
    assert sorted(r.x for r in spark.table(name).collect()) == [1, 40, 42]


def test_a_swapped_table_is_never_missing(spark, layers):
    name = f"{layers[2]}.report"
    for n in range(1, 5):
        assert T.swap_table(spark.range(n), name) == n
        held = spark.table(name)
        assert held.count() == n and T.table_exists(spark, name)
    versions = [t.name for t in spark.catalog.listTables(layers[2]) if "__v" in t.name]
    assert sorted(versions) == ["report__v3", "report__v4"]
    assert held.count() == 4


def expected(spark, paths):
    raw = {
        t: spark.read.schema(S.raw_schema(t)).option("header", True).csv(paths[t]).withColumn(S.DATE, day(S.DATE))
        for t in incremental.CLEANERS
    }
    typed = {t: incremental._typed(raw[t], t) for t in raw}
    silver = [incremental.CLEANERS[t](raw[t]) for t in raw]
    pacing = typed[S.BUDGET].select(S.AD_SET, S.DATE, F.col("budget_utilization").alias("pacing_ratio"))
    return {
        incremental.DAILY: daily_metrics(*silver),
        incremental.COUNTS: rolled.conversions_7d(
            rolled.performance_by_day(typed[S.PERFORMANCE]), rolled.conversion_days(typed[S.CONVERSIONS])
        ),
        incremental.PACING: rolled.adset_pacing(pacing),
    }


def same(a, b):
    columns = sorted(b.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_an_update_equals_a_full_run_and_touches_what_it_must(spark, layers, tmp_path):
    paths = write(tmp_path)
    run = incremental.Run(paths, *layers)
    first = incremental.update(spark, run)
    assert first["gold.daily_metrics"]
    for name, want in expected(spark, paths).items():
        assert same(spark.table(f"{run.gold}.{name}"), want), name
    assert incremental.update(spark, run) == {}
    # One conversion changes, one budget row comes late, a day of performance goes.
    for table, was, now in (
        (S.CONVERSIONS, "C6,09/08/2024,A1,booking_completed,55", "C6,09/08/2024,A1,booking_completed,56"),
        (S.BUDGET, "05/08/2024,A1,200,10,0.05,weird", "05/08/2024,A1,200,10,0.05,weird\n04/08/2024,A2,1,1,0.5,on_pace"),
        (S.PERFORMANCE, "04/08/2024,A3,Three,400.0,4,10.0,1.0,1.0,1.0\n", ""),
    ):
        with open(paths[table]) as f:
            text = f.read()
        assert was in text
        with open(paths[table], "w") as f:
            f.write(text.replace(was, now))
    files = {r[0] for r in spark.table(f"{run.gold}.daily_metrics").select(F.input_file_name()).collect()}
    second = incremental.update(spark, run)
    assert second["bronze.conversion_events"] == [d(9)] and second["bronze.budget_pacing"] == [d(4)]
    assert second["silver.meta_campaign_performance"] == [d(4)]
    assert second["gold.daily_metrics"] == [d(4), d(9)]
    assert second["gold.conversions_7d"] == [d(2), d(3), d(4), d(5), d(6), d(7), d(8), d(9)]
    assert second["gold.pacing"] == [d(2), d(4)]  # A2's row before is of the second
    for name, want in expected(spark, paths).items():
        assert same(spark.table(f"{run.gold}.{name}"), want), name
    kept = {r[0] for r in spark.table(f"{run.gold}.daily_metrics").select(F.input_file_name()).collect()}
    assert len(files & kept) >= len(files) - 2
    assert clean.clean_performance is incremental.CLEANERS[S.PERFORMANCE] and os.path.exists(paths[S.BUDGET])
