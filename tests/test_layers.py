from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from pacewise import session
from pacewise.functions.measures import day
from pacewise.operators import clean, conformed, quality, ranks, rolled, skew, split
from pacewise.operators import windows as win
from pacewise.sources import readers, schemas as S
from samples import write


def d(n: int) -> dt.date:
    return dt.date(2024, 8, n)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    paths = write(tmp_path_factory.mktemp("raw"))
    return {t: readers.read_strict(spark, p, t) for t, p in paths.items()}


@pytest.fixture(scope="module")
def silver(raw):
    dated = {t: df.withColumn("date", day("date")) for t, df in raw.items() if "date" in df.columns}
    return (
        clean.clean_performance(dated[S.PERFORMANCE]),
        clean.clean_budget(dated[S.BUDGET]),
        clean.clean_conversions(dated[S.CONVERSIONS]),
    )


@pytest.fixture(scope="module")
def bronze(raw):
    return {t: readers.cast_table(df, t) for t, df in raw.items()}


def test_performance_is_cleaned(silver):
    rows = silver[0].collect()
    assert len(rows) == 7  # the copy and the row without an ad set are gone
    by = {(r["date"], r["ad_set_id"], r["impressions"]): r for r in rows}
    assert by[(d(1), "A2", 2000)]["spend"] == 0.0
    assert by[(d(1), "A1", 1000)]["ctr"] == pytest.approx(2.0)
    assert by[(d(1), "A1", 1000)]["cpm"] == pytest.approx(100.0)
    assert by[(d(2), "A1", None)]["ctr"] == 3.5  # nothing to recompute from
    assert by[(d(2), "A2", 0)]["cpm"] == 0.6
    assert by[(d(3), "A1", 800)]["ctr"] is None  # clicks unknown


def test_budget_and_conversions_are_cleaned(silver):
    _, budget, conversions = silver
    status = {(r["date"], r["ad_set_id"]): r["pacing_status"] for r in budget.collect()}
    assert status[(d(1), "A1")] == "under_pacing"
    assert status[(d(3), "A1")] == status[(d(5), "A1")] == "unknown"
    rows = {r["conversion_id"]: r for r in conversions.collect()}
    assert len(rows) == conversions.count() == 7
    assert rows["C2"]["value"] == 0.0 and rows["C5"]["value"] == 0.0
    assert rows["C2"]["conversion_type"] == "booking_completed"
    assert rows["C2"]["attribution_window"] == "7_day_click"


@pytest.mark.parametrize("hot", [{}, {"rows_per_part": 0.5}])
def test_daily_metrics_join_every_row(silver, hot):
    rows = conformed.daily_metrics(*silver, **hot).collect()
    keys = sorted((str(r["date"]), r["ad_set_id"] or "") for r in rows)
    assert keys == sorted(
        [
            ("2024-08-01", "A1"), ("2024-08-01", "A2"),
            ("2024-08-02", "A1"), ("2024-08-02", "A1"), ("2024-08-02", "A2"),
            ("2024-08-02", "A4"), ("2024-08-03", "A1"), ("2024-08-04", "A3"),
            ("2024-08-05", "A1"), ("2024-08-06", ""), ("2024-08-07", ""),
            ("2024-08-08", "A1"), ("2024-08-09", "A1"),
        ]
    )
    by = {(r["date"], r["ad_set_id"], r["spend"]): r for r in rows}
    first = by[(d(1), "A1", 100.0)]
    assert (first["revenue"], first["bookings"], first["soft_conversions"]) == (300.0, 2, 1)
    assert first["roas"] == pytest.approx(3.0) and first["cpa"] == pytest.approx(50.0)
    # both rows of the repeated key carry the key's totals
    assert {by[(d(2), "A1", s)]["revenue"] for s in (40.0, 20.0)} == {80.0}
    only_conversions = by[(d(2), "A4", 0.0)]
    assert only_conversions["pacing_status"] == "unknown" and only_conversions["roas"] is None
    assert by[(d(1), "A2", 0.0)]["roas"] is None and by[(d(1), "A2", 0.0)]["cpa"] is None


def test_daily_metrics_by_key_count_nothing_twice(silver):
    df = conformed.daily_metrics_by_key(*silver)
    quality.require_unique(df, S.KEYS, "daily")
    row = df.filter("date = '2024-08-02' AND ad_set_id = 'A1'").first()
    assert (row["spend"], row["revenue"], row["bookings"]) == (60.0, 80.0, 1)


def test_training_set_encodes_the_status(silver):
    rows = conformed.training_set(conformed.daily_metrics(*silver)).collect()
    index = {(r["date"], r["ad_set_id"]): r["pacing_status_idx"] for r in rows}
    assert index[(d(1), "A1")] == 0 and index[(d(1), "A2")] == 1
    assert index[(d(2), "A2")] == 2 and index[(d(5), "A1")] == 3


def test_rolled_performance_sums_copies(bronze):
    rows = {(r["date"], r["ad_set_id"]): r for r in rolled.performance_by_day(bronze[S.PERFORMANCE]).collect()}
    row = rows[(d(2), "A1")]
    assert (row["impressions"], row["spend"]) == (1000, 100.0)
    assert row["ctr"] == pytest.approx((1.0 + 1.0 + 3.5) / 3)
    assert rows[(d(1), "A2")]["spend"] == 0.0


def test_silver_daily_has_unique_keys_and_consistent_roas(bronze):
    df = rolled.silver_daily(
        rolled.performance_by_day(bronze[S.PERFORMANCE]),
        rolled.revenue_by_day(bronze[S.CONVERSIONS]),
    )
    assert quality.key_duplicates(df, rolled.BY_AD_SET).isEmpty()
    assert df.filter("spend > 0 AND abs(revenue / spend - roas) > 1e-6").isEmpty()
    assert {r["roas"] for r in df.filter("spend <= 0").collect()} == {0.0}


def test_forward_count_is_inclusive_and_agrees_with_the_interval_join(bronze):
    performance = rolled.performance_by_day(bronze[S.PERFORMANCE])
    events = rolled.conversion_days(bronze[S.CONVERSIONS])
    window = rolled.conversions_7d(performance, events)
    joined = win.forward_count_join(performance, events, "conv_date")
    columns = ["ad_set_id", "date", "conv_7d"]
    assert window.select(columns).exceptAll(joined.select(columns)).isEmpty()
    assert joined.select(columns).exceptAll(window.select(columns)).isEmpty()
    counts = {(r["ad_set_id"], r["date"]): r["conv_7d"] for r in window.collect()}
    assert counts[("A1", d(1))] == 6  # up to and including 8 August
    assert counts[("A1", d(2))] == 4  # both copies, 8 and 9 August
    assert counts[("A3", d(4))] == 0
    assert counts[(None, d(3))] == 0


def test_next_row_value_skips_days_without_rows(spark):
    df = spark.createDataFrame(
        [("A", d(1), 0.1), ("A", d(2), 0.2), ("A", d(5), 0.5), ("B", d(1), 1.0)],
        "ad_set_id string, date date, ratio double",
    )
    got = {(r["ad_set_id"], r["date"]): r["next_ratio"] for r in win.next_row_value(df, "ratio").collect()}
    assert got == {("A", d(1)): 0.2, ("A", d(2)): 0.5, ("A", d(5)): None, ("B", d(1)): None}


@pytest.mark.parametrize("step", [2, 100_000])
def test_next_row_value_forms_one_chain_through_ties_and_copies(spark, step):
    rows = [("A", d(1), 0.1)] * 7 + [("A", d(1), 0.7), ("A", d(2), 0.3), ("A", d(2), 0.3), ("A", d(4), None)]
    df = spark.createDataFrame(rows, "ad_set_id string, date date, ratio double")
    out = win.next_row_value(df, "ratio", copies_per_row=step).collect()
    assert len(out) == len(rows)
    # every value but the chain's first is somebody's next value
    left = sorted((r["ratio"] for r in out if r["ratio"] is not None))
    following = [r["next_ratio"] for r in out if r["next_ratio"] is not None]
    for value in following:
        left.remove(value)
    assert len(left) == 1 and left[0] in (0.1, 0.7)
    assert sum(r["next_ratio"] is None for r in out) == 2  # the last row, and the one before the null


def test_training_table(bronze):
    performance = rolled.performance_by_day(bronze[S.PERFORMANCE])
    pacing = rolled.adset_pacing(rolled.budget_pacing(bronze[S.BUDGET], bronze[S.AUDIENCE]))
    conv_7d = rolled.conversions_7d(performance, rolled.conversion_days(bronze[S.CONVERSIONS]))
    df = rolled.training_table(
        performance,
        rolled.audience_segments(bronze[S.AUDIENCE]),
        pacing,
        conv_7d,
        rolled.revenue_by_day(bronze[S.CONVERSIONS]),
    )
    assert df.count() == performance.count()
    rows = {(r["date"], r["ad_set_id"]): r for r in df.collect()}
    first = rows[(d(1), "A1")]
    assert first["aud_daily_budget"] == 500.0 and first["conv_7d"] == 6
    assert first["conv_next7d_rate"] == pytest.approx(6 / 1000)
    assert first["label_under_pacing_next"] == 1  # 0.3 the next day
    assert rows[(d(1), "A2")]["label_under_pacing_next"] == 0
    assert rows[(d(4), "A3")]["pacing_ratio"] is None
    assert rows[(d(2), "A2")]["conv_next7d_rate"] == 0.0
    assert rows[(d(1), "A2")]["aud_daily_budget"] == 0.0


@pytest.mark.parametrize("limit, piece", [(1, 1), (3, 2), (10, 100_000), (1_000_000, 100_000)])
def test_salted_join_equals_the_plain_join(spark, limit, piece):
    spine = spark.range(6).withColumn("name", F.concat(F.lit("k"), "id"))
    left = spark.range(60).selectExpr("CASE WHEN id < 40 THEN 1 ELSE id % 5 END AS id", "id AS l")
    right = spark.range(30).selectExpr("CASE WHEN id < 9 THEN 1 ELSE id % 4 END AS id", "id AS r")
    right = right.unionAll(spark.range(25).selectExpr("1L AS id", "77L AS r"))  # copies
    want = spine.join(left, "id", "left").join(right, "id", "left")
    got = skew.join_many(spine, [left, right], ["id"], rows_per_part=limit, copies_per_piece=piece)
    columns = ["id", "name", "l", "r"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert want.select(columns).exceptAll(got.select(columns)).isEmpty()


def _largest_task(df) -> float:
    """Share of the rows in the fullest partition."""
    rows = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in rows) / sum(r["count"] for r in rows)


@pytest.fixture
def even_partitions(spark):
    """Partitions as the plan deals them: none joined or split at run time."""
    names = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ["false", "8", "-1"]):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_copies_of_one_row_are_spread_over_tasks(spark, even_partitions):
    spine = spark.range(1)
    copies = spark.range(4000).selectExpr("0L AS id", "1 AS value")
    out = skew.join_many(spine, [copies], ["id"], rows_per_part=100, copies_per_piece=10)
    assert out.count() == 4000 and _largest_task(out) < 0.3


def test_a_key_over_the_limit_is_split_whatever_the_total(spark, even_partitions):
    spine = spark.range(1)
    rows = spark.range(4000).selectExpr("0L AS id", "id AS value")
    out = skew.join_many(spine, [rows], ["id"], rows_per_part=500)
    assert out.count() == 4000 and _largest_task(out) < 0.4


def test_repeated_keys_are_spread_over_the_buckets(spark, even_partitions):
    one_key = spark.range(4000).selectExpr("'A' AS ad_set_id", "DATE'2024-08-01' AS date", "id % 2 AS y", "id AS x")
    folds = split.stratified_folds(one_key, "y")
    assert _largest_task(folds) < 0.3
    assert sorted(r["count"] for r in folds.groupBy("y", "fold").count().collect()) == [400] * 10
    copies = one_key.withColumn("x", F.lit(1))
    placed = ranks.hash_position(copies, copies.columns, ["y"], copies_per_piece=100)
    assert _largest_task(placed) < 0.3
    for y in (0, 1):
        got = placed.filter(F.col("y") == y).select("position").collect()
        assert sorted(r[0] for r in got) == list(range(2000))


def test_no_setting_changes_a_position(spark):
    rows = [(i % 50, i % 3, "x" if i % 7 else None) for i in range(900)] + [(None, None, None)] * 40
    df = spark.createDataFrame(rows, "id long, s int, t string")

    def positions(**settings):
        placed = ranks.hash_position(df, ["id", "t"], ["s"], **settings)
        assert placed.columns == ["id", "s", "t", "position"]
        return sorted(map(str, placed.collect()))

    want = positions()
    assert want == positions(copies_per_piece=1) == positions(digits=1) == positions(digits=2, copies_per_piece=5)
    assert len(want) == 940 and sum("s=None" in w for w in want) == 40


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "a"), (2, None, None), (3, float("nan"), "c")], "n int, x double, s string"
    )
    report = {r["column_name"]: r for r in quality.profile(df).collect()}
    assert report["n"]["mean"] == 2.0 and report["n"]["std"] == pytest.approx(1.0)
    assert report["x"]["null_fraction"] == pytest.approx(2 / 3) and report["x"]["std"] is None
    assert report["s"]["mean"] is None and report["s"]["null_fraction"] == pytest.approx(1 / 3)
    assert quality.checks_passed(quality.profile(df)).first() == (1, 3)
    assert [r[0] for r in quality.issues(quality.profile(df)).collect()] == ["x", "s"]
    assert quality.profile(df.limit(0)).first()["null_fraction"] == 0.0
    with pytest.raises(RuntimeError, match="repeats"):
        quality.require_unique(df.unionAll(df), ["n"], "frame")


def test_a_hot_ad_set_is_split_when_the_audience_is_large(spark):
    """Without a broadcast, the budget join leaves the hot ad set to the skew split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        budget = spark.range(0, 60_000, 1, 8).selectExpr(
            "'1/8/2024' AS date",
            "IF(id % 3 < 2, 'hot', CAST(id AS STRING)) AS ad_set_id",
            "rand(7) AS budget_utilization",
        )
        audience = spark.range(0, 60_000, 3).selectExpr(
            "CAST(id AS STRING) AS ad_set_id", "1.0D AS daily_budget"
        )
        df = rolled.budget_pacing(budget, audience)
        assert len(df.collect()) == 60_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_query_of_keys_reads_no_other_column_of_silver(spark):
    """Silver is kept in columns: counting merged keys scans keys and row counts alone."""
    frames = [
        spark.createDataFrame([(dt.date(2024, 8, 1), "A", "n", 1, 1, 1.0, 1.0, 1.0, 1.0)],
                              "date date, ad_set_id string, ad_set_name string, impressions bigint, clicks bigint, "
                              "spend double, ctr double, cpm double, frequency double"),
        spark.createDataFrame([(dt.date(2024, 8, 1), "A", 1.0, 1.0, 1.0, "on_pace")],
                              "date date, ad_set_id string, planned_spend double, actual_spend double, "
                              "budget_utilization double, pacing_status string"),
        spark.createDataFrame([("C", dt.date(2024, 8, 1), "A", "booking_completed", 1.0, "w", "s")],
                              "conversion_id string, date date, ad_set_id string, conversion_type string, value double, "
                              "attribution_window string, user_segment string"),
    ]
    daily = conformed.daily_metrics(*[session.kept(f) for f in frames])
    counted = daily.groupBy("date", "ad_set_id").count()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", counted._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert scans and all("spend" not in s and "ctr" not in s and "revenue" not in s for s in scans), scans
    assert counted.first()["count"] == 1
