from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacewise.functions import text
from pacewise.operators import report, whatif
from pacewise.operators.ranks import exact_quantiles, hash_position, running_total

ROWS = [
    ("A", dt.date(2024, 8, 1), 100.0, 900.0, 6000, 2.0, 7),
    ("A", dt.date(2024, 8, 2), 100.0, 700.0, 6000, 3.0, 9),
    ("B", dt.date(2024, 8, 1), 50.0, 100.0, 6000, 1.0, 3),
    ("B", dt.date(2024, 8, 3), 0.0, 0.0, 100, 1.0, None),
    ("C", dt.date(2024, 8, 2), 10.0, 5.0, 50, 1.0, 1),
    ("D", dt.date(2024, 8, 3), 40.0, 200.0, 9000, 1.0, 2),
]


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(
        ROWS,
        "ad_set_id string, date date, spend double, revenue double, impressions bigint, "
        "ctr double, conv_7d bigint",
    )


def test_filters(gold):
    assert report.select_rows(gold, ["A", "B"], dt.date(2024, 8, 2), dt.date(2024, 8, 3)).count() == 2
    assert report.last_days(gold, 2).count() == 4
    assert report.last_days(gold, 2, dt.date(2024, 8, 4)).count() == 2
    assert [r[0] for r in report.ad_set_choices(gold).collect()] == ["A", "B", "C", "D"]


def test_period_kpis_compare_with_the_period_before(gold):
    row = report.period_kpis(gold, dt.date(2024, 8, 2), dt.date(2024, 8, 2)).first()
    assert (row["spend_total"], row["spend_total_prev"]) == (110.0, 150.0)
    assert row["spend_total_change"] == pytest.approx(-26.6667, abs=1e-4)
    assert row["bookings_total"] == 1 and row["bookings_total_prev"] == 1
    assert row["roas_overall"] == pytest.approx(705 / 110)
    empty = report.period_kpis(gold, dt.date(2024, 8, 1), dt.date(2024, 8, 1)).first()
    assert empty["spend_total_prev"] == 0.0 and empty["spend_total_change"] is None


def test_rankings(gold):
    per_ad = report.roas_by_ad_set(gold)
    assert [r["ad_set_id"] for r in report.best(per_ad, 2).collect()] == ["A", "D"]
    assert [r["ad_set_id"] for r in report.worst(per_ad, 2).collect()] == ["C", "B"]
    assert [r["ad_set_id"] for r in report.worst(per_ad, 2, False).collect()] == ["B", "C"]
    assert {r["ad_set_id"] for r in report.roas_by_ad_set(gold, 5000).collect()} == {"A", "B", "D"}
    assert "ROAS (x)" in report.roas_table(per_ad).columns
    spread = report.roas_spread(per_ad).first()
    assert spread["adsets"] == 4 and spread["median_roas"] == pytest.approx(3.5)
    nothing = report.roas_spread(per_ad.limit(0)).first()
    assert (nothing["adsets"], nothing["top_roas"], nothing["median_roas"]) == (0, 0.0, 0.0)


def test_payloads(gold):
    row = report.roas_payload(gold, 5000).first()
    assert row["adsets"] == 3
    assert [a["ad_set_id"] for a in row["top3"]] == ["A", "D", "B"]
    assert [a["ad_set_id"] for a in row["bottom3"]] == ["B", "D", "A"]
    assert '"adsets":3' in report.as_json(report.roas_payload(gold, 5000)).first()["payload"]
    pacing = gold.select("ad_set_id", "date", (F.col("spend") / 100).alias("pacing_ratio"))
    kpis = report.kpi_payload(gold, pacing, dt.date(2024, 8, 1), dt.date(2024, 8, 3)).first()
    assert kpis["pacing_mix"] == {"under": 4, "on": 2, "over": 0}
    assert kpis["kpis"]["spend_total"] == 300.0


def test_moving_average_uses_what_there_is(gold):
    rows = report.daily_with_average(gold, 2).orderBy("date").collect()
    assert [r["spend"] for r in rows] == [150.0, 110.0, 40.0]
    assert [r["spend_ma2"] for r in rows] == [150.0, 130.0, 75.0]


def test_overview_text(gold):
    got = report.overview_text(gold, 2).first()["summary"]
    assert got.startswith("Spend changed by -60.0% and revenue by -77.8%. Focus budget on")
    assert "(A, D)" in got


@pytest.mark.parametrize("points, want", [
    (None, text.SUMMARY_MISSING),
    ([], text.SUMMARY_MISSING),
    (["One."], "One. " + text.DEFAULT_ACTION),
    (["One.", "Two."], "One. Two."),
])
def test_summary_falls_back(spark, points, want):
    df = spark.createDataFrame([(points,)], "p array<string>")
    assert df.select(text.summary(F.col("p"))).first()[0] == want


CLEANED = [
    (None, "- No suggestions"),
    ("", "- No suggestions"),
    ("   ", "-  "),
    ("- - - ", "- - - - "),
    ("spend $5 - raise caps\n\n- trim B \u2022 test new  ads - too many", "- spend £5\n- raise caps\n- trim B"),
    ("no bullets, a non-breaking\u00a0space and a hyphen-in-word", "- no bullets, a non-breaking space and a hyphen-in-word"),
    ("x" * 700 + " - " + "\U0001f600" * 301, "- " + "x" * 300 + "\n- " + "\U0001f600" * 300),
    ("- lone dash at the end -", "- lone dash at the end -"),
    ("one\u2003two -\u3000next", "- one two\n- next"),
    ("\x1ctab\tand\x85next - b\u2028c", "- tab and next\n- b c"),
]


def test_suggestions_are_cleaned(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", text.clean_suggestions("t")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CLEANED)}


FORMATTED = [
    (None, "£0", "0%"),
    (0.0, "£0", "0.0%"),
    (0.5, "£0", "50.0%"),
    (1.5, "£2", "1.5%"),
    (2.5, "£2", "2.5%"),
    (-0.4, "£-0", "-40.0%"),
    (1234567.5, "£1,234,568", "1234567.5%"),
    (0.1225, "£0", "12.2%"),
    (1.0, "£1", "100.0%"),
    (12.25, "£12", "12.2%"),
    (1e7, "£10,000,000", "10000000.0%"),
]


def test_formats(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(FORMATTED)], "i int, x double")
    got = df.orderBy("i").select(text.pounds("x"), text.percent("x")).collect()
    assert [tuple(r) for r in got] == [(p, s) for _, p, s in FORMATTED]


def test_rows_without_a_key_are_in_no_group(spark):
    rows = [("A", dt.date(2024, 8, 1), 10.0, 10.0), ("A", dt.date(2024, 8, 2), 20.0, 20.0),
            (None, dt.date(2024, 8, 2), 5.0, 5.0), ("A", None, 90.0, 90.0)]
    df = spark.createDataFrame(rows, "ad_set_id string, date date, spend double, revenue double")
    assert [r["ad_set_id"] for r in report.roas_by_ad_set(df).collect()] == ["A"]
    days = report.daily_with_average(df, 2).orderBy("date").collect()
    assert [(r["spend"], r["spend_ma2"]) for r in days] == [(10.0, 10.0), (25.0, 17.5)]
    change = report.first_to_last_change(df.filter("ad_set_id = 'A'")).first()
    assert change["spend_change"] == pytest.approx(100.0)


def test_bullets(spark):
    df = spark.createDataFrame([(["a", "b"],)], "p array<string>")
    assert df.select(text.bullets("p")).first()[0] == "- a\n- b"


PER_AD = [("A", 100.0, 1000.0), ("B", 100.0, 500.0), ("C", 50.0, 100.0), ("D", 200.0, 200.0)]


def _per_ad(spark, rows):
    df = spark.createDataFrame(rows, "ad_set_id string, spend double, revenue double")
    return df.withColumn("roas", F.when(F.col("spend") > 0, F.col("revenue") / F.col("spend")).otherwise(0.0))


def test_reallocation_moves_spend_from_low_to_high(spark):
    plan = whatif.reallocation(_per_ad(spark, PER_AD), shift=0.1, elasticity=1.0)
    rows = {r["ad_set_id"]: r for r in plan.collect()}
    assert rows["D"]["quartile"] == "bottom" and rows["D"]["spend_new"] == pytest.approx(180.0)
    assert rows["A"]["quartile"] == "top" and rows["A"]["spend_new"] == pytest.approx(145.0)
    assert rows["A"]["revenue_proj"] == pytest.approx(1450.0)
    assert whatif.reallocation_summary(plan).first()["spend_delta"] == pytest.approx(25.0)
    neutral = whatif.reallocation(_per_ad(spark, PER_AD), neutral=True)
    assert whatif.reallocation_summary(neutral).first()["spend_delta"] == pytest.approx(0.0)


def test_reallocation_guards_and_overlap(spark):
    assert whatif.reallocation(_per_ad(spark, PER_AD[:3])).isEmpty()
    idle = [(name, 0.0, 0.0) for name, _, _ in PER_AD]
    assert whatif.reallocation(_per_ad(spark, idle)).isEmpty()
    assert whatif.reallocation(_per_ad(spark, []), curve="linear").isEmpty()
    same = [(name, 10.0, 20.0) for name, _, _ in PER_AD]
    plan = whatif.reallocation(_per_ad(spark, same), curve="linear")
    assert plan.count() == 8  # each one is in the bottom and in the top group
    assert whatif.reallocation_summary(plan).first()["base_revenue"] == pytest.approx(80.0)
    with pytest.raises(ValueError):
        whatif.reallocation(_per_ad(spark, PER_AD), curve="other")


def test_importance_ranking(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.3)], "feature string, importance double")
    assert [(r[0], round(r[1])) for r in report.importance_ranking(df).collect()] == [("b", 75), ("a", 25)]
    zero = spark.createDataFrame([("a", 0.0)], "feature string, importance double")
    assert report.importance_ranking(zero).first()[1] == 0.0


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    values = [float(v) for v in [5, 1, 1, 1, 9, 2, 7, 7, 3, 4, 1]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs).first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(values, probs)))
    assert exact_quantiles(df.limit(0), "x", [0.5]).first()["quantiles"] == [None]


def test_running_total_over_range_partitions(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "id AS n")
    rows = running_total(df, "k", ["n"], ascending=False, ahead=True).orderBy(F.desc("k")).collect()
    total = 0
    for i, row in enumerate(rows):
        total += row["n"]
        assert row["cum_n"] == total
        assert row["next_n"] == (rows[i + 1]["n"] if i + 1 < len(rows) else None)


def test_hash_positions_are_complete_per_stratum(spark):
    df = spark.range(500).withColumn("s", F.col("id") % 3)
    rows = hash_position(df, ["id"], ["s"]).collect()
    for s in range(3):
        places = sorted(r["position"] for r in rows if r["s"] == s)
        assert places == list(range(len(places)))
