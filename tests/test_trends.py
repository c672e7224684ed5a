from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacewise.operators import trends


def day(n: int) -> dt.date:
    return dt.date(2024, 8, n)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [("A", day(n), 10 * n) for n in range(1, 11) if n != 4] + [("B", day(9), 7), (None, day(2), 1)]
    return spark.createDataFrame(rows, "ad_set_id string, date date, clicks bigint")


def test_lags_count_rows(daily):
    rows = trends.lag_features(daily, ["clicks"], [1, 3]).filter("ad_set_id = 'A'").collect()
    got = {r["date"]: (r["clicks_lag1"], r["clicks_lag3"]) for r in rows}
    assert got[day(1)] == (None, None) and got[day(5)] == (30, 10) and got[day(10)] == (90, 70)


def test_weeks_begin_on_mondays(daily):
    got = {(r["ad_set_id"], r["week"]): r["clicks"] for r in trends.weekly_totals(daily, ["clicks"]).collect()}
    assert got[("A", dt.date(2024, 7, 29))] == 60 and got[("A", day(5))] == 50 + 60 + 70 + 80 + 90 + 100


def test_folds_expand(daily):
    rows = trends.expanding_folds(daily, 2, 3).collect()
    dates = {(f, s): sorted(r["date"].day for r in rows if (r["fold"], r["split"]) == (f, s) and r["ad_set_id"] == "A")
             for f in (0, 1) for s in ("train", "valid")}
    assert dates == {
        (0, "train"): [1, 2, 3], (0, "valid"): [5, 6, 7],
        (1, "train"): [1, 2, 3, 5, 6, 7], (1, "valid"): [8, 9, 10],
    }


def test_forecast_looks_back_only(spark):
    series = spark.createDataFrame([(day(n), float(n)) for n in range(1, 5)], "date date, spend double")
    got = [r["forecast"] for r in trends.average_forecast(series, "spend", 2).orderBy("date").collect()]
    assert got == [None, 1.0, 1.5, 2.5]


def test_drift_in_earlier_deviations(daily):
    a = daily.filter("ad_set_id = 'A'")
    row = trends.drift(a, ["clicks"], F.lit(day(9))).first()
    assert (row["mean_before"], row["mean_since"]) == (pytest.approx(320 / 7), 95.0)
    assert row["shift"] == pytest.approx((95 - 320 / 7) / 26.3674, abs=1e-4)


def test_last_touch_within_reach(spark, daily):
    events = spark.createDataFrame(
        [("c1", "A", day(4)), ("c2", "A", day(4)), ("c3", "B", day(8)), ("c4", "B", day(12)), ("c5", None, day(2))],
        "conversion_id string, ad_set_id string, date date",
    )
    got = {r["conversion_id"]: r["touch_date"] for r in trends.last_touch(events, daily, 3).collect()}
    assert got == {"c1": day(3), "c2": day(3), "c3": None, "c4": day(9), "c5": None}
