"""Queries over daily rows: lags, weeks, backtests, a naive forecast, drift, last touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.layers import perf, slv_conversions
from catalog.registry import Registry
from pacewise.operators import split, trends
from pacewise.sources import schemas as S

COLUMNS = ["impressions", "clicks", "spend"]
DAY_SUMS = "SELECT date, sum(spend) AS spend FROM perf GROUP BY date"


def _days(spark: SparkSession, d: str) -> DataFrame:
    return perf(spark, d).groupBy(S.DATE).agg(F.sum("spend").alias("spend"))


def _errors(spark: SparkSession, d: str) -> DataFrame:
    known = trends.average_forecast(_days(spark, d), "spend").dropna(subset=["forecast"])
    return known.agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(F.abs(F.col("spend") - F.col("forecast"))).alias("mae"),
    )


def _drift(spark: SparkSession, d: str) -> DataFrame:
    rows = perf(spark, d)
    since = F.date_add(split.train_cutoff(rows).scalar(), 1)
    return trends.drift(rows, COLUMNS, since)


def add_to(r: Registry) -> None:
    lags = ", ".join(
        f"lag({c}, {n}) OVER (PARTITION BY ad_set_id ORDER BY date) AS {c}_lag{n}"
        for c in ("clicks", "spend") for n in (1, 7)
    )
    r.add(
        "e01_lag_features",
        lambda s, d: trends.lag_features(
            perf(s, d).select(*S.KEYS, "clicks", "spend"), ["clicks", "spend"], [1, 7]
        ),
        f"SELECT date, ad_set_id, clicks, spend, {lags} FROM perf",
        {c: 4 for c in ("spend", "spend_lag1", "spend_lag7")},
    )
    r.add(
        "e01_weekly_totals",
        lambda s, d: trends.weekly_totals(perf(s, d), COLUMNS),
        """SELECT ad_set_id, CAST(date_trunc('week', date) AS DATE) AS week,
                  CAST(sum(impressions) AS BIGINT) AS impressions,
                  CAST(sum(clicks) AS BIGINT) AS clicks, sum(spend) AS spend
           FROM perf GROUP BY ALL""",
        {"spend": 4},
    )
    r.add(
        "e02_expanding_backtest",
        lambda s, d: trends.expanding_folds(perf(s, d), 3, 5)
        .groupBy("fold", "split")
        .agg(F.min(S.DATE).alias("start"), F.max(S.DATE).alias("end"), F.count(F.lit(1)).alias("n")),
        """SELECT fold::INTEGER AS fold, CASE WHEN date > stop - 5 THEN 'valid' ELSE 'train' END AS split,
                  min(date) AS "start", max(date) AS "end", count(*) AS n
           FROM (SELECT fold, (SELECT max(date) FROM perf) - (5 * (2 - fold))::INTEGER AS stop
                 FROM (SELECT unnest([0, 1, 2]) AS fold)) JOIN perf ON date <= stop
           GROUP BY ALL""",
    )
    r.add(
        "e03_average_forecast",
        _errors,
        f"""SELECT count(*) AS days, avg(abs(spend - forecast)) AS mae
            FROM (SELECT *, avg(spend) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                         AS forecast FROM ({DAY_SUMS})) WHERE forecast IS NOT NULL""",
        {"mae": 4},
    )
    cutoff = """(SELECT list_sort(list(DISTINCT date))
                 [greatest(1, floor(count(DISTINCT date) * 0.8::DOUBLE)::INT)] FROM perf)"""
    r.add(
        "e04_drift",
        _drift,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, avg({c}) FILTER (date <= {cutoff}) AS mean_before,
                       avg({c}) FILTER (date > {cutoff}) AS mean_since,
                       (avg({c}) FILTER (date > {cutoff}) - avg({c}) FILTER (date <= {cutoff}))
                       / stddev_samp({c}) FILTER (date <= {cutoff}) AS "shift" FROM perf"""
            for c in COLUMNS
        ),
        {"mean_before": 4, "mean_since": 4, "shift": 6},
    )
    r.add(
        "e05_last_touch",
        lambda s, d: trends.last_touch(slv_conversions(s, d), perf(s, d), 3),
        """SELECT conversion_id, c.ad_set_id, c.date, max(p.date) AS touch_date
           FROM slv_conversions c LEFT JOIN perf p
             ON p.ad_set_id = c.ad_set_id AND p.date BETWEEN c.date - 3 AND c.date
           GROUP BY ALL""",
    )
