"""Queries that watch models and data: backtests, paired errors, drift, sketches, medians."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import star
from catalog.layers import perf, typed
from catalog.registry import Registry
from pacewise.operators import backtest, drift, ranks, sketches, split, trends
from pacewise.session import cut
from pacewise.sources import schemas as S

LAGGED = ("clicks_lag1", "spend_lag1")
PLAN = backtest.Backtest(LAGGED, "spend", folds=3, horizon=5, width=10)
REPLICATES, LEVEL = 400, 0.95
WATCHED = ["impressions", "clicks", "spend", "ctr", "cpm", "frequency"]
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROBS = [0.25, 0.5, 0.75]


@cache
def _lagged(spark: SparkSession, d: str) -> DataFrame:
    """Daily rows with what was known the day before, and the mean of the week before."""
    rows = trends.lag_features(
        perf(spark, d).select(*S.KEYS, "clicks", "spend").where(F.col(S.AD_SET).isNotNull()),
        ["clicks", "spend"],
        [1],
    )
    return cut(backtest.trailing_mean(rows, "spend"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = _lagged(spark, d)
    return backtest.fold_predictions(rows, PLAN, backtest.fold_models(rows, PLAN))


def _by_day(spark: SparkSession, d: str) -> DataFrame:
    return backtest.paired_by_day(_scored(spark, d), "spend", "expanding_prediction", "baseline")


def _drifted(spark: SparkSession, d: str) -> DataFrame:
    rows = typed(spark, d, S.PERFORMANCE).withColumn(S.DATE, F.to_date(S.DATE, S.DAY_FIRST))
    rows = cut(rows.select(S.DATE, *WATCHED))
    cutoff = split.train_cutoff(rows).first()["cutoff"]
    known = cut(drift.profile(rows.where(F.col(S.DATE) <= F.lit(cutoff)), WATCHED))
    return drift.compared(known, rows.where(F.col(S.DATE) > F.lit(cutoff)))


def _sales_days(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("l_shipdate").alias(S.DATE)
    return star.table(spark, d, "lineitem").select(day, *LINES)


RANGE = ("1994-03-01", "1996-09-30")


def _sketched(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of a range of days from the days' stored sketches, and whether they hold."""
    rows = _sales_days(spark, d)
    stored = cut(sketches.daily_sketches(rows, LINES))
    since, until = (F.lit(x).cast("date") for x in RANGE)
    answers = sketches.quantiles(sketches.merged(stored, since, until), PROBS).collect()
    ranged = rows.where(F.col(S.DATE).between(since, until))
    # An answer covers the ranks of all rows that have its value.
    counts = []
    for i, a in enumerate(answers):
        value = F.lit(a["quantile"])
        counts += [
            F.count_if(F.col(a.column_name) < value).alias(f"below{i}"),
            F.count_if(F.col(a.column_name) <= value).alias(f"upto{i}"),
        ]
    found = ranged.agg(*counts).first()
    slack = 3 * sketches.rank_error()
    out = [
        (
            a.column_name,
            a.prob,
            a.n,
            found[f"below{i}"] / a.n - slack <= a.prob <= found[f"upto{i}"] / a.n + slack,
        )
        for i, a in enumerate(answers)
        if a.n
    ]
    return spark.createDataFrame(out, "column_name string, prob double, n bigint, within boolean")


def _exact(spark: SparkSession, d: str) -> DataFrame:
    found = ranks.exact_quantiles_of(star.table(spark, d, "lineitem"), LINES, PROBS)
    return found.select(
        "column_name", "n", *[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)]
    )


def _medians(spark: SparkSession, d: str) -> DataFrame:
    found = ranks.exact_quantiles_of(typed(spark, d, S.PERFORMANCE), WATCHED, [0.5])
    return found.select("column_name", "n", F.col("quantiles")[0].alias("median"))


# --- SQL -------------------------------------------------------------------------

ROWS = """
    SELECT date, ad_set_id, spend AS y, lag(clicks) OVER w AS x1, lag(spend) OVER w AS x2,
           avg(spend) OVER (PARTITION BY ad_set_id ORDER BY date
                            ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline
    FROM perf WHERE ad_set_id IS NOT NULL WINDOW w AS (PARTITION BY ad_set_id ORDER BY date)"""

#: Every fold's training part, one after another, and least squares on two features.
FOLDS = f"""
WITH usable AS MATERIALIZED (
    SELECT * FROM ({ROWS}) WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL),
fold AS (
    SELECT fold, kind, (SELECT max(date) FROM usable) - 5 * (3 - fold) AS stop
    FROM (SELECT unnest([0, 1, 2])::INTEGER AS fold),
         (SELECT unnest(['expanding', 'rolling']) AS kind)),
fitted AS (
    SELECT fold, kind, min(date) AS train_start, max(date) AS train_end, count(*) AS train_n,
           avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2,
           covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y
    FROM usable JOIN fold ON date <= stop AND (kind = 'expanding' OR date > stop - 10)
    GROUP BY fold, kind),
weights AS (
    SELECT *, (v2 * c1y - c12 * c2y) / (v1 * v2 - c12 * c12) AS b1,
           (v1 * c2y - c12 * c1y) / (v1 * v2 - c12 * c12) AS b2 FROM fitted),
tested AS (
    SELECT fold, kind, date, ad_set_id, y, baseline,
           my + b1 * (x1 - m1) + b2 * (x2 - m2) AS prediction
    FROM usable JOIN fold ON date > stop AND date <= stop + 5 JOIN weights USING (fold, kind))"""

PAIRED = f"""{FOLDS},
paired AS (
    SELECT date, count(*) AS n, sum(abs(y - prediction)) AS model_error,
           sum(abs(y - baseline)) AS baseline_error
    FROM tested WHERE kind = 'expanding' AND baseline IS NOT NULL GROUP BY date),
drawn AS (
    SELECT replicate, n, model_error, baseline_error,
           len(list_filter({backtest.weight_steps()}::BIGINT[], lambda s: s <= place)) AS weight
    FROM (SELECT *, ('0x' || md5(replicate || '|' || date)[1:15])::BIGINT AS place
          FROM paired, (SELECT unnest(range({REPLICATES})) AS replicate))),
gains AS (
    SELECT replicate::INTEGER AS replicate,
           sum(weight * (baseline_error - model_error)) / sum(weight * n) AS gain
    FROM drawn GROUP BY replicate HAVING sum(weight) > 0)"""


def _psi(column: str) -> str:
    """Drift of one column: bins of the training part's deciles, counted on both sides."""
    return f"""
SELECT '{column}' AS column_name, n_before, n_since,
       nulls_before / nullif(nulls_before + n_before, 0) AS null_share_before,
       nulls_since / nullif(nulls_since + n_since, 0) AS null_share_since, psi, ks,
       psi >= 0.2 OR ks >= 0.2 OR abs(null_share_since - null_share_before) >= 0.05 AS alert
FROM (SELECT count(v) FILTER (NOT late) AS n_before, count(v) FILTER (late) AS n_since,
             count(*) FILTER (v IS NULL AND NOT late) AS nulls_before,
             count(*) FILTER (v IS NULL AND late) AS nulls_since FROM ({_side(column)})),
     (SELECT sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4)))
                 AS psi, max(abs(cp - cq)) AS ks
      FROM (SELECT *, sum(p) OVER (ORDER BY bin) AS cp, sum(q) OVER (ORDER BY bin) AS cq
            FROM (SELECT bin, count(*) FILTER (NOT late)
                              / (sum(count(*) FILTER (NOT late)) OVER ()) AS p,
                         count(*) FILTER (late) / (sum(count(*) FILTER (late)) OVER ()) AS q
                  FROM (SELECT late, len(list_filter(edges, lambda e: e < v)) AS bin
                        FROM ({_side(column)}),
                             (SELECT list_distinct(quantile_cont(v, {[i / 10 for i in range(1, 10)]}))
                                         AS edges FROM ({_side(column)}) WHERE NOT late)
                        WHERE v IS NOT NULL)
                  GROUP BY bin)))"""


def _side(column: str) -> str:
    return f"""SELECT {column}::DOUBLE AS v, date > (
                   SELECT list_sort(list(DISTINCT date))
                          [greatest(1, floor(count(DISTINCT date) * 0.8::DOUBLE)::INT)]
                   FROM raw_performance) AS late FROM raw_performance"""


def add_to(r: Registry) -> None:
    r.add(
        "e02_fold_metrics",
        lambda s, d: backtest.fold_metrics(_lagged(s, d), PLAN),
        f"""SELECT * FROM ({FOLDS}
            SELECT fold, kind, train_start, train_end, train_n, count(*) AS n,
                   avg(abs(y - prediction)) AS mae, sqrt(avg((y - prediction) ** 2)) AS rmse,
                   1 - avg((y - prediction) ** 2) / var_pop(y) AS r2
            FROM tested JOIN weights USING (fold, kind) GROUP BY ALL)""",
        {"mae": 5, "rmse": 5, "r2": 6},
    )
    r.add(
        "e03_paired_errors",
        lambda s, d: backtest.paired_errors(
            _scored(s, d), "spend", "expanding_prediction", "baseline", REPLICATES, LEVEL
        ),
        f"""SELECT * FROM ({PAIRED}
            SELECT *, mae_baseline - mae_model AS gain, low > 0 AS better
            FROM (SELECT count(*) AS days, sum(n)::BIGINT AS pairs,
                         sum(model_error) / sum(n) AS mae_model,
                         sum(baseline_error) / sum(n) AS mae_baseline FROM paired),
                 (SELECT quantile_cont(gain, {(1 - LEVEL) / 2}) AS low,
                         quantile_cont(gain, {1 - (1 - LEVEL) / 2}) AS high FROM gains))""",
        {c: 6 for c in ("mae_model", "mae_baseline", "gain", "low", "high")},
    )
    r.add(
        "e03_replicates",
        lambda s, d: backtest.replicates(_by_day(s, d), REPLICATES),
        f"SELECT * FROM ({PAIRED} SELECT replicate, gain FROM gains)",
        {"gain": 6},
    )
    r.add(
        "e04_distribution_drift",
        _drifted,
        " UNION ALL ".join(f"({_psi(c)})" for c in WATCHED),
        {c: 6 for c in ("null_share_before", "null_share_since", "psi", "ks")},
    )
    ranged = f"date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"
    r.add(
        "g21_sketched_quantiles",
        _sketched,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, unnest({PROBS}::DOUBLE[]) AS prob, n, true AS within
                FROM (SELECT count({c}) AS n
                      FROM (SELECT *, l_shipdate::DATE AS date FROM lineitem) WHERE {ranged})
                WHERE n > 0"""
            for c in LINES
        ),
    )
    r.add(
        "g20_exact_quantiles",
        _exact,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n, quantile_cont({c}, 0.25) AS q1,
                       quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem"""
            for c in LINES
        ),
        {"q1": 6, "q2": 6, "q3": 6},
    )
    r.add(
        "m01_medians",
        _medians,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n,
                       quantile_cont({c}::DOUBLE, 0.5) AS median FROM raw_performance"""
            for c in WATCHED
        ),
        {"median": 6},
    )
