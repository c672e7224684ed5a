"""Backtests of linear models from sums by day, and paired comparisons of forecasts.

The sums of products of features and target over a day are all that a linear fit needs of
it. They are made once; a fold's training part, whether it expands or rolls, is a sum over
days, and no row is repeated for a fold. Each tested row is then scored once for each kind.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.sources import schemas as S

EXPANDING, ROLLING = "expanding", "rolling"


@dataclass(frozen=True)
class Backtest:
    """What is fitted, and how the days are cut.

    The last fold is tested on the latest `horizon` days, the one before it on the
    `horizon` days before these, and so on. An expanding fold trains on all days before
    the tested ones, a rolling fold on the last `width` of them. `ridge` is added to the
    squares of the standardised features.
    """

    features: tuple[str, ...]
    target: str
    folds: int = 3
    horizon: int = 5
    width: int = 10
    ridge: float = 0.0
    date_col: str = S.DATE

    def kinds(self) -> list[str]:
        return [EXPANDING, ROLLING]


def usable(df: DataFrame, plan: Backtest) -> DataFrame:
    """Rows with a date and finite numbers in all features and the target, as doubles."""
    names = [*plan.features, plan.target]
    rows = df.where(F.col(plan.date_col).isNotNull()).withColumns(
        {c: F.col(c).cast("double") for c in names}
    )
    for c in names:
        rows = rows.where(F.abs(F.col(c)) < float("inf"))
    return rows


def day_statistics(rows: DataFrame, plan: Backtest, centre: list[float]) -> DataFrame:
    """One row a day: n and `moments`, the upper triangle of the sums of products.

    Products are of 1, the features and the target, less `centre`, which keeps the sums
    small and changes no fit.
    """
    names = [*plan.features, plan.target]
    terms = [F.lit(1.0), *[F.col(c) - F.lit(m) for c, m in zip(names, centre)]]
    sums = [F.sum(a * b) for i, a in enumerate(terms) for b in terms[i:]]
    return rows.groupBy(plan.date_col).agg(
        F.count(F.lit(1)).alias("n"), F.array(*sums).alias("moments")
    )


def _tested_fold(last: object, plan: Backtest) -> Column:
    """The fold that tests a row's day; negative for days before the first tested one."""
    ahead = F.floor(F.datediff(F.lit(last), F.col(plan.date_col)) / F.lit(plan.horizon))
    return (F.lit(plan.folds - 1) - ahead).cast("int")


def solve(n: int, moments: list[float], features: int, ridge: float) -> np.ndarray:
    """Intercept and slopes, for centred values; of equally good ones the smallest slopes."""
    size = features + 2
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = moments
    m += np.triu(m, 1).T
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.clip(np.diag(cov), 0, None))
    spread[spread <= 1e-12 * (1 + np.abs(mean))] = 0
    scale = np.where(spread > 0, spread, 1)
    standard = cov / np.outer(scale, scale)
    x, y = standard[:-1, :-1], standard[:-1, -1]
    x[spread[:-1] == 0] = 0
    slopes = np.linalg.pinv(x + ridge * np.eye(features), rcond=1e-10, hermitian=True) @ y
    slopes = np.where(spread[:-1] > 0, slopes * scale[-1] / scale[:-1], 0)
    return np.concatenate([[mean[-1] - mean[:-1] @ slopes], slopes])


MODELS = "fold int, kind string, train_start date, train_end date, train_n bigint, weights array<double>"


def fold_models(df: DataFrame, plan: Backtest) -> DataFrame:
    """The fitted model of every fold and kind: its training days, their rows, its weights.

    `weights` are the intercept and a slope for each feature. A fold without rows before
    its tested days has no model. Rows with a null or non-finite feature or target, or
    without a date, take no part.

    A job over all rows gives the middle of each column, another one the sums of each
    day; then the days' sums, a row a day, are added up by fold. The driver gets a row for
    each fold and kind.
    """
    spark = df.sparkSession
    rows = usable(df, plan)
    names = [*plan.features, plan.target]
    top = rows.agg(F.max(plan.date_col).alias("last"), *[F.avg(c).alias(c) for c in names]).first()
    if top["last"] is None:
        return spark.createDataFrame([], MODELS)
    centre = [top[c] for c in names]
    daily = day_statistics(rows, plan, centre)
    tested = _tested_fold(top["last"], plan)
    # A day trains in the folds behind the one that tests it, old days in all.
    first = F.greatest(tested + 1, F.lit(0))
    trained = daily.where(tested < plan.folds - 1).select(
        plan.date_col, "n", "moments", F.explode(F.sequence(first, F.lit(plan.folds - 1))).alias("fold")
    )
    stop = F.date_sub(F.lit(top["last"]), (F.lit(plan.folds) - F.col("fold")) * plan.horizon)
    recent = F.col(plan.date_col) > F.date_sub(stop, F.lit(plan.width))
    kinds = F.when(recent, F.array(F.lit(EXPANDING), F.lit(ROLLING))).otherwise(
        F.array(F.lit(EXPANDING))
    )
    size = len(names) + 1
    sums = [F.sum(F.col("moments")[i]) for i in range(size * (size + 1) // 2)]
    folds = (
        trained.withColumn("kind", F.explode(kinds))
        .groupBy("fold", "kind")
        .agg(
            F.min(plan.date_col).alias("train_start"),
            F.max(plan.date_col).alias("train_end"),
            F.sum("n").alias("n"),
            F.array(*sums).alias("moments"),
        )
        .collect()
    )
    out = []
    for r in folds:
        w = solve(r.n, r.moments, len(plan.features), plan.ridge)
        # Back from centred values to the columns' own.
        w[0] += centre[-1] - float(w[1:] @ np.array(centre[:-1]))
        out.append((r.fold, r.kind, r.train_start, r.train_end, r.n, w.tolist()))
    return spark.createDataFrame(out, MODELS)


def fold_predictions(df: DataFrame, plan: Backtest, models: DataFrame) -> DataFrame:
    """Every tested row once, with `fold` and a prediction of each kind.

    `models` has one row for each fold and kind, so it is joined as one row a fold. A
    kind without a model for the fold predicts null.
    """
    rows = usable(df, plan)
    last = rows.agg(F.max(plan.date_col)).first()[0]
    if last is None:
        return rows.withColumns(
            {"fold": F.lit(None).cast("int")}
            | {f"{k}_prediction": F.lit(None).cast("double") for k in plan.kinds()}
        )
    by_fold = models.groupBy(F.col("fold").alias("model_fold")).agg(
        *[F.max(F.when(F.col("kind") == k, F.col("weights"))).alias(f"_{k}") for k in plan.kinds()]
    )

    def predicted(kind: str) -> Column:
        w = F.col(f"_{kind}")
        return sum((w[i + 1] * F.col(c) for i, c in enumerate(plan.features)), w[0])

    tested = rows.withColumn("fold", _tested_fold(last, plan)).where("fold >= 0")
    return (
        tested.join(F.broadcast(by_fold), F.col("fold") == F.col("model_fold"), "left")
        .withColumns({f"{k}_prediction": predicted(k) for k in plan.kinds()})
        .drop("model_fold", *[f"_{k}" for k in plan.kinds()])
    )


def fold_metrics(df: DataFrame, plan: Backtest) -> DataFrame:
    """Per fold and kind: training days and rows, tested rows, MAE, RMSE and R².

    R² is null where the tested targets are all equal. Both kinds are measured in one
    pass over the tested rows.
    """
    models = fold_models(df, plan)
    tested = fold_predictions(df, plan, models)
    y, stats = F.col(plan.target), []
    for k in plan.kinds():
        error = y - F.col(f"{k}_prediction")
        stats.append(
            F.struct(
                F.lit(k).alias("kind"),
                F.count(error).alias("n"),
                F.avg(F.abs(error)).alias("mae"),
                F.sqrt(F.avg(error * error)).alias("rmse"),
                (
                    1 - F.avg(error * error) / F.nullif(F.var_pop(F.when(error.isNotNull(), y)), F.lit(0.0))
                ).alias("r2"),
            )
        )
    measured = tested.groupBy("fold").agg(F.array(*stats).alias("stats"))
    measured = measured.select(F.col("fold").alias("_fold"), F.inline("stats"))
    measured = measured.withColumnRenamed("kind", "_kind")
    same = (F.col("fold") == F.col("_fold")) & (F.col("kind") == F.col("_kind"))
    return models.join(measured, same, "left").select(
        "fold", "kind", "train_start", "train_end", "train_n",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mae", "rmse", "r2",
    )


def trailing_mean(
    daily: DataFrame, column: str, window: int = S.MA_WINDOW, by: str = S.AD_SET, order: str = S.DATE
) -> DataFrame:
    """Add `baseline`: the mean of the `window` rows before within `by`; the first has none.

    `daily` has one row per (by, order), so a window holds one row per calendar day.
    """
    from pyspark.sql import Window as W

    before = W.partitionBy(by).orderBy(order).rowsBetween(-window, -1)
    return daily.withColumn("baseline", F.avg(column).over(before))


# --- paired comparison -----------------------------------------------------------

#: Hash values are below 2 to the power of this.
HASH_BITS = 60
#: Weights of a day in a replicate are 0 to this, by chance as often as events of mean 1.
MOST_WEIGHT = 10


def weight_steps() -> list[int]:
    """Hash values from which on a day weighs 1, 2, ... in a replicate."""
    steps, below = [], 0.0
    for k in range(MOST_WEIGHT):
        below += exp(-1) / factorial(k)
        steps.append(int(below * (1 << HASH_BITS)))
    return steps


def block_weight(replicate: Column, block: Column) -> Column:
    """How often a block is in a replicate, from a hash of both: the same in every run."""
    text = F.concat_ws("|", replicate.cast("string"), block.cast("string"))
    place = F.conv(F.left(F.md5(text), F.lit(HASH_BITS // 4)), 16, 10).cast("bigint")
    return sum(((place >= F.lit(s)).cast("int") for s in weight_steps()), F.lit(0))


def paired_by_day(
    scored: DataFrame, target: str, model: str, baseline: str, date_col: str = S.DATE
) -> DataFrame:
    """A row a day: pairs, and the sums of both absolute errors over the same rows.

    Rows that lack a date, the target or one of the forecasts are no pair.
    """
    y = F.col(target)
    rows = scored.select(
        F.col(date_col).alias("date"),
        F.abs(y - F.col(model)).alias("model"),
        F.abs(y - F.col(baseline)).alias("baseline"),
    ).dropna()
    return rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("model").alias("model_error"),
        F.sum("baseline").alias("baseline_error"),
    )


def replicates(by_day: DataFrame, count: int) -> DataFrame:
    """The mean gain of the model over the baseline in each replicate: replicate, gain.

    A replicate weighs whole days, since errors of one day go together. All replicates
    come from the days' sums in one aggregation; one in which no day has weight is left
    out.
    """
    numbered = by_day.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    weight = block_weight(F.col("replicate"), F.col("date"))
    return (
        numbered.withColumn("weight", weight)
        .where("weight > 0")
        .groupBy("replicate")
        .agg(
            (
                F.sum(F.col("weight") * (F.col("baseline_error") - F.col("model_error")))
                / F.sum(F.col("weight") * F.col("n"))
            ).alias("gain")
        )
    )


def paired_errors(
    scored: DataFrame,
    target: str,
    model: str,
    baseline: str,
    count: int = 400,
    level: float = 0.95,
    date_col: str = S.DATE,
) -> DataFrame:
    """One row: days, pairs, both mean errors, the mean gain and its interval.

    gain is the baseline's mean absolute error less the model's, on the same rows;
    [low, high] holds `level` of the replicates of a bootstrap over days, and `better` is
    true if it lies above 0. Without pairs all but the counts are null.
    """
    by_day = paired_by_day(scored, target, model, baseline, date_col)
    tail = (1 - level) / 2
    spread = replicates(by_day, count).agg(
        F.percentile("gain", F.array(F.lit(tail), F.lit(1 - tail))).alias("bounds")
    )
    pairs = F.sum("n")
    whole = by_day.agg(
        F.count(F.lit(1)).alias("days"),
        F.coalesce(pairs, F.lit(0)).cast("bigint").alias("pairs"),
        (F.sum("model_error") / pairs).alias("mae_model"),
        (F.sum("baseline_error") / pairs).alias("mae_baseline"),
    )
    # Both sides are one row.
    bounds = spread.first()[0] or [None, None]
    low, high = (F.lit(b).cast("double") for b in bounds)
    return whole.withColumns(
        {
            "gain": F.col("mae_baseline") - F.col("mae_model"),
            "low": low,
            "high": high,
            "better": low > 0,
        }
    )
