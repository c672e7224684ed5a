"""Train/test splits by time and folds stratified by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacewise.functions.measures import flag
from pacewise.operators.ranks import exact_quantiles, hash_position
from pacewise.sources import schemas as S

TRAIN, TEST, VALID = "train", "test", "valid"


def row_fraction_split(
    df: DataFrame,
    test_fraction: float = 0.2,
    date_col: str = S.DATE,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Add `split`: the first (1 - test_fraction) of the rows by date train.

    Counts per day settle every day but the one the boundary falls in; only that
    day's rows are put in order, by a hash of `tie_break` (default: all columns),
    as the order inside a day is open.
    """
    day = F.to_date(date_col)  # a column of times has too many values for one window
    upto = W.orderBy(F.asc_nulls_last("day")).rowsBetween(W.unboundedPreceding, 0)
    days = (
        df.groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("through", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(W.partitionBy()))
        .withColumn("wanted", F.floor(F.col("total") * F.lit(1 - test_fraction)))
    )
    # The day the boundary falls in: at most one row.
    boundary = days.filter("through > wanted AND through - n <= wanted").first()
    if boundary is None:
        return df.withColumn("split", F.lit(TRAIN))
    take = boundary["wanted"] - (boundary["through"] - boundary["n"])
    last = F.lit(boundary["day"]).cast("date")
    earlier = day.isNotNull() if boundary["day"] is None else F.coalesce(day < last, F.lit(False))
    settled = df.filter(~day.eqNullSafe(last)).withColumn(
        "split", F.when(earlier, F.lit(TRAIN)).otherwise(F.lit(TEST))
    )
    placed = hash_position(df.filter(day.eqNullSafe(last)), tie_break or df.columns)
    share = F.when(F.col("position") < take, F.lit(TRAIN)).otherwise(F.lit(TEST))
    return settled.unionByName(placed.withColumn("split", share).drop("position"))


def train_cutoff(df: DataFrame, train_fraction: float = 0.8, date_col: str = S.DATE) -> DataFrame:
    """One row with the last training date: the first share of the distinct dates trains."""
    # Days are few whatever the type of the column is.
    dates = df.agg(F.sort_array(F.collect_set(F.to_date(date_col))).alias("dates"))
    index = F.greatest(
        F.lit(1), F.floor(F.size("dates") * F.lit(float(train_fraction))).cast("int")
    )
    return dates.select(F.get("dates", index - 1).alias("cutoff"))


def date_fraction_split(
    df: DataFrame, train_fraction: float = 0.8, date_col: str = S.DATE
) -> DataFrame:
    """Add `split`: whole days, train up to the cutoff and valid after it."""
    cutoff = train_cutoff(df, train_fraction, date_col).scalar()
    return df.withColumn(
        "split", F.when(F.to_date(date_col) <= cutoff, F.lit(TRAIN)).otherwise(F.lit(VALID))
    )


def window_dates(split: DataFrame, date_col: str = S.DATE) -> DataFrame:
    """First and last date and row count per part of a split."""
    return split.groupBy("split").agg(
        F.min(date_col).alias("start"),
        F.max(date_col).alias("end"),
        F.count(F.lit(1)).alias("row_count"),
    )


def stratified_folds(
    df: DataFrame, stratum: str, k: int = 5, keys: list[str] | None = None
) -> DataFrame:
    """Add `fold` 0..k-1: shuffled by a hash, each class spread evenly over the folds.

    The hash is that of `keys`, of all columns if not given: (ad set, date) repeats.
    """
    placed = hash_position(df, keys or df.columns, [stratum])
    return placed.withColumn("fold", F.pmod("position", F.lit(k)).cast("int")).drop("position")


def target_bins(df: DataFrame, target: str, out: str = "bin") -> DataFrame:
    """Add the quartile bin 1..4 of the target; a bound belongs to the bin above it."""
    bounds = exact_quantiles(df, target, [0.0, 0.25, 0.5, 0.75, 1.0]).first()["quantiles"]
    reached = sum((flag(F.col(target) >= b) for b in bounds), F.lit(0))
    return df.withColumn(out, F.least(F.greatest(reached, F.lit(1)), F.lit(4)))


def target_folds(
    df: DataFrame, target: str, k: int = 5, keys: list[str] | None = None
) -> DataFrame:
    """Folds for a numeric target, stratified on its quartile bins."""
    return stratified_folds(target_bins(df, target), "bin", k, keys)
