"""Quantiles over any range of days from stored sketches.

A sketch of each day's values is kept; a report over a range merges the days in it and
reads no row again. Answers are approximate within a bound that the size of the sketch
sets. Exact quantiles stay what reports use unless these are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.sources import schemas as S

#: Items that a sketch keeps at its top level, and the error of ranks that it promises.
SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """With 99% confidence a rank is off by no more than this share of the values."""
    return 2.446 / size**0.9433


def daily_sketches(
    df: DataFrame,
    columns: list[str],
    size: int = SIZE,
    date_col: str = S.DATE,
    by: list[str] | None = None,
) -> DataFrame:
    """A row for each day, group of `by` and column: n and the sketch of its values.

    Null and NaN are no values. A day without values has a row with n = 0 and an empty
    sketch. Sketches are made before the shuffle and merged behind it, so a day with most
    of the rows is a sketch from each task.
    """

    def number(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    stacked = F.array(*[F.struct(F.lit(c).alias("column_name"), number(c).alias("value")) for c in columns])
    keys = [date_col, *(by or [])]
    return (
        df.select(*keys, F.inline(stacked))
        .groupBy(*keys, "column_name")
        .agg(
            F.count("value").alias("n"),
            F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"),
        )
    )


def merged(
    sketches: DataFrame,
    since: Column | None = None,
    until: Column | None = None,
    size: int = SIZE,
    date_col: str = S.DATE,
    by: list[str] | None = None,
) -> DataFrame:
    """The sketches of a range of days, both ends included, as one for each column (and `by`).

    Rows without a date belong to no range, but to the whole.
    """
    rows = sketches
    if since is not None:
        rows = rows.where(F.col(date_col) >= since)
    if until is not None:
        rows = rows.where(F.col(date_col) <= until)
    return rows.groupBy(*(by or []), "column_name").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )


def quantiles(whole: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """A row for each column and probability: n, prob, quantile; null without values."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    values = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", asked))
    rows = whole.select(*(by or []), "column_name", "n", asked.alias("_probs"), values.alias("_values"))
    pairs = F.transform(
        "_probs", lambda p, i: F.struct(p.alias("prob"), F.get("_values", i).alias("quantile"))
    )
    return rows.select(*(by or []), "column_name", "n", F.inline(pairs))


def quartile_cutoffs(whole: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The quartiles of each column in one row: column_name, q1, q2, q3."""
    rows = quantiles(whole, [0.25, 0.5, 0.75], by)
    picks = [
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))
    ]
    return rows.groupBy(*(by or []), "column_name").agg(*picks)
