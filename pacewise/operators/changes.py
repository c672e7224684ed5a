"""Which days of a table have changed, and which days of another table that reaches."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.sources import schemas as S

PRINTS = "date date, n bigint, a decimal(38,0), b decimal(38,0)"


def fingerprints(df: DataFrame, date_col: str = S.DATE) -> DataFrame:
    """A row a day: how many rows it has, and two sums of hashes of its rows.

    The order of rows doesn't matter, their number does. Rows without a date are a day.
    """
    columns = [F.col(c) for c in sorted(df.columns)]

    def total(*salt) -> F.Column:
        return F.sum(F.xxhash64(*salt, *columns).cast("decimal(38,0)"))

    return df.groupBy(F.col(date_col).alias("date")).agg(
        F.count(F.lit(1)).alias("n"), total().alias("a"), total(F.lit(1)).alias("b")
    )


def changed_days(before: DataFrame, now: DataFrame) -> list[date | None]:
    """Days that were added, left or have other rows, from two sets of fingerprints."""
    old = before.select(*[F.col(c).alias(f"_{c}") for c in ("date", "n", "a", "b")])
    same = F.col("date").eqNullSafe(F.col("_date"))
    for c in ("n", "a", "b"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    new = now.join(old, same, "left_anti").select("date")
    gone = old.join(now, same, "left_anti").select(F.col("_date").alias("date"))
    return _sorted({r[0] for r in new.union(gone).distinct().collect()})


def _sorted(days: set) -> list:
    return sorted(days, key=lambda d: (d is None, d or date.min))


def days_before(days: list[date | None], reach: int) -> list[date | None]:
    """The days, and those up to `reach` days before: what a count that looks ahead reads."""
    wide = {d for d in days if d is None}
    for d in days:
        if d is not None:
            wide |= {d - timedelta(n) for n in range(reach + 1)}
    return _sorted(wide)


def days_of_previous_rows(
    days: list[date | None], *versions: DataFrame, by: str = S.AD_SET, date_col: str = S.DATE
) -> list[date | None]:
    """The days, and those of the row before a changed day's in its `by`, in any version.

    What looks at the next row of its `by` depends on a row that may be any number of
    days later. `versions` are the table as it was and as it is: a row that comes, goes or
    changes is the next one of the last row before it.
    """
    known = [d for d in days if d is not None]
    if not known:
        return _sorted(set(days))
    every = versions[0].select(by, date_col)
    for v in versions[1:]:
        every = every.union(v.select(by, date_col))
    every = every.where(F.col(date_col).isNotNull()).distinct()
    touched = every.where(F.col(date_col).isin(known)).select(
        F.col(by).alias("_by"), F.col(date_col).alias("_day")
    )
    # One row a day and `by` on both sides; each touched day keeps the latest one before.
    earlier = touched.join(
        every.where(F.col(date_col) < F.lit(max(known))),
        F.col("_by").eqNullSafe(F.col(by)) & (F.col(date_col) < F.col("_day")),
    )
    previous = earlier.groupBy("_by", "_day").agg(F.max(date_col).alias("day"))
    return _sorted(set(days) | {r[0] for r in previous.select("day").distinct().collect()})
