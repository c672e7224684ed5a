"""Column expressions shared by the cleaners, the layer builders and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise.sources import schemas as S


def day(c: str | Column, strict: bool = False) -> Column:
    """Day-first text to DATE. Strict raises on bad text, otherwise it becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c, S.DAY_FIRST) if strict else F.try_to_date(c, S.DAY_FIRST)


def to_number(c: str | Column, kind: str = "double") -> Column:
    """Number or null; text such as `45230.0` still reads as the bigint 45230."""
    c = F.col(c) if isinstance(c, str) else c
    as_double = c.try_cast("double")
    if kind == "double":
        return F.nanvl(as_double, F.lit(None).cast("double"))
    return F.coalesce(c.try_cast(kind), as_double.try_cast(kind))


def without_negative(c: str | Column) -> Column:
    """Negative to 0.0; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def at_least_zero(c: str | Column) -> Column:
    """Negative and null both to 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.greatest(c, F.lit(0.0))


def ratio(num: str | Column, den: str | Column, empty: float | None = None) -> Column:
    """`num / den` where den > 0, else `empty` (null or a number)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    guarded = F.when(den > 0, num.cast("double") / den)
    return guarded if empty is None else guarded.otherwise(F.lit(empty))


def rate_per(num: str, den: str, scale: float, keep: str) -> Column:
    """`num / den * scale` where den > 0, else the reported value in `keep`."""
    known = F.coalesce(F.col(den), F.lit(0)) > 0
    return F.when(known, F.col(num).cast("double") / F.col(den).cast("double") * scale).otherwise(
        F.col(keep)
    )


def conform(c: str, domain: list[str], other: str = S.UNKNOWN) -> Column:
    """Lower-case and map everything outside the domain (null too) to `other`."""
    low = F.lower(F.col(c))
    return F.when(low.isin(domain), low).otherwise(F.lit(other))


def pacing_index(c: str = "pacing_status") -> Column:
    """0 under, 1 on, 2 over, 3 anything else."""
    out = F.lit(len(S.PACING_STATUSES))
    for i in reversed(range(len(S.PACING_STATUSES))):
        out = F.when(F.col(c) == S.PACING_STATUSES[i], F.lit(i)).otherwise(out)
    return out.cast("int")


def pacing_band(c: str = "pacing_ratio") -> Column:
    """under / on / over; a missing ratio falls through to over."""
    under, on, over = S.PACING_BANDS
    return (
        F.when(F.col(c) < S.UNDER_BELOW, under).when(F.col(c) <= S.ON_UP_TO, on).otherwise(over)
    )


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("int")


def finite(c: str) -> Column:
    """±inf and NaN to null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.col(c))


def percent_change(last: Column, first: Column, floor: float = 1e-9) -> Column:
    """Percent change with the denominator floored."""
    return (last - first) / F.greatest(first, F.lit(floor)) * 100.0
