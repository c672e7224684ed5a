"""Gold tables of the conformed layers: daily metrics and the bookings training set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.functions.measures import pacing_index, ratio
from pacewise.operators.skew import join_many
from pacewise.session import kept
from pacewise.sources import schemas as S

_PERFORMANCE_ZEROS = {
    "impressions": 0,
    "clicks": 0,
    "spend": 0.0,
    "ctr": 0.0,
    "cpm": 0.0,
    "frequency": 0.0,
}
_BUDGET_ZEROS = {"planned_spend": 0.0, "actual_spend": 0.0, "budget_utilization": 0.0}


def _booking() -> Column:
    return F.col("conversion_type") == S.BOOKING


def _soft() -> Column:
    return F.col("conversion_type").isin(S.SOFT_CONVERSIONS)


def _conversion_values() -> list[Column]:
    """What one conversion adds: booking revenue, bookings and soft conversions."""
    return [
        F.when(_booking(), F.col("value")).otherwise(F.lit(0.0)).alias("revenue"),
        _booking().cast("bigint").alias("bookings"),
        _soft().cast("bigint").alias("soft_conversions"),
    ]


def conversion_totals(conversions: DataFrame) -> DataFrame:
    """Booking revenue, bookings and soft conversions per (date, ad set)."""
    sums = ["revenue", "bookings", "soft_conversions"]
    values = conversions.select(*S.KEYS, *_conversion_values())
    return values.groupBy(*S.KEYS).agg(
        F.sum("revenue").alias("revenue"),
        # A conversion without a type is neither.
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in sums[1:]],
    )


def _spine(performance: DataFrame, budget: DataFrame, conversions: DataFrame) -> DataFrame:
    """Every key of the three inputs once, with conversion totals and row counts."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = [
        performance.dropna(subset=S.KEYS).select(
            *S.KEYS,
            F.lit(None).cast("double").alias("revenue"),
            none.alias("bookings"),
            none.alias("soft_conversions"),
            one.alias("n0"),
            none.alias("n1"),
        ),
        budget.dropna(subset=S.KEYS).select(
            *S.KEYS,
            F.lit(None).cast("double").alias("revenue"),
            none.alias("bookings"),
            none.alias("soft_conversions"),
            none.alias("n0"),
            one.alias("n1"),
        ),
        conversions.select(
            *S.KEYS,
            *_conversion_values(),
            none.alias("n0"),
            none.alias("n1"),
        ),
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    sums = ["revenue", "bookings", "soft_conversions", "n0", "n1"]
    return rows.groupBy(*S.KEYS).agg(*[F.sum(c).alias(c) for c in sums])


def _finish(df: DataFrame) -> DataFrame:
    """Fill the gaps of the outer join and derive ROAS and CPA."""
    zeros = _PERFORMANCE_ZEROS | _BUDGET_ZEROS | {"revenue": 0.0, "bookings": 0, "soft_conversions": 0}
    filled = {c: F.coalesce(F.col(c), F.lit(z)) for c, z in zeros.items()}
    filled["pacing_status"] = F.coalesce(F.col("pacing_status"), F.lit(S.UNKNOWN))
    return df.withColumns(filled).select(
        *S.KEYS,
        "ad_set_name",
        *_PERFORMANCE_ZEROS,
        *_BUDGET_ZEROS,
        "pacing_status",
        "revenue",
        "bookings",
        "soft_conversions",
        ratio("revenue", "spend").alias("roas"),
        ratio("spend", "bookings").alias("cpa"),
    )


def daily_metrics(
    performance: DataFrame, budget: DataFrame, conversions: DataFrame, **hot: float
) -> DataFrame:
    """Three-way full outer join on (date, ad set), row for row.

    Performance and budget may repeat a key; then their rows pair up, and the
    key's conversion totals appear on each pair, as the join semantics say. The
    join starts from a spine holding every key once, so a full outer join becomes
    left joins whose hot keys can be salted (`hot`: see `join_many`).
    """
    wide = [*S.KEYS, "ad_set_name", *_PERFORMANCE_ZEROS]
    money = [*S.KEYS, *_BUDGET_ZEROS, "pacing_status"]
    performance, budget = performance.select(*wide), budget.select(*money)
    spine = kept(_spine(performance, budget, conversions))
    joined = join_many(
        spine.drop("n0", "n1"),
        [performance.dropna(subset=S.KEYS), budget.dropna(subset=S.KEYS)],
        S.KEYS,
        sizes=spine.select(*S.KEYS, "n0", "n1"),
        **hot,
    )
    # A null key matches nothing, so such rows stand alone.
    null_key = F.greatest(*[F.col(k).isNull() for k in S.KEYS])
    for side in (performance, budget):
        joined = joined.unionByName(side.filter(null_key), allowMissingColumns=True)
    return _finish(joined)


def daily_metrics_by_key(
    performance: DataFrame, budget: DataFrame, conversions: DataFrame
) -> DataFrame:
    """The same columns with one row per (date, ad set): nothing is counted twice.

    Amounts of a repeated key are summed and its rates averaged, in one
    aggregation over the three inputs, which takes a single exchange.
    """
    values = [
        "ad_set_name",
        *_PERFORMANCE_ZEROS,
        *_BUDGET_ZEROS,
        "pacing_status",
        "revenue",
        "bookings",
        "soft_conversions",
    ]
    events = conversions.select(*S.KEYS, *_conversion_values())
    rows = (
        performance.select(*S.KEYS, "ad_set_name", *_PERFORMANCE_ZEROS)
        .unionByName(
            budget.select(*S.KEYS, *_BUDGET_ZEROS, "pacing_status"), allowMissingColumns=True
        )
        .unionByName(events, allowMissingColumns=True)
    )
    averaged = {"ctr", "cpm", "frequency", "budget_utilization"}
    texts = {"ad_set_name", "pacing_status"}

    def combine(c: str) -> Column:
        if c in texts:
            return F.max(c).alias(c)
        return (F.avg(c) if c in averaged else F.sum(c)).alias(c)

    return _finish(rows.groupBy(*S.KEYS).agg(*[combine(c) for c in values]))


def training_set(daily: DataFrame) -> DataFrame:
    """Bookings regression table: features, the encoded status and the target."""
    return daily.select(
        *S.KEYS,
        "ad_set_name",
        *_PERFORMANCE_ZEROS,
        *_BUDGET_ZEROS,
        pacing_index().alias("pacing_status_idx"),
        "soft_conversions",
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("bookings", F.lit(0)).alias("target_bookings"),
    )
