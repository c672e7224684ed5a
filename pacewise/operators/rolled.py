"""Silver and gold tables of the rolled-up layers: daily sums, labels, training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.functions.measures import at_least_zero, day, flag, pacing_band, ratio
from pacewise.operators.skew import join_many
from pacewise.operators.windows import forward_count, next_row_value
from pacewise.sources import schemas as S

BY_AD_SET = [S.AD_SET, S.DATE]


def with_day(bronze: DataFrame) -> DataFrame:
    """Strict day-first parse of the date text; a bad date is an error."""
    return bronze.withColumn(S.DATE, day(S.DATE, strict=True))


def performance_by_day(bronze: DataFrame) -> DataFrame:
    """Sums of counts and spend, means of reported rates, per (date, ad set)."""
    return (
        with_day(bronze)
        .groupBy(*S.KEYS)
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum(at_least_zero("spend")).alias("spend"),
            F.avg("ctr").alias("ctr"),
            F.avg("cpm").alias("cpm"),
            F.avg("frequency").alias("frequency"),
        )
    )


def revenue_by_day(bronze: DataFrame) -> DataFrame:
    booked = (F.col("conversion_type") == S.BOOKING) & F.col("value").isNotNull()
    return (
        with_day(bronze)
        .groupBy(*S.KEYS)
        .agg(F.sum(F.when(booked, F.col("value")).otherwise(F.lit(0.0))).alias("revenue"))
    )


def conversion_days(bronze: DataFrame) -> DataFrame:
    """Conversion events with a parsed `conv_date`."""
    return bronze.select(
        S.AD_SET, day(S.DATE, strict=True).alias("conv_date"), "conversion_type", "value"
    )


def silver_daily(performance: DataFrame, revenue: DataFrame) -> DataFrame:
    """Daily performance with revenue and ROAS (0.0 without spend)."""
    earned = F.coalesce("revenue", F.lit(0.0))
    return performance.join(revenue, BY_AD_SET, "left").select(
        S.AD_SET,
        S.DATE,
        "impressions",
        "clicks",
        "spend",
        "ctr",
        "cpm",
        "frequency",
        earned.alias("revenue"),
        ratio(earned, "spend", empty=0.0).alias("roas"),
    )


def budget_pacing(bronze_budget: DataFrame, bronze_audience: DataFrame) -> DataFrame:
    """Pacing ratio with the ad set's budget.

    Ad sets can be many, so nothing is forced into a broadcast: Spark broadcasts
    the audience side only if it measures it as small, and otherwise splits a hot
    ad set of the left side at run time.
    """
    return (
        with_day(bronze_budget)
        .join(bronze_audience.select(S.AD_SET, "daily_budget"), S.AD_SET, "left")
        .select(
            S.DATE,
            S.AD_SET,
            F.coalesce("daily_budget", F.lit(0.0)).alias("daily_budget"),
            F.col("budget_utilization").cast("double").alias("pacing_ratio"),
        )
    )


def audience_segments(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        S.AD_SET,
        "ad_set_name",
        "target_age",
        "target_interests",
        "lookalike_source",
        F.coalesce("daily_budget", F.lit(0.0)).alias("daily_budget"),
    )


def conversions_7d(performance: DataFrame, conversions: DataFrame) -> DataFrame:
    """Conversions of the ad set from the day to seven days later, both inclusive."""
    return forward_count(performance, conversions, "conv_date")


def adset_pacing(budget: DataFrame) -> DataFrame:
    """Pacing ratio, the next row's ratio and the band."""
    return next_row_value(budget, "pacing_ratio").select(
        S.AD_SET,
        S.DATE,
        "pacing_ratio",
        "next_pacing_ratio",
        pacing_band().alias("pacing_status"),
    )


def conversion_labels(performance: DataFrame, conv_7d: DataFrame) -> DataFrame:
    """Seven-day conversion rate and 0/1 label per performance row."""
    return performance.join(conv_7d, BY_AD_SET, "left").select(
        S.AD_SET, S.DATE, "conv_7d", *_label_columns()
    )


def _label_columns() -> list[Column]:
    return [
        ratio("conv_7d", "impressions", empty=0.0).alias("conv_next7d_rate"),
        flag(F.col("conv_7d") > 0).alias("conv_next7d_label"),
    ]


def training_table(
    performance: DataFrame,
    audience: DataFrame,
    pacing: DataFrame,
    conv_7d: DataFrame,
    revenue: DataFrame,
    drop_last: bool = False,
    **hot: float,
) -> DataFrame:
    """Performance joined with audience, pacing, conversions, labels and revenue.

    Labels follow from the joined conversion count, so their table is not joined
    again. Performance, conversions and revenue have one row per key; pacing may
    repeat one, which multiplies rows, so its join can be salted (`hot`: see
    `join_many`). The last row of an ad set has no next ratio and gets label 0, or
    is left out with `drop_last`.
    """
    spine = (
        performance.select(*BY_AD_SET, "ctr", "impressions", "clicks", "spend")
        .join(conv_7d, BY_AD_SET, "left")
        .join(revenue, BY_AD_SET, "left")
    )
    side = pacing.dropna(subset=BY_AD_SET).select(*BY_AD_SET, "pacing_ratio", "next_pacing_ratio")
    joined = join_many(spine, [side], BY_AD_SET, **hot).join(
        audience.select(S.AD_SET, F.col("daily_budget").alias("aud_daily_budget")),
        S.AD_SET,
        "left",
    )
    if drop_last:
        joined = joined.filter(F.col("next_pacing_ratio").isNotNull())
    earned = F.coalesce("revenue", F.lit(0.0))
    return joined.select(
        S.DATE,
        S.AD_SET,
        "ctr",
        "impressions",
        "clicks",
        "spend",
        "aud_daily_budget",
        "pacing_ratio",
        "conv_7d",
        earned.alias("revenue"),
        ratio(earned, "spend", empty=0.0).alias("roas"),
        *_label_columns(),
        flag(F.col("next_pacing_ratio") < S.UNDER_BELOW).alias("label_under_pacing_next"),
    )
