"""Bronze to silver for the conformed layers: casts, fixes, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.functions.measures import conform, rate_per, to_number, without_negative
from pacewise.sources import schemas as S


def clean_performance(df: DataFrame) -> DataFrame:
    counts = {c: to_number(c, "bigint") for c in ["impressions", "clicks"]}
    amounts = {c: to_number(c) for c in ["spend", "ctr", "cpm", "frequency"]}
    return (
        df.withColumns(counts | amounts)
        .withColumn("spend", without_negative("spend"))
        .dropna(subset=[S.AD_SET, S.DATE])
        .withColumns(
            {
                "ctr": rate_per("clicks", "impressions", 100.0, keep="ctr"),
                "cpm": rate_per("spend", "impressions", 1000.0, keep="cpm"),
            }
        )
        .dropDuplicates()
    )


def clean_budget(df: DataFrame) -> DataFrame:
    amounts = ["planned_spend", "actual_spend", "budget_utilization"]
    return (
        df.withColumns({c: to_number(c) for c in amounts})
        .withColumn("pacing_status", conform("pacing_status", S.PACING_STATUSES))
        .dropDuplicates()
    )


def clean_conversions(df: DataFrame) -> DataFrame:
    return (
        df.withColumns(
            {
                "value": F.coalesce(to_number("value"), F.lit(0.0)),
                "conversion_type": F.lower("conversion_type"),
                "attribution_window": F.lower("attribution_window"),
            }
        )
        .dropna(subset=[S.AD_SET, S.DATE])
        .dropDuplicates()
    )
