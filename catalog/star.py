"""The four raw campaign tables, derived from the star-schema test tables.

A customer stands for an ad set; views, clicks and errors are its delivery (an
error is a refund, so spend can turn negative), purchases and signups are its
conversions, the account balance is its budget. Delivery is reported per half
day, so keys repeat; some rows lack their ad set.

The functions return lazy plans, so keeping a plan per folder keeps no data.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.sources import schemas as S

WINDOWS = ["1_day_click", "1_day_view", "7_Day_Click"]


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_text(c: str = "ts") -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def _id(lost_remainder: int | None = None) -> Column:
    text = F.col("user_id").cast("string")
    if lost_remainder is None:
        return text
    return F.when(F.col("user_id") % 75 != lost_remainder, text)


def _text(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in S.RAW_TYPES[name]])


@cache
def raw_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    shown = F.count_if(kind == "view")
    cost = F.when(kind == "error", -value).otherwise(value)
    rows = (
        table(spark, sf_dir, "events")
        .filter(kind.isin("view", "click", "error"))
        .groupBy(F.to_date("ts").alias("day"), "user_id", (F.hour("ts") < 12).alias("morning"))
        .agg(
            F.nullif(shown, F.lit(0)).alias("impressions"),
            F.count_if(kind == "click").alias("clicks"),
            F.round(F.sum(cost), 2).alias("spend"),
            F.max(value).alias("ctr"),
            F.min(value).alias("cpm"),
            (F.count(F.lit(1)) / 2.0).alias("frequency"),
        )
        .withColumns(
            {
                "date": _day_text("day"),
                "ad_set_id": _id(0),
                "ad_set_name": F.concat(F.lit("Ad set "), F.col("user_id").cast("string")),
            }
        )
    )
    return _text(rows, S.PERFORMANCE)


@cache
def raw_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = F.when(F.col("event_type").isin("view", "click"), F.col("value")).otherwise(F.lit(0.0))
    days = (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("day"), "user_id")
        .agg(F.round(F.sum(paid), 2).alias("actual_spend"))
    )
    customer = table(spark, sf_dir, "customer")
    planned = F.greatest("c_acctbal", F.lit(0.0)) / 100
    used = F.when(F.col("planned_spend") > 0, F.col("actual_spend") / F.col("planned_spend"))
    status = (
        F.when(F.col("budget_utilization") < 0.9, "Under_Pacing")
        .when(F.col("budget_utilization") <= 1.1, "on_pace")
        .when(F.col("budget_utilization") > 1.1, "over_pacing")
        .otherwise("n/a")
    )
    rows = (
        days.join(customer, F.col("user_id") == F.col("c_custkey"))
        .withColumn("planned_spend", planned)
        .withColumn("budget_utilization", used)
        .withColumns({"pacing_status": status, "date": _day_text("day"), "ad_set_id": _id(1)})
    )
    return _text(rows, S.BUDGET)


@cache
def raw_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, bought = F.col("event_id"), F.col("event_type") == "purchase"
    soft = F.element_at(
        F.array(*[F.lit(x) for x in S.SOFT_CONVERSIONS]), (n % 5 + 1).cast("int")
    )
    booking = F.when(n % 10 == 0, F.lit(S.BOOKING.upper())).otherwise(F.lit(S.BOOKING))
    rows = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("purchase", "signup"))
        .withColumns(
            {
                "conversion_id": F.concat(F.lit("CV_"), n.cast("string")),
                "date": _day_text(),
                "ad_set_id": _id(),
                "conversion_type": F.when(bought, booking).otherwise(soft),
                "value": F.when(F.col("value") >= 1, F.col("value")),
                "attribution_window": F.element_at(
                    F.array(*[F.lit(x) for x in WINDOWS]), (n % 3 + 1).cast("int")
                ),
                "user_segment": F.concat(F.lit("seg_"), (n % 8).cast("string")),
            }
        )
    )
    return _text(rows, S.CONVERSIONS)


@cache
def raw_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ad_set_id"),
        F.col("c_name").alias("ad_set_name"),
        F.lit("25-45").alias("target_age"),
        F.col("c_mktsegment").alias("target_interests"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("lookalike_source"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("daily_budget"),
    )
    return _text(rows, S.AUDIENCE)


RAW = {
    S.PERFORMANCE: raw_performance,
    S.BUDGET: raw_budget,
    S.CONVERSIONS: raw_conversions,
    S.AUDIENCE: raw_audience,
}


@cache
def sales_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as gold rows: a supplier is an ad set, discount its spend.

    Amounts are whole pounds: their sums are exact in any order of addition.
    """
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").cast("string").alias("ad_set_id"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.round(price * discount).alias("spend"),
        F.round(price * (1 - discount)).alias("revenue"),
        (F.col("l_tax") * 100).alias("ctr"),
        F.col("l_linenumber").alias("bookings"),
        F.when(F.col("l_returnflag") == "R", "under_pacing")
        .when(F.col("l_returnflag") == "A", "on_pace")
        .when(F.col("l_linestatus") == "O", "over_pacing")
        .otherwise("unknown")
        .alias("pacing_status"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )
