"""Queries over the layers: sources, cleaners, joins, aggregates, windows, quality."""

from __future__ import annotations

from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import star
from catalog.registry import Registry
from pacewise.functions import measures as M
from pacewise.operators import clean, conformed, quality, rolled
from pacewise.operators import windows as win
from pacewise.session import cut, ensure_checkpoint_dir, kept
from pacewise.sources import readers, schemas as S
from pacewise.sources.tables import export_csv, register, row_counts

DAILY_DIGITS = {
    "spend": 4,
    "ctr": 6,
    "cpm": 6,
    "planned_spend": 4,
    "actual_spend": 4,
    "budget_utilization": 6,
    "revenue": 4,
}
DAILY_BY_KEY = """SELECT *, CASE WHEN spend > 0 THEN revenue / spend END AS roas,
       CASE WHEN bookings > 0 THEN spend / bookings END AS cpa
FROM (
  SELECT date, ad_set_id, max(ad_set_name) AS ad_set_name,
         CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions,
         CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks,
         coalesce(sum(spend), 0::DOUBLE) AS spend, coalesce(avg(ctr), 0) AS ctr,
         coalesce(avg(cpm), 0) AS cpm, coalesce(avg(frequency), 0) AS frequency,
         coalesce(sum(planned_spend), 0::DOUBLE) AS planned_spend,
         coalesce(sum(actual_spend), 0::DOUBLE) AS actual_spend,
         coalesce(avg(budget_utilization), 0) AS budget_utilization,
         coalesce(max(pacing_status), 'unknown') AS pacing_status,
         coalesce(sum(revenue), 0::DOUBLE) AS revenue,
         CAST(coalesce(sum(bookings), 0) AS BIGINT) AS bookings,
         CAST(coalesce(sum(soft_conversions), 0) AS BIGINT) AS soft_conversions
  FROM (SELECT * FROM slv_performance UNION ALL BY NAME SELECT * FROM slv_budget
        UNION ALL BY NAME SELECT * FROM conversion_totals)
  GROUP BY date, ad_set_id)"""
BY_KEY_DIGITS = DAILY_DIGITS | {"frequency": 6, "roas": 6, "cpa": 6}
# Treats every key as hot, so that the salted join runs on the test tables too.
SALT_ALL = {"rows_per_part": 0.5, "copies_per_piece": 1}


# --- frames the queries start from ----------------------------------------------


@cache
def bronze(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Raw text with its date parsed, as the conformed layers load it."""
    raw = star.RAW[table](spark, d)
    return raw.withColumn(S.DATE, M.day(S.DATE)) if S.DATE in raw.columns else raw


@cache
def typed(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Raw text cast column by column, dates still text, as the rolled layers load it."""
    return readers.cast_table(star.RAW[table](spark, d), table)


@cache
def slv_performance(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_performance(bronze(spark, d, S.PERFORMANCE))


@cache
def slv_budget(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_budget(bronze(spark, d, S.BUDGET))


@cache
def slv_conversions(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_conversions(bronze(spark, d, S.CONVERSIONS))


@cache
def silver_tables(spark: SparkSession, d: str) -> list[DataFrame]:
    """Performance, budget and conversions, written down once, as the plans do."""
    return [kept(f(spark, d)) for f in (slv_performance, slv_budget, slv_conversions)]


def gld_daily(spark: SparkSession, d: str, **options) -> DataFrame:
    return conformed.daily_metrics(*silver_tables(spark, d), **options)


@cache
def perf(spark: SparkSession, d: str) -> DataFrame:
    return rolled.performance_by_day(typed(spark, d, S.PERFORMANCE))


@cache
def rev(spark: SparkSession, d: str) -> DataFrame:
    return rolled.revenue_by_day(typed(spark, d, S.CONVERSIONS))


@cache
def conv(spark: SparkSession, d: str) -> DataFrame:
    return rolled.conversion_days(typed(spark, d, S.CONVERSIONS))


@cache
def pace(spark: SparkSession, d: str) -> DataFrame:
    return rolled.budget_pacing(typed(spark, d, S.BUDGET), typed(spark, d, S.AUDIENCE))


@cache
def pacing(spark: SparkSession, d: str) -> DataFrame:
    """All budget rows; those without an ad set follow each other as one more ad set."""
    return rolled.adset_pacing(pace(spark, d))


@cache
def conv7(spark: SparkSession, d: str) -> DataFrame:
    return rolled.conversions_7d(perf(spark, d), conv(spark, d))


@cache
def daily_b(spark: SparkSession, d: str) -> DataFrame:
    return rolled.silver_daily(perf(spark, d), rev(spark, d))


def train(spark: SparkSession, d: str, **options) -> DataFrame:
    return rolled.training_table(
        perf(spark, d),
        rolled.audience_segments(typed(spark, d, S.AUDIENCE)),
        cut(pacing(spark, d)),
        conv7(spark, d),
        rev(spark, d),
        **options,
    )


def _csv_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/csv-{uuid4().hex}"


def _csv_strict(spark: SparkSession, d: str) -> DataFrame:
    path = _csv_folder(spark)
    export_csv(star.raw_performance(spark, d), path)
    return readers.read_strict(spark, path, S.PERFORMANCE, S.DATE)


def _csv_tolerant(spark: SparkSession, d: str) -> DataFrame:
    path = _csv_folder(spark)
    export_csv(star.raw_conversions(spark, d), path)
    there = readers.read_tolerant(spark, path, S.CONVERSIONS)
    missing = readers.read_tolerant(spark, f"{path}-missing", S.CONVERSIONS)
    return readers.cast_table(there.unionByName(missing), S.CONVERSIONS)


def _through_view(spark: SparkSession, d: str) -> DataFrame:
    view = f"audience_{uuid4().hex}"
    register(typed(spark, d, S.AUDIENCE), view)
    return spark.table(view)


def _raw_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Event properties as text: part number, part not."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    count = F.when(F.col("event_id") % 5 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
    return star.table(spark, d, "events").select(
        "event_id",
        value.alias("value"),
        F.coalesce(count, F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("string"))).alias(
            "user_id"
        ),
    )


def add_to(r: Registry) -> None:
    sources(r)
    expressions(r)
    conformed_layers(r)
    rolled_layers(r)
    quality_checks(r)


def sources(r: Registry) -> None:
    r.add(
        "s01_csv_strict",
        lambda s, d: readers.cast_columns(
            _csv_strict(s, d),
            {c: t for c, t in S.RAW_TYPES[S.PERFORMANCE].items() if c != S.DATE},
        ),
        "SELECT * FROM raw_performance",
    )
    r.add(
        "s02_csv_tolerant",
        _csv_tolerant,
        "SELECT * REPLACE (strftime(date, '%d/%m/%Y') AS date) FROM raw_conversions",
    )
    r.add(
        "s03_cast_table",
        lambda s, d: typed(s, d, S.BUDGET),
        "SELECT * REPLACE (strftime(date, '%d/%m/%Y') AS date) FROM raw_budget",
    )
    r.add(
        "s04_cast_all_but_keys",
        lambda s, d: readers.cast_all_but(star.raw_budget(s, d), S.KEYS),
        """SELECT strftime(date, '%d/%m/%Y') AS date, ad_set_id, planned_spend, actual_spend,
                  budget_utilization, CAST(NULL AS DOUBLE) AS pacing_status FROM raw_budget""",
    )
    r.add(
        "s05_full_scan",
        lambda s, d: slv_conversions(s, d),
        "SELECT * FROM slv_conversions",
    )
    r.add(
        "s06_projected_scan",
        lambda s, d: train(s, d).select(S.AD_SET, S.DATE, "clicks", "conv_7d", "pacing_ratio"),
        "SELECT ad_set_id, date, clicks, conv_7d, pacing_ratio FROM train",
    )
    r.add("s07_view", _through_view, "SELECT * FROM raw_audience")
    r.add(
        "s15_row_counts",
        lambda s, d: row_counts(
            {"performance": perf(s, d), "revenue": rev(s, d), "pacing": pace(s, d)}
        ),
        """SELECT 'performance' AS table_name, count(*) AS row_count FROM perf
           UNION ALL SELECT 'revenue', count(*) FROM rev
           UNION ALL SELECT 'pacing', count(*) FROM pace""",
    )


def expressions(r: Registry) -> None:
    r.add(
        "f01_safe_numbers",
        lambda s, d: readers.cast_columns(
            _raw_numbers(s, d), {"value": "double", "user_id": "bigint"}
        ),
        """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
                  CASE WHEN event_id % 5 = 0 OR event_id % 11 <> 0 THEN user_id END AS user_id
           FROM events""",
    )
    r.add(
        "f02_no_negative_spend",
        lambda s, d: star.table(s, d, "customer").select(
            "c_custkey",
            M.without_negative(F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))).alias("kept"),
            M.at_least_zero(F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))).alias("floored"),
        ),
        """SELECT c_custkey,
                  CASE WHEN c_custkey % 9 <> 0 THEN
                       CASE WHEN c_acctbal < 0 THEN 0::DOUBLE ELSE c_acctbal END END AS kept,
                  CASE WHEN c_custkey % 9 <> 0 AND c_acctbal > 0 THEN c_acctbal
                       ELSE 0::DOUBLE END AS floored
           FROM customer""",
    )
    r.add(
        "f03_known_keys",
        lambda s, d: bronze(s, d, S.PERFORMANCE).dropna(subset=[S.AD_SET, S.DATE]).select(*S.KEYS),
        "SELECT date, ad_set_id FROM raw_performance WHERE ad_set_id IS NOT NULL",
    )
    r.add(
        "f04_f05_recomputed_rates",
        lambda s, d: readers.cast_columns(
            bronze(s, d, S.PERFORMANCE),
            {"impressions": "bigint", "clicks": "bigint", "spend": "double", "ctr": "double", "cpm": "double"},
        ).select(
            *S.KEYS,
            "impressions",
            M.rate_per("clicks", "impressions", 100.0, keep="ctr").alias("ctr"),
            M.rate_per("spend", "impressions", 1000.0, keep="cpm").alias("cpm"),
        ),
        """SELECT date, ad_set_id, impressions,
                  CASE WHEN impressions > 0 THEN clicks * 100.0::DOUBLE / impressions ELSE ctr END AS ctr,
                  CASE WHEN impressions > 0 THEN spend * 1000.0::DOUBLE / impressions ELSE cpm END AS cpm
           FROM raw_performance""",
        {"ctr": 6, "cpm": 6},
    )
    r.add(
        "f06_f07_conformed_status",
        lambda s, d: slv_budget(s, d).groupBy("pacing_status").agg(F.count(F.lit(1)).alias("n")),
        "SELECT pacing_status, count(*) AS n FROM slv_budget GROUP BY ALL",
    )
    r.add(
        "f08_filled_values",
        lambda s, d: slv_conversions(s, d).select("conversion_id", "value"),
        "SELECT conversion_id, value FROM slv_conversions",
    )
    r.add(
        "f09_strict_day",
        lambda s, d: rolled.with_day(star.raw_conversions(s, d)).select("conversion_id", S.DATE),
        "SELECT conversion_id, date FROM raw_conversions",
    )
    r.add(
        "f10_audience_defaults",
        lambda s, d: rolled.audience_segments(typed(s, d, S.AUDIENCE)),
        "SELECT * FROM aud",
    )
    r.add(
        "f15_pacing_index",
        lambda s, d: slv_budget(s, d).select(*S.KEYS, M.pacing_index().alias("idx")),
        """SELECT date, ad_set_id, CAST(coalesce(list_position(
                  ['under_pacing', 'on_pace', 'over_pacing'], pacing_status), 4) - 1 AS INTEGER)
                  AS idx FROM slv_budget""",
    )
    r.add(
        "f16_pacing_band",
        lambda s, d: pace(s, d).select(*S.KEYS, M.pacing_band().alias("band")),
        """SELECT date, ad_set_id, CASE WHEN pacing_ratio IS NULL OR pacing_ratio > 1.1 THEN 'over'
                  WHEN pacing_ratio >= 0.9 THEN 'on' ELSE 'under' END AS band FROM pace""",
    )
    r.add(
        "f17_under_pacing_label",
        lambda s, d: slv_budget(s, d).select(
            *S.KEYS, M.flag(F.col("pacing_status") == "under_pacing").alias("label")
        ),
        """SELECT date, ad_set_id, CAST(pacing_status = 'under_pacing' AS INTEGER) AS label
           FROM slv_budget""",
    )


def conformed_layers(r: Registry) -> None:
    r.add(
        "p05_silver_performance",
        slv_performance,
        "SELECT * FROM slv_performance",
        {"ctr": 6, "cpm": 6},
    )
    r.add("p05_silver_budget", slv_budget, "SELECT * FROM slv_budget")
    r.add("g04_silver_conversions", slv_conversions, "SELECT * FROM slv_conversions")
    r.add(
        "g01_conversion_totals",
        lambda s, d: conformed.conversion_totals(slv_conversions(s, d)),
        "SELECT * FROM conversion_totals",
        {"revenue": 4},
    )
    r.add(
        "j01_full_outer_daily",
        lambda s, d: gld_daily(s, d).drop("roas", "cpa"),
        "SELECT * FROM gld_joined",
        DAILY_DIGITS,
    )
    r.add(
        "j01_full_outer_salted",
        lambda s, d: gld_daily(s, d, **SALT_ALL).drop("roas", "cpa"),
        "SELECT * FROM gld_joined",
        DAILY_DIGITS,
    )
    r.add(
        "p06_daily_metrics",
        gld_daily,
        "SELECT * FROM gld_daily",
        DAILY_DIGITS | {"roas": 6, "cpa": 6},
    )
    r.add(
        "p06_daily_metrics_by_key",
        lambda s, d: conformed.daily_metrics_by_key(
            slv_performance(s, d), slv_budget(s, d), slv_conversions(s, d)
        ),
        DAILY_BY_KEY,
        BY_KEY_DIGITS,
    )
    r.add(
        "f11_f12_roas_and_cpa",
        lambda s, d: gld_daily(s, d).select(*S.KEYS, "spend", "bookings", "roas", "cpa"),
        "SELECT date, ad_set_id, spend, bookings, roas, cpa FROM gld_daily",
        {"roas": 6, "cpa": 6},
    )
    r.add(
        "f14_merged_keys",
        lambda s, d: gld_daily(s, d).groupBy(*S.KEYS).agg(F.count(F.lit(1)).alias("n")),
        "SELECT date, ad_set_id, count(*) AS n FROM gld_daily GROUP BY ALL",
    )
    r.add(
        "p07_training_set",
        lambda s, d: conformed.training_set(gld_daily(s, d)),
        "SELECT * FROM gld_training",
        DAILY_DIGITS,
    )
    r.add(
        "t01_ordered_daily",
        lambda s, d: gld_daily(s, d)
        .select(*S.KEYS, "clicks", "bookings")
        .sortWithinPartitions(*S.KEYS),
        "SELECT date, ad_set_id, clicks, bookings FROM gld_daily ORDER BY 1, 2",
    )


def rolled_layers(r: Registry) -> None:
    rates = {"spend": 4, "ctr": 6, "cpm": 6, "frequency": 6}
    r.add("g03_performance_by_day", perf, "SELECT * FROM perf", rates)
    r.add("g02_revenue_by_day", rev, "SELECT * FROM rev", {"revenue": 4})
    r.add("p08_conversion_days", conv, "SELECT * FROM conv")
    r.add(
        "j02_performance_with_revenue",
        lambda s, d: daily_b(s, d).drop("roas"),
        "SELECT * EXCLUDE (roas) FROM daily_b",
        rates | {"revenue": 4},
    )
    r.add("j05_silver_daily", daily_b, "SELECT * FROM daily_b", rates | {"revenue": 4, "roas": 6})
    r.add(
        "f13_roas_zero_without_spend",
        lambda s, d: daily_b(s, d).select(*S.KEYS, "roas"),
        "SELECT date, ad_set_id, roas FROM daily_b",
        {"roas": 6},
    )
    r.add(
        "f29_roas_identity",
        lambda s, d: daily_b(s, d)
        .filter("spend > 0")
        .agg(
            F.count(F.lit(1)).alias("checked"),
            F.count_if(F.abs(F.col("revenue") / F.col("spend") - F.col("roas")) > 1e-6).alias(
                "wrong"
            ),
        ),
        """SELECT count(*) AS checked, count(*) FILTER (abs(revenue / spend - roas) > 1e-6) AS wrong
           FROM daily_b WHERE spend > 0""",
    )
    r.add("j03_j07_budget_pacing", pace, "SELECT * FROM pace")
    r.add("w03_forward_7d_count", conv7, "SELECT * FROM conv7")
    r.add(
        "j08_interval_join_count",
        lambda s, d: win.forward_count_join(perf(s, d), conv(s, d), "conv_date"),
        "SELECT * FROM conv7",
    )
    r.add(
        "g05_distinct_keys",
        lambda s, d: rolled.with_day(star.raw_performance(s, d)).select(*S.KEYS).distinct(),
        "SELECT DISTINCT date, ad_set_id FROM raw_performance",
    )
    r.add("w01_next_pacing", pacing, "SELECT * FROM pacing")
    r.add(
        "j04_conversion_labels",
        lambda s, d: rolled.conversion_labels(perf(s, d), conv7(s, d)),
        "SELECT * FROM labels_b",
        {"conv_next7d_rate": 6},
    )
    r.add(
        "f18_rate_and_label",
        lambda s, d: rolled.conversion_labels(perf(s, d), conv7(s, d)).select(
            *S.KEYS, "conv_next7d_rate", "conv_next7d_label"
        ),
        "SELECT date, ad_set_id, conv_next7d_rate, conv_next7d_label FROM labels_b",
        {"conv_next7d_rate": 6},
    )
    digits = {"ctr": 6, "spend": 4, "revenue": 4, "roas": 6, "conv_next7d_rate": 6}
    r.add("j06_training_table", train, "SELECT * FROM train", digits)
    r.add(
        "j06_training_table_salted",
        lambda s, d: train(s, d, **SALT_ALL),
        "SELECT * FROM train",
        digits,
    )
    r.add(
        "f19_next_day_label",
        lambda s, d: train(s, d, drop_last=True).select(*S.KEYS, "label_under_pacing_next"),
        """SELECT t.date, t.ad_set_id, t.label_under_pacing_next FROM train t
           JOIN pacing p USING (ad_set_id, date) WHERE p.next_pacing_ratio IS NOT NULL""",
    )
    r.add(
        "x01_forward_bounds",
        lambda s, d: conv(s, d).select(
            "conv_date",
            F.date_add("conv_date", S.FORWARD_DAYS).alias("reach"),
            F.col("conv_date").between(F.lit("2024-01-05"), F.lit("2024-01-20")).alias("inside"),
        ),
        """SELECT conv_date, conv_date + 7 AS reach,
                  conv_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AS inside FROM conv""",
    )


def quality_checks(r: Registry) -> None:
    r.add(
        "g06_key_duplicates",
        lambda s, d: quality.key_duplicates(slv_performance(s, d), S.KEYS),
        """SELECT date, ad_set_id, count(*) AS row_count FROM slv_performance
           GROUP BY ALL HAVING count(*) > 1""",
    )
    r.add(
        "g06_key_count",
        lambda s, d: quality.key_count(daily_b(s, d), rolled.BY_AD_SET),
        """SELECT count(*) AS row_count, count(DISTINCT (ad_set_id, date)) AS key_count
           FROM daily_b""",
    )
    columns = {
        "date": "date",
        "ad_set_id": "string",
        "ad_set_name": "string",
        "impressions": "bigint",
        "clicks": "bigint",
        "spend": "double",
        "ctr": "double",
        "cpm": "double",
        "frequency": "double",
        "planned_spend": "double",
        "actual_spend": "double",
        "budget_utilization": "double",
        "pacing_status": "string",
        "revenue": "double",
        "bookings": "bigint",
        "soft_conversions": "bigint",
        "roas": "double",
        "cpa": "double",
    }

    def stats(column: str, kind: str, table: str) -> str:
        x = column if kind in ("double", "bigint") else "CAST(NULL AS DOUBLE)"
        return f"""SELECT '{column}' AS column_name, '{kind}' AS dtype,
                   (count(*) - count({column}))::DOUBLE / count(*) AS null_fraction,
                   avg({x}) AS mean, stddev_samp({x}) AS std,
                   CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max FROM {table}"""

    profiled = " UNION ALL ".join(stats(c, k, "gld_daily") for c, k in columns.items())
    digits = {"null_fraction": 6, "mean": 6, "std": 6, "min": 6, "max": 6}
    r.add(
        "g07_profile",
        lambda s, d: quality.profile(gld_daily(s, d)).drop("generated_at"),
        profiled,
        digits,
    )
    r.add(
        "g08_u01_quality_summary",
        lambda s, d: quality.summarise(
            [
                ("silver_daily", daily_b(s, d), ["spend", "impressions", "revenue"]),
                ("budget_pacing", pace(s, d), ["pacing_ratio"]),
            ]
        ).drop("generated_at"),
        " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS dtype,
                count(*) FILTER ({c} IS NULL)::DOUBLE / nullif(count(*), 0) AS null_fraction,
                CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
                avg({c}) AS mean, stddev({c}) AS std FROM {table}"""
            for name, table, c, kind in [
                ("silver_daily", "daily_b", "spend", "double"),
                ("silver_daily", "daily_b", "impressions", "bigint"),
                ("silver_daily", "daily_b", "revenue", "double"),
                ("budget_pacing", "pace", "pacing_ratio", "double"),
            ]
        ),
        digits,
    )
    r.add(
        "g09_checks_passed",
        lambda s, d: quality.checks_passed(quality.profile(gld_daily(s, d))),
        f"""SELECT count(*) FILTER (null_fraction = 0) AS checks_ok, count(*) AS checks_total
            FROM ({profiled})""",
    )
    r.add(
        "g10_f28_issues",
        lambda s, d: quality.titled(
            quality.issues(quality.profile(gld_daily(s, d))).select(
                "column_name", "dtype", F.round("null_fraction", 6).alias("null_fraction")
            )
        ),
        f"""SELECT column_name AS "Column", dtype AS "Type",
                   round(null_fraction, 6) AS "Null fraction"
            FROM ({profiled}) WHERE null_fraction > 0 ORDER BY null_fraction DESC""",
    )
