"""Key guards and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and distinct keys of a table, one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
    )


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    if not key_duplicates(df, keys).isEmpty():
        raise RuntimeError(f"{what} repeats a key of ({', '.join(keys)})")
    return df


def _generated_at() -> Column:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, null share and, for numbers, mean, std, min, max.

    A single aggregation computes every statistic; its one row is then unfolded.
    """

    def number(field: T.StructField) -> Column:
        x = F.col(field.name).cast("double")
        return F.when(~F.isnan(x), x)

    total = F.count(F.lit(1))
    stats = []
    for field in df.schema.fields:
        numeric = isinstance(field.dataType, T.NumericType)
        present = number(field) if numeric else F.col(field.name)
        missing = F.when(total > 0, (total - F.count(present)) / total).otherwise(F.lit(0.0))
        nothing = F.lit(None).cast("double")
        stats.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("dtype"),
                missing.alias("null_fraction"),
                (F.avg(present) if numeric else nothing).alias("mean"),
                (F.stddev_samp(present) if numeric else nothing).alias("std"),
                (F.min(present) if numeric else nothing).alias("min"),
                (F.max(present) if numeric else nothing).alias("max"),
            )
        )
    return (
        df.agg(F.array(*stats).alias("stats"))
        .select(F.inline("stats"))
        .withColumn("generated_at", _generated_at())
    )


def summarise(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Chosen columns of several tables: null share, min, max, mean, sample std.

    Each table is read once for all its columns.
    """

    def one(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
        total = F.nullif(F.count(F.lit(1)), F.lit(0))
        stats = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                (F.count_if(F.col(c).isNull()) / total).alias("null_fraction"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
            )
            for c in columns
        ]
        return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))

    rows = reduce(DataFrame.unionByName, [one(*t) for t in tables])
    return rows.withColumn("generated_at", F.current_timestamp())


def checks_passed(report: DataFrame) -> DataFrame:
    """How many profiled columns have no nulls."""
    return report.agg(
        F.count_if(F.col("null_fraction") == 0).alias("checks_ok"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def issues(report: DataFrame) -> DataFrame:
    """Profiled columns with nulls, worst first."""
    return report.filter("null_fraction > 0").orderBy(F.desc("null_fraction"), "column_name")


# The printed titles of the report.
REPORT_TITLES = {
    "column_name": "Column",
    "dtype": "Type",
    "null_fraction": "Null fraction",
    "mean": "Mean",
    "std": "Std dev",
    "min": "Min",
    "max": "Max",
    "generated_at": "Generated at",
}


def titled(report: DataFrame) -> DataFrame:
    return report.withColumnsRenamed(REPORT_TITLES)
