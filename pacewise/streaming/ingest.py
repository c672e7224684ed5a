"""Exports of the raw files as a stream: bronze, silver and gold in micro-batches.

Every raw table has a folder of exports, `<source>/<table>/export=<name>/`, whose names
sort by time. What an export says about an ad set's day replaces all that earlier exports
said about it: late days are added, repeated ones change nothing, corrected ones take the
place of what was there. The outcome doesn't depend on how exports fall into batches.

Each table is a file stream that upserts its batches into silver by date. A batch writes,
under its own number, its raw rows, the rows it rejects, the whole merged days and, when
these are complete, the list of days; only then are the days of silver overwritten. A
batch that is run again after a failure finds its list and repeats the last step, so
nothing is lost, doubled or half written. Gold is rebuilt for the days in lists that it
has not seen yet.

A second stream counts arrivals by day and closes a day when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.functions.measures import day
from pacewise.operators import clean
from pacewise.operators.conformed import daily_metrics_by_key
from pacewise.sources import schemas as S
from pacewise.sources.readers import rejects
from pacewise.sources.tables import on_days, path_exists

EXPORT = "export"
CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    S.PERFORMANCE: clean.clean_performance,
    S.BUDGET: clean.clean_budget,
    S.CONVERSIONS: clean.clean_conversions,
}


@dataclass(frozen=True)
class Stream:
    """Where exports are, where layers, lists and stream checkpoints go.

    `target` is a folder that all machines share. A day is closed when rows of days later
    than it by more than `late_after` have arrived. `files_per_batch` bounds a batch.
    """

    source: str
    target: str
    late_after: str = "7 days"
    files_per_batch: int | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.target, *parts])


def arrivals(spark: SparkSession, stream: Stream, table: str) -> DataFrame:
    """The raw rows of all exports, as text, with the name of their export."""
    schema = T.StructType([*S.raw_schema(table), T.StructField(EXPORT, T.StringType())])
    reader = spark.readStream.schema(schema).options(header=True, enforceSchema=False, escape='"')
    if stream.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", stream.files_per_batch)
    return reader.csv(f"{stream.source}/{table}")


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table of the target; empty as long as nothing has been written."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _same_group(names: list[str], other: str = "_") -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{other}{n}")) for n in names])


def newest(rows: DataFrame) -> DataFrame:
    """Of each ad set's day the rows of the last export that has any, without repetitions."""
    last = rows.groupBy(*S.KEYS).agg(F.max(EXPORT).alias(EXPORT))
    last = last.select(*[F.col(c).alias(f"_{c}") for c in last.columns])
    return rows.join(last, _same_group([*S.KEYS, EXPORT]), "left_semi").dropDuplicates()


def _overwrite_days(df: DataFrame, path: str) -> None:
    """Replace the days that `df` holds, leave all others."""
    (
        df.hint("rebalance", S.DATE)
        .sortWithinPartitions(*S.KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(S.DATE)
        .parquet(path)
    )


def upsert(stream: Stream, table: str, done: list[int]) -> Callable[[DataFrame, int], None]:
    """What a batch of the table's exports does; `done` gets the batch's number."""
    cleaner = CLEANERS[table]

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = f"batch={number}"
        listed = stream.path("days", table, mark)
        staged = stream.path("staged", table, mark)
        silver = stream.path("silver", table)
        if not path_exists(spark, f"{listed}/_SUCCESS"):
            bronze = stream.path("bronze", table, mark)
            batch.write.mode("overwrite").parquet(bronze)
            raw = spark.read.schema(batch.schema).parquet(bronze)
            rejects(raw).write.mode("overwrite").parquet(stream.path("rejects", table, mark))
            fresh = raw.withColumn(S.DATE, day(S.DATE)).transform(cleaner)
            days = [r[0] for r in fresh.select(S.DATE).distinct().collect()]
            known = on_days(_read(spark, silver, fresh.schema), days)
            merged = newest(known.unionByName(fresh))
            merged.write.mode("overwrite").parquet(staged)
            merged = spark.read.schema(merged.schema).parquet(staged)
            merged.groupBy(S.DATE).agg(F.count(F.lit(1)).alias("rows")).write.mode(
                "overwrite"
            ).parquet(listed)
        merged = spark.read.parquet(staged)
        _overwrite_days(merged, silver)
        done.append(number)

    return run


def _run_stream(spark: SparkSession, stream: Stream, table: str) -> list[int]:
    """Take in all exports that have not been read yet; the numbers of the batches run."""
    done: list[int] = []
    query = (
        arrivals(spark, stream, table)
        .writeStream.foreachBatch(upsert(stream, table, done))
        .option("checkpointLocation", stream.path("checkpoints", table))
        .queryName(f"{table}-{uuid4().hex[:8]}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def silver(spark: SparkSession, stream: Stream, table: str) -> DataFrame:
    """The table's rows as they stand, without the export's name."""
    types = CLEANERS[table](
        spark.createDataFrame([], S.raw_schema(table)).withColumn(S.DATE, day(S.DATE))
    ).schema
    stored = T.StructType([*types, T.StructField(EXPORT, T.StringType())])
    # The date comes from the folders' names, behind the other columns.
    return _read(spark, stream.path("silver", table), stored).select(types.names)


LISTS = "`table` string, batch int, date date, rows bigint"


def days_written(spark: SparkSession, stream: Stream) -> DataFrame:
    """Which batch rewrote which day of silver: table, batch, date, rows."""
    parts = [
        _read(spark, stream.path("days", table), "date date, rows bigint, batch int").select(
            F.lit(table).alias("table"), "batch", "date", "rows"
        )
        for table in CLEANERS
    ]
    return reduce(DataFrame.union, parts)


def refresh_gold(spark: SparkSession, stream: Stream) -> int:
    """Rebuild the days that silver has rewritten since the last time; how many those were.

    Gold has one row per (date, ad set), so a day of it depends on that day of silver
    alone. The days are written before the lists that they answer are ticked off; a run
    that fails in between rebuilds them once more.
    """
    seen = _read(spark, stream.path("refreshed"), "`table` string, batch int")
    pending = days_written(spark, stream).join(seen.distinct(), ["table", "batch"], "left_anti")
    batches = pending.select("table", "batch").distinct().collect()
    days = [r[0] for r in pending.select(S.DATE).distinct().collect()]
    if not batches:
        return 0
    if days:
        daily = daily_metrics_by_key(*[on_days(silver(spark, stream, t), days) for t in CLEANERS])
        staged = stream.path("staged", "daily", uuid4().hex)
        daily.write.parquet(staged)
        _overwrite_days(spark.read.schema(daily.schema).parquet(staged), stream.path("gold", "daily"))
    spark.createDataFrame(batches, "`table` string, batch int").write.mode("append").parquet(
        stream.path("refreshed")
    )
    return len(days)


def gold(spark: SparkSession, stream: Stream) -> DataFrame:
    """Daily metrics by (date, ad set) as they stand."""
    schema = daily_metrics_by_key(*[silver(spark, stream, t).limit(0) for t in CLEANERS]).schema
    return _read(spark, stream.path("gold", "daily"), schema).select(schema.names)


CLOSED = "date date, rows bigint, last_export string"


def close_days(spark: SparkSession, stream: Stream, table: str = S.PERFORMANCE) -> None:
    """Append the days that the watermark has passed, with what had arrived until then.

    A row that arrives for a closed day is too late for this count alone: silver and gold
    take it in like any other.
    """
    moment = F.to_timestamp(day(S.DATE))
    counted = (
        arrivals(spark, stream, table)
        .withColumn("moment", moment)
        .where(F.col("moment").isNotNull())
        .withWatermark("moment", stream.late_after)
        .groupBy(F.window("moment", "1 day").alias("window"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max(EXPORT).alias("last_export"))
        .select(F.to_date("window.start").alias("date"), "rows", "last_export")
    )
    query = (
        counted.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", stream.path("checkpoints", f"closed-{table}"))
        .queryName(f"closed-{uuid4().hex[:8]}")
        .trigger(availableNow=True)
        .start(stream.path("closed", table))
    )
    query.awaitTermination()


def closed_days(spark: SparkSession, stream: Stream, table: str = S.PERFORMANCE) -> DataFrame:
    return _read(spark, stream.path("closed", table), CLOSED)


def ingest(spark: SparkSession, stream: Stream) -> dict[str, int]:
    """Take in what is new, refresh gold, close days: batches by table, days of gold."""
    counts = {table: len(_run_stream(spark, stream, table)) for table in CLEANERS}
    counts["days"] = refresh_gold(spark, stream)
    close_days(spark, stream)
    return counts
