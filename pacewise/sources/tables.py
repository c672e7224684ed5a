"""Layer tables: namespaces, idempotent sinks, audits and small exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacewise.session import cut
from pacewise.sources import schemas as S

LAYERS = ["bronze", "silver", "gold"]


def ensure_layers(spark: SparkSession, layers: list[str] | None = None) -> None:
    for layer in layers or LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{layer}`")


def write_table(
    df: DataFrame,
    name: str,
    sort_by: list[str] | None = None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
) -> int:
    """Create or replace a table and return how many rows were written.

    The count is observed during the write, so the audit costs no second scan.
    Sorting inside the files replaces a global ORDER BY. With `partition_by`,
    rebalancing evens out file sizes and splits a hot partition over several
    files. `bucket_by` is for tables with one row per bucketed key: they are
    written in as many buckets as a shuffle has partitions, one file each, and
    later joins on the key need no exchange on their side.
    """
    out = df
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        out = out.repartition(buckets, *bucket_by)
    elif partition_by:
        out = out.hint("rebalance", *partition_by)
    order = list(dict.fromkeys([*(partition_by or []), *(sort_by or [])]))
    if order:
        out = out.sortWithinPartitions(*order)
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return int(seen.get["rows"])


def write_view(spark: SparkSession, view: str, table: str) -> int:
    """Create or replace a table from a registered view."""
    return write_table(spark.table(view), table)


def register(df: DataFrame, view: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df


def append_audit(spark: SparkSession, counts: dict[str, int], name: str) -> None:
    """One row per written table; replaced on each run."""
    rows = spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")
    write_table(rows.withColumn("written_at", F.current_timestamp()), name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    store = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.exists(there))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty; run the earlier steps first")
    return df


def export_csv(df: DataFrame, path: str) -> None:
    """One header per file; quotes are doubled and white space is kept."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# --- tables that readers use while they are rewritten --------------------------------


def on_days(df: DataFrame, days: list, date_col: str = S.DATE) -> DataFrame:
    """Rows of the named days; a null among them names rows without a date."""
    wanted = F.col(date_col).isin([d for d in days if d is not None])
    return df.where(wanted | F.col(date_col).isNull() if None in days else wanted)


def replace_days(
    df: DataFrame, name: str, days: list, date_col: str = S.DATE, sort_by: list[str] | None = None
) -> int:
    """Replace the named days of a table by `df`, which has rows of these days only.

    The table is partitioned by its date; it is made if it isn't there, and days without
    rows in `df` leave it. Other days aren't touched. The rows are written down before the
    first day is replaced, so `df` may read the table. Returns how many rows were written.
    """
    spark = df.sparkSession
    rows = cut(df)
    found = {r[0]: r[1] for r in rows.groupBy(date_col).count().collect()}
    order = list(dict.fromkeys([date_col, *(sort_by or [])]))
    laid = rows.hint("rebalance", date_col).sortWithinPartitions(*order)
    dynamic = {"partitionOverwriteMode": "dynamic"}
    if not table_exists(spark, name):
        laid.write.format("parquet").options(**dynamic).partitionBy(date_col).saveAsTable(name)
    else:
        if found:
            laid = laid.select(*spark.table(name).columns)
            laid.write.mode("overwrite").options(**dynamic).insertInto(name)
        for gone in (d for d in days if d not in found):
            value = "null" if gone is None else f"'{gone}'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({date_col} = {value})")
    return sum(found.values())


def swap_table(df: DataFrame, name: str, **layout) -> int:
    """Write a new version of a table and let its name point to it, in one step.

    The name is a view of the latest version, so readers see the old one or the new one
    and never none; the version before stays for those who are still reading it, older
    ones go. Returns the row count.
    """
    spark = df.sparkSession
    schema, _, table = name.rpartition(".")
    prefix = f"{table}__v"
    held = [t.name for t in spark.catalog.listTables(schema or None) if t.name.startswith(prefix)]
    number = max((int(t.removeprefix(prefix)) for t in held), default=0) + 1
    version = f"{schema}.{prefix}{number}" if schema else f"{prefix}{number}"
    rows = write_table(df, version, **layout)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in held:
        if int(old.removeprefix(prefix)) < number - 1:
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{old}" if schema else f"DROP TABLE IF EXISTS {old}")
    return rows
