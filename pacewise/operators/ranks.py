"""Global order without a single-task sort: positions, running totals, quantiles."""

from __future__ import annotations

from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacewise.session import cut

#: Leading hex digits of a hash that name a bucket.
HASH_DIGITS = 4
#: Copies of one row that are put back by one task.
COPIES_PER_PIECE = 1_000_000


def hash_position(
    df: DataFrame,
    keys: list[str],
    strata: list[str] | None = None,
    digits: int = HASH_DIGITS,
    copies_per_piece: int = COPIES_PER_PIECE,
) -> DataFrame:
    """Add `position` (0-based) within each stratum, ordered by the md5 of `keys`.

    Equal rows are counted first, travel as one row and get consecutive positions, so
    copies of a row fill no bucket, at any number. The leading `digits` hex digits of the
    hash split a stratum into even buckets: rows are numbered inside a bucket and moved up
    by the rows in the buckets before it, so no task sorts a whole stratum. More copies
    than `copies_per_piece` are put back in pieces, each by a task of its own; neither
    setting changes a position. A null stratum is a stratum. Different rows with the same
    keys come in the order of a hash of all columns.
    """
    strata, names = strata or [], df.columns
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    hashed = counted.withColumn("_hash", F.md5(text)).withColumn(
        "_bucket", F.left("_hash", F.lit(digits))
    )
    before = W.partitionBy(*strata).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = hashed.groupBy(*strata, "_bucket").agg(F.sum("_n").alias("_in"))
    offsets = offsets.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*strata, "_bucket"]],
        F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_offset"),
    )
    inside = W.partitionBy(*strata, "_bucket").orderBy("_hash", F.xxhash64(*names))
    earlier = F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, -1))
    # Numbered rows lie by bucket already, and a table of offsets may have many strata: it
    # is for Spark to see whether it is small.
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*strata, "_bucket"]]
    placed = (
        hashed.withColumn("_earlier", F.coalesce(earlier, F.lit(0)))
        .join(offsets, reduce(lambda a, b: a & b, same))
        .select(*names, "_n", (F.col("_offset") + F.col("_earlier")).alias("_from"))
    )
    end = F.col("_from") + F.col("_n") - 1
    few = placed.where(F.col("_n") <= copies_per_piece)
    step = F.lit(copies_per_piece).cast("bigint")
    pieces = (
        placed.where(F.col("_n") > copies_per_piece)
        .withColumn("_end", end)
        .withColumn("_from", F.explode(F.sequence("_from", "_end", step)))
        .repartition("_from")
    )
    last = F.least(F.col("_from") + step - 1, F.col("_end"))
    return few.select(*names, F.explode(F.sequence("_from", end)).alias("position")).union(
        pieces.select(*names, F.explode(F.sequence("_from", last)).alias("position"))
    )


def running_total(
    df: DataFrame, order: str, sums: list[str], ascending: bool = True, ahead: bool = False
) -> DataFrame:
    """Add `cum_<c>` per summed column, inclusive, in the order of one column.

    `df` has one row per value of `order`. Rows are range-partitioned and
    checkpointed, so that a row keeps its partition in both later steps: totals
    per partition (as many rows as partitions) give the offsets, a window per
    partition gives the rest. With `ahead`, `next_<c>` holds the following row's
    value (null on the last row).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by: Column = F.asc(order) if ascending else F.desc(order)
    ranged = cut(df.repartitionByRange(parts, by).withColumn("_part", F.spark_partition_id()))
    first = F.min_by if ascending else F.max_by
    w_parts = W.orderBy("_part")
    before = w_parts.rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in sums],
        first(F.struct(*sums), F.col(order)).alias("_head"),
    )
    offsets = offsets.select(
        "_part",
        F.lead("_head").over(w_parts).alias("_next_head"),
        *[
            F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
            for c in sums
        ],
    )
    inside = W.partitionBy("_part").orderBy(by)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = ranged.join(F.broadcast(offsets), "_part").withColumns(
        {f"cum_{c}": F.col(f"_off_{c}") + F.sum(c).over(upto) for c in sums}
    )
    if ahead:
        out = out.withColumns(
            {
                f"next_{c}": F.coalesce(F.lead(c).over(inside), F.col(f"_next_head.{c}"))
                for c in sums
            }
        )
    return out.drop("_part", "_next_head", *[f"_off_{c}" for c in sums])


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """One row with `quantiles`: exact, linearly interpolated, null when no values.

    Copies of a value collapse to one counted row before anything is ordered.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_total(counts, "_value", ["_n"])
    total = ranked.agg(F.sum("_n")).first()[0] or 0

    def at(position: int) -> Column:
        covers = (F.col("cum__n") > position) & (F.col("cum__n") - F.col("_n") <= position)
        return F.max(F.when(covers, F.col("_value")))

    picks, lerp = [], []
    for i, p in enumerate(probs):
        place = p * (total - 1)
        picks += [at(floor(place)).alias(f"_lo{i}"), at(ceil(place)).alias(f"_hi{i}")]
        step = F.col(f"_hi{i}") - F.col(f"_lo{i}")
        lerp.append(F.col(f"_lo{i}") + step * F.lit(place - floor(place)))
    return ranked.agg(*picks).select(F.array(*lerp).alias("quantiles"))


def exact_quantiles_of(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Per column its exact, linearly interpolated quantiles: column_name, n, quantiles.

    All columns are stacked as (column, value) and counted, which collapses copies, and
    the counts are ordered by one range partitioning, whatever the number of columns. A
    column lies in consecutive partitions, so prefix counts are one row for each column
    and partition: at most as many as there are of both together. Null and NaN are no
    values; a column without any has n = 0 and null quantiles.
    """
    if not columns:
        raise ValueError("no columns")
    stacked = F.array(
        *[
            F.struct(
                F.lit(i).alias("_column"),
                F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("_value"),
            )
            for i, c in enumerate(columns)
        ]
    )
    counts = (
        df.select(F.inline(stacked))
        .where(F.col("_value").isNotNull())
        .groupBy("_column", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(
        counts.repartitionByRange(parts, "_column", "_value").withColumn(
            "_part", F.spark_partition_id()
        )
    )
    of_column = W.partitionBy("_column")
    before = of_column.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_column", "_part")
        .agg(F.sum("_n").alias("_in"))
        .select(
            "_column",
            "_part",
            F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_off"),
            F.sum("_in").over(of_column).alias("_total"),
        )
    )
    inside = W.partitionBy("_part", "_column").orderBy("_value")
    upto = F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = ranged.join(F.broadcast(offsets), ["_column", "_part"]).withColumn(
        "_cum", F.col("_off") + upto
    )

    def at(position: Column) -> Column:
        covers = (F.col("_cum") > position) & (F.col("_cum") - F.col("_n") <= position)
        return F.max(F.when(covers, F.col("_value")))

    picks, lerp = [], []
    for i, p in enumerate(probs):
        place = F.lit(p) * (F.col("_total") - 1)
        picks += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
        share = F.lit(p) * (F.col("_n") - 1)
        step = (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (share - F.floor(share))
        lerp.append(F.col(f"_lo{i}") + step)
    found = ranked.groupBy("_column").agg(F.max("_total").alias("_n"), *picks)
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "_i int, column_name string")
    return names.join(
        found.select("_column", "_n", F.array(*lerp).alias("quantiles")),
        F.col("_i") == F.col("_column"),
        "left",
    ).select("column_name", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"), "quantiles")
