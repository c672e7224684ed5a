"""Sharding by extendible hashing.

A shard is a prefix of the bits of a document's hash. The directory starts with one
empty prefix; a bucket over the byte limit, and only such a bucket, splits on the next
bit. BITS bits are looked at in one pass over the documents that are still in open
buckets, so a directory of a million shards takes five passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.store import stored

LIMIT_BYTES = 1 << 20
#: Bits in one pass: 16 buckets below each open one.
BITS = 4
#: 15 hex digits are the most that conv() takes without a sign.
HASH_BITS, ROW_BITS = 60, 64


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of `key` as text, as a string of 0 and 1."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def _split(open_rows: DataFrame, limit: int, start: int) -> DataFrame:
    """What becomes of each bucket `start + BITS` bits deep below the open ones.

    Gives cell (its bits), and shard, the bucket it belongs to, with bytes and docs;
    shard is null where even the cell is over the limit and holds several documents.
    """
    cells = open_rows.groupBy(F.substring("bits", 1, start + BITS).alias("cell")).agg(
        F.sum("bytes").alias("cell_bytes"), F.count("*").alias("cell_docs")
    )
    fitting = F.lit(None)
    for depth in range(start + BITS, start, -1):
        prefix = F.substring("cell", 1, depth)
        at = Window.partitionBy(prefix)
        size, docs = F.sum("cell_bytes").over(at), F.sum("cell_docs").over(at)
        # The shallowest bucket that fits stands, so it is asked last.
        fitting = F.when(
            (size <= limit) | (docs == 1),
            F.struct(prefix.alias("shard"), size.alias("bytes"), docs.alias("docs")),
        ).otherwise(fitting)
    return cells.select("cell", fitting.alias("fit")).select(
        "cell", "fit.shard", "fit.bytes", "fit.docs"
    )


def shards(
    docs: DataFrame,
    limit_bytes: int = LIMIT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The shard of every row: doc_id, n_bytes, shard, depth, shard_bytes, shard_docs.

    n_bytes is the text's length in UTF-8; null and empty texts have 0. No shard is
    over `limit_bytes`, but for a single document that is itself longer: it ends up
    alone. Rows with the same id, null among them, have the same hash; they are told
    apart by the row's place in the table, whose bits follow. An empty table has no
    shards. Other columns are not read.
    """
    number = F.monotonically_increasing_id()
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
            # The low bits, which differ within a file, come first.
            F.concat(
                hash_bits(F.col(id_col)), F.reverse(F.lpad(F.bin(number), ROW_BITS, "0"))
            ).alias("bits"),
        ),
        "bits",
    )
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"), F.count("*").alias("n"))
    size, n = total.first()
    if size <= limit_bytes or n <= 1:
        return rows.select(
            "doc_id",
            "n_bytes",
            F.lit("").alias("shard"),
            F.lit(0).alias("depth"),
            F.lit(size).cast("long").alias("shard_bytes"),
            F.lit(n).cast("long").alias("shard_docs"),
        )
    parts, open_rows = [], rows.withColumnRenamed("n_bytes", "bytes")
    for start in range(0, HASH_BITS + ROW_BITS, BITS):
        directory = stored(_split(open_rows, limit_bytes, start), "directory")
        cell = F.substring("bits", 1, start + BITS) == F.col("cell")
        closed = directory.where("shard is not null").withColumnsRenamed(
            {"bytes": "shard_bytes", "docs": "shard_docs"}
        )
        parts.append(open_rows.join(closed, cell).drop("cell"))
        still = directory.where("shard is null").select("cell")
        if still.isEmpty():
            break
        open_rows = stored(open_rows.join(still, cell, "left_semi"), "open")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(
        "doc_id",
        F.col("bytes").alias("n_bytes"),
        "shard",
        F.length("shard").alias("depth"),
        "shard_bytes",
        "shard_docs",
    )


def write_shards(
    docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id"
) -> None:
    """Write `docs` as Parquet, one folder per shard; ids must be unique and not null."""
    where = shards(docs, limit_bytes, id_col).select(
        F.col("doc_id").alias("_shard_id"), F.col("shard").alias("_shard")
    )
    (
        docs.join(where, F.col(id_col) == F.col("_shard_id"))
        .drop("_shard_id")
        .repartition("_shard")
        .write.partitionBy("_shard")
        .parquet(path)
    )
