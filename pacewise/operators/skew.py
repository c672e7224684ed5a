"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more rows on a side is split into parts of about this many.
ROWS_PER_PART = 10_000_000
#: The hot keys are broadcast up to this number: some megabytes.
BROADCAST_KEYS = 100_000
#: Copies of one row travel through a join as one row, this many together.
COPIES_PER_PIECE = 100_000


def join_many(
    spine: DataFrame,
    sides: list[DataFrame],
    keys: list[str],
    sizes: DataFrame | None = None,
    rows_per_part: float = ROWS_PER_PART,
    copies_per_piece: int = COPIES_PER_PIECE,
) -> DataFrame:
    """Left-join a key-unique spine to sides that may repeat a key.

    `sizes` holds the keys with columns `n0`, `n1`, ...: the row count of each
    side (null or 0 when the side lacks the key); it is counted if not given. A
    key is hot on a side when it has more than `rows_per_part` rows there, a number
    that does not grow with the data. Without hot keys the joins are plain.

    Otherwise rows of a hot key are spread over salts, and the other inputs repeat
    that key once per salt; all other keys have the single salt 0. Exact copies of a
    hot key's row are counted first, and the count is cut into pieces with salts of
    their own; copies come back after the joins. There are at most total /
    rows_per_part hot keys; they are broadcast if that is no more than BROADCAST_KEYS.
    """
    counts = [f"n{i}" for i in range(len(sides))]
    if sizes is None:
        sizes = _key_sizes(sides, keys)
    found = sizes.agg(
        F.sum(sum(F.coalesce(F.col(c), F.lit(0)) for c in counts)).alias("total"),
        *[F.max(c).alias(f"most_{c}") for c in counts],
    ).first()
    if all((found[f"most_{c}"] or 0) <= rows_per_part for c in counts):
        out = spine
        for side in sides:
            out = out.join(side, keys, "left")
        return out
    few = found["total"] / rows_per_part <= BROADCAST_KEYS
    return _salted(spine, sides, keys, sizes, rows_per_part, copies_per_piece, few)


def _key_sizes(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows per key of every side, in one aggregation."""
    tagged = [
        side.select(*keys, *[F.lit(int(i == j)).alias(f"n{j}") for j in range(len(sides))])
        for i, side in enumerate(sides)
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    return rows.groupBy(*keys).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(sides))])


def _salted(
    spine: DataFrame,
    sides: list[DataFrame],
    keys: list[str],
    sizes: DataFrame,
    limit: float,
    copies: int,
    few: bool,
) -> DataFrame:
    salts = [f"_salt{i}" for i in range(len(sides))]
    parts = [f"_parts{i}" for i in range(len(sides))]
    times = [f"_times{i}" for i in range(len(sides))]

    def n_parts(count: str) -> Column:
        needed = F.ceil(F.coalesce(F.col(count), F.lit(0)) / F.lit(float(limit)))
        return F.greatest(needed, F.lit(1)).cast("int")

    sized = sizes.select(*keys, *[n_parts(f"n{i}").alias(p) for i, p in enumerate(parts)])
    hot = sized.filter(F.greatest(*parts, F.lit(1)) > 1)
    hot = F.broadcast(hot) if few else hot

    def with_parts(df: DataFrame) -> DataFrame:
        found = df.join(hot, keys, "left")
        return found.withColumns({p: F.coalesce(F.col(p), F.lit(1)) for p in parts})

    def every_salt(df: DataFrame, i: int) -> DataFrame:
        return df.withColumn(salts[i], F.explode(F.sequence(F.lit(0), F.col(parts[i]) - 1)))

    def spread(side: DataFrame, i: int) -> DataFrame:
        """The rows with a salt, and how often each stands for itself."""
        sized = with_parts(side)
        cold = sized.filter(F.col(parts[i]) == 1).withColumns(
            {salts[i]: F.lit(0), times[i]: F.lit(1).cast("bigint")}
        )
        piece = F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(copies).cast("bigint"))
        )
        salt = F.pmod(F.xxhash64(*side.columns, "_from"), F.col(parts[i])).cast("int")
        counted = sized.filter(F.col(parts[i]) > 1).groupBy(*side.columns, *parts)
        split = counted.agg(F.count(F.lit(1)).alias("_n")).withColumn("_from", piece)
        split = split.withColumns(
            {
                salts[i]: salt,
                times[i]: F.least(F.col("_n") - F.col("_from"), F.lit(copies).cast("bigint")),
            }
        )
        return cold.unionByName(split.drop("_n", "_from"))

    out = with_parts(spine)
    for i in range(len(sides)):
        out = every_salt(out, i)
    for i, side in enumerate(sides):
        salted = spread(side, i)
        for other in range(len(sides)):
            if other != i:
                salted = every_salt(salted, other)
        out = out.join(salted.drop(*parts), keys + salts, "left")
        # A salt that drew no row is not an unmatched key.
        out = out.filter((F.col(parts[i]) == 1) | F.col(times[i]).isNotNull())
    standing = reduce(
        lambda a, b: a * b, [F.coalesce(F.col(t), F.lit(1).cast("bigint")) for t in times]
    )
    repeated = F.sequence(F.lit(1).cast("bigint"), standing)
    return out.withColumn("_copy", F.explode(repeated)).drop(*salts, *parts, *times, "_copy")
