"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed place on a line of hashes. For each source the words are
summed by hash bucket, and the bucket in which the source's budget ends is found;
only that bucket is divided again, by the next digits of the hash, until it holds one
document. The result is one threshold per source. Documents are then filtered by
comparing their hash with it; nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.store import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
#: Hex digits of the hash in one histogram level: 4,096 buckets.
DIGITS = 3
SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Number of runs of characters other than space, \\t, \\n, \\v, \\f and \\r; null has 0."""
    ends = F.rlike(F.substring(text, 1, 1), F.lit(SPACE)).cast("int") + F.rlike(
        F.substring(text, -1, 1), F.lit(SPACE)
    ).cast("int")
    return (
        F.when(F.length(text) > 0, F.size(F.split(text, SPACE + "+")) - ends)
        .otherwise(0)
        .cast("long")
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Fill sources (source, source_size) up to their targets.

    Sources in order of code points, null last, take the weights in turn. They share
    `share` of all words by weight, but none gets more than `most` times its size;
    what is over is shared again. One row per source; the window over all of them
    runs in one task, so their number should stay in the millions.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))
    weighed = sizes.select(
        "source",
        "source_size",
        F.get(turn, (F.row_number().over(by_name) - 1) % len(weights)).alias("weight"),
        (F.col("source_size") * float(most)).alias("cap"),
    ).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * float(share)
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        )
        / F.sum("weight").over(onward),
    )
    # Sources are full from the left; the first that is not sets the level of the rest.
    level = F.first(
        F.when(F.col("full_at") > F.col("level"), F.col("level")), ignorenulls=True
    ).over(everything)
    return levels.select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * level, F.col("cap"))).alias("target"),
    )


def _placed(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column
) -> DataFrame:
    """doc_id, source, size and place: the hash of the id, then the row's own number.

    The number tells repeated ids apart. It is fixed by the write that follows. `more`
    columns are written beside them.
    """
    return docs.select(
        *more,
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"),
        F.concat(
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
            F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"),
        ).alias("place"),
    )


def _divide(rows: DataFrame, open_: DataFrame, level: int) -> DataFrame:
    """For each open source, the bucket of this level in which its budget ends.

    `open_` has source, prefix and left, the words still to be taken inside the prefix.
    """
    found = rows.select(
        F.col("source").alias("row_source"),
        F.substring("place", 1, level * DIGITS).alias("row_prefix"),
        F.substring("place", 1, (level + 1) * DIGITS).alias("bucket"),
        "size",
    )
    sums = found.groupBy("row_source", "row_prefix", "bucket").agg(
        F.sum("size").alias("words"), F.count("*").alias("docs")
    )
    along = Window.partitionBy("source").orderBy("bucket")
    upto = F.sum("words").over(along)
    crossed = (
        sums.join(
            open_,
            F.col("row_source").eqNullSafe(F.col("source"))
            & (F.col("row_prefix") == F.col("prefix")),
        )
        .withColumn("upto", upto)
        .where(F.col("upto") > F.col("left"))
    )
    return crossed.groupBy("source").agg(
        F.min("bucket").alias("prefix"),
        F.min_by(F.col("left") - F.col("upto") + F.col("words"), "bucket").alias("left"),
        F.min_by("docs", "bucket").alias("docs"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """How many words the mix takes from each document.

    Returns doc_id, size, source_size, target and taken for every row. A document is
    taken whole, 0 to `most` times: as often as its source's target holds the whole
    source, and once more where its hash lies under the source's threshold. The
    document at the threshold is taken if at least half of it fits, so a source
    misses its target by at most half of one document. Null and empty texts have size
    0 and take nothing; a null source is a source of its own. Rows that repeat an id
    are told apart by their place in the table. Other columns are not read.
    """
    rows = stored(_placed(docs, id_col, text_col, source_col), "sizes")
    return _decided(rows, weights, share, most).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"),
    )


def _decided(
    rows: DataFrame, weights: Sequence[float], share: float, most: int
) -> DataFrame:
    """The stored rows of _placed() with source_size, target and how many times each is taken."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, share, most), "targets")
    rounds = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    goals = goals.withColumn("rounds", rounds).withColumn(
        "rest", F.col("target") - F.col("rounds") * F.col("source_size")
    )
    open_ = goals.where("rest > 0").select(
        "source", F.lit("").alias("prefix"), F.col("rest").alias("left")
    )
    ends = None
    for level in range(48 // DIGITS):
        divided = stored(_divide(rows, open_, level), "boundary")
        done = divided.where("docs = 1").select("source", "prefix", "left")
        ends = done if ends is None else ends.union(done)
        open_ = divided.where("docs > 1").select("source", "prefix", "left")
        if open_.isEmpty():
            break
    ends = ends.select(F.col("source").alias("end_source"), "prefix", "left")
    goals = goals.select(F.col("source").alias("goal_source"), "source_size", "target", "rounds")
    limits = goals.join(ends, F.col("goal_source").eqNullSafe(F.col("end_source")), "left")
    # Stored, so that Spark knows that it is small and leaves the rows where they are.
    limits = stored(limits.drop("end_source"), "limits")
    here = F.expr("substring(place, 1, length(prefix))")
    more = F.when(
        (here < F.col("prefix"))
        | ((here == F.col("prefix")) & (F.col("left") * 2 >= F.col("size"))),
        1,
    ).otherwise(0)
    return rows.join(
        limits, F.col("source").eqNullSafe(F.col("goal_source")), "left"
    ).withColumn("times", (F.col("rounds") + more).cast("int"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, all columns.

    Each row comes as often as mix() takes it, also one that repeats an id or has none.
    Empty documents are taken by no budget; they stay out.
    """
    whole = F.struct(*docs.columns).alias("whole")
    rows = stored(_placed(docs, id_col, text_col, source_col, whole), "documents")
    return (
        _decided(rows, weights, share, most)
        .where("size > 0 AND times > 0")
        .select("whole", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("whole.*")
    )
