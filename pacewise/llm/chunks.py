"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its own characters say so: at the first cut mark after
CHUNK_MIN characters, or after CHUNK_MAX at the latest. Each chunk gets a 16-byte
identifier, and the identifiers are verified once over the whole corpus: every
distinct chunk is moved once, and no identifier may stand for two contents. From
then on a document is its recipe, the ordered list of identifiers, and only
recipes are grouped, compared and joined.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.store import ascii_lower, stored

CHUNK_MIN, CHUNK_MAX = 1024, 8192
#: Two characters of a word's end, a space and a word's begin. Texts without such
#: places, as in other scripts, are cut every CHUNK_MAX characters.
CUT_MARK = r"[aeiou][st]\s[a-m]"


def chunks(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> Column:
    """The chunks of a text, in order; together they are the text."""
    pattern = f"(?s).{{{least},{most}}}?{CUT_MARK}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(seed), chunk).alias("b")
    )


def verified_seed(pieces: DataFrame) -> int:
    """The first seed under which different chunks have different identifiers.

    `pieces` has one column `chunk`. With 128 bits the first seed is all but
    certain to do; the check makes it certain for these data.
    """
    distinct = pieces.groupBy("chunk").agg(F.lit(1).alias("one"))
    for seed in count(1):
        ids = distinct.select(identifier(F.col("chunk"), seed).alias("id"))
        clashes = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
        if clashes.isEmpty():
            return seed
    raise AssertionError("count() does not end")


def recipes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = CHUNK_MIN,
    most: int = CHUNK_MAX,
) -> DataFrame:
    """One row (doc_id, text_sha256, recipe) for each row of `docs`."""
    normal = docs.select(
        F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("normal")
    )
    pieces = chunks(F.col("normal"), least, most)
    seed = verified_seed(normal.select(F.explode(pieces).alias("chunk")))
    return normal.select(
        "doc_id",
        F.sha2("normal", 256).alias("text_sha256"),
        F.transform(pieces, lambda chunk: identifier(chunk, seed)).alias("recipe"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = CHUNK_MIN,
    most: int = CHUNK_MAX,
) -> DataFrame:
    """Which rows have equal texts, A-Z lower-cased, and which of them stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256 for every row. The largest
    doc_id of a group stays. Null texts equal the empty text. Rows without an id
    count in group_size; only a group that has nothing else keeps one. A repeated row
    is returned, and counts, as often as it occurs. Other columns are not read. An
    empty table gives an empty result.

    The groups are found by partial aggregation, so a group of any size is one row per
    task after the first step. The way back is a join of small rows on the recipe,
    whose hot groups adaptive execution splits.
    """
    rows = stored(recipes(docs, id_col, text_col, least, most), "recipes")
    groups = rows.groupBy(F.col("recipe").alias("group_recipe")).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return rows.join(groups, F.col("recipe") == F.col("group_recipe")).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns, a repeated row once.

    Rows without an id stay only where their group has no row with one, then once.
    """
    kept = exact_groups(docs, id_col, text_col).where("kept")
    # Only rows without an id need the digest to tell them apart.
    kept = kept.groupBy(
        F.col("doc_id").alias("_kept_id"),
        F.when(F.col("doc_id").isNull(), F.col("text_sha256")).alias("_kept_text"),
    ).agg(F.count("*").alias("_many"))
    digest = F.when(F.col(id_col).isNull(), F.sha2(ascii_lower(F.col(text_col)), 256))
    joined = docs.join(
        kept, F.col(id_col).eqNullSafe(F.col("_kept_id")) & digest.eqNullSafe(F.col("_kept_text"))
    )
    once = joined.where("_many = 1").select(docs.columns)
    # Only rows that are repeated are compared, and moved for it.
    repeated = joined.where("_many > 1").dropDuplicates([id_col, text_col])
    return once.union(repeated.select(docs.columns))
