"""Ordered operators per ad set: next row, moving average, forward count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacewise.sources import schemas as S

TIE_BUCKETS = 1024
COPIES_PER_ROW = 100_000


def next_row_value(
    df: DataFrame,
    value: str,
    by: str = S.AD_SET,
    order: str = S.DATE,
    out: str | None = None,
    copies_per_row: int = COPIES_PER_ROW,
) -> DataFrame:
    """(by, order, value) rows plus the value of the next row of the same `by`.

    The next row, not the next calendar day. Rows that tie on (by, order) have no
    given order; here they follow their value's millionths modulo TIE_BUCKETS, then the
    value. Values that are null, or beyond a long's millionths, come first. Rows without
    `by` are rows of one more `by`.

    No window holds all rows of one `by`: copies collapse into one counted row,
    a first window covers one (by, order, hash bucket), and only the last row of
    each such group, one per day as a rule, enters the window over `by`. Copies
    come back at the end, each run in pieces of `copies_per_row`.
    """
    out = out or f"next_{value}"
    runs = df.groupBy(by, order, value).agg(F.count(F.lit(1)).alias("_n"))
    millionths = F.floor(F.col(value) * 1_000_000).try_cast("bigint")
    runs = runs.withColumn(
        "_tie", F.coalesce(F.pmod(millionths, F.lit(TIE_BUCKETS)), F.lit(-1).cast("bigint"))
    )
    group = W.partitionBy(by, order, "_tie").orderBy(value)
    linked = runs.select(
        "*",
        F.lead(value).over(group).alias("_next"),
        F.lead(F.lit(1)).over(group).isNull().alias("_last"),
        F.first(value).over(group).alias("_head"),
    )
    # A run of n copies: one row that looks ahead, and n - 1 that see their own value.
    spare = F.col("_n") - 1
    step = F.lit(copies_per_row).cast("bigint")
    pieces = F.concat(
        F.array(F.struct(F.lit(0).cast("bigint").alias("i"), F.lit(1).cast("bigint").alias("m"))),
        F.when(
            spare > 0,
            F.transform(
                F.sequence(F.lit(1).cast("bigint"), F.ceil(spare / step)),
                lambda i: F.struct(
                    i.alias("i"), F.least(step, spare - (i - 1) * step).alias("m")
                ),
            ),
        ).otherwise(F.array()),
    )
    pieced = linked.withColumn("_piece", F.explode(pieces))
    looks_ahead = (F.col("_piece.i") == 0) & F.col("_last")
    lane = F.when(looks_ahead, F.lit(0).cast("bigint")).otherwise(
        F.pmod(F.xxhash64(order, value, "_piece.i"), F.lit(1 << 20)) + 1
    )
    days = W.partitionBy(by, "_lane").orderBy(order, "_tie")
    found = pieced.withColumn("_lane", lane).withColumn("_ahead", F.lead("_head").over(days))
    following = (
        F.when(F.col("_piece.i") > 0, F.col(value))
        .when(F.col("_last"), F.col("_ahead"))
        .otherwise(F.col("_next"))
    )
    return found.select(
        by,
        order,
        value,
        following.alias(out),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_piece.m"))).alias("_copy"),
    ).drop("_copy")


def moving_average(
    df: DataFrame,
    columns: list[str],
    window: int = S.MA_WINDOW,
    order: str = S.DATE,
    by: list[str] | None = None,
) -> DataFrame:
    """Trailing average over `window` rows; the first rows average what there is.

    Input has one row per `order` value (and `by`), so without `by` the window
    holds one row per calendar day.
    """
    frame = W.partitionBy(*(by or [])).orderBy(order).rowsBetween(-(window - 1), 0)
    return df.withColumns({f"{c}_ma{window}": F.avg(c).over(frame) for c in columns})


def forward_count(
    spine: DataFrame,
    events: DataFrame,
    event_day: str,
    days: int = S.FORWARD_DAYS,
    by: str = S.AD_SET,
    order: str = S.DATE,
    out: str = "conv_7d",
) -> DataFrame:
    """Per distinct spine key: events of the same id on [day, day + days], both inclusive.

    Events are counted per (id, day) in the same aggregation that makes the spine
    distinct, so the range window sees at most one row per id and calendar day.
    """
    counted = events.filter(F.col(by).isNotNull() & F.col(event_day).isNotNull()).select(
        by, F.col(event_day).alias(order), F.lit(1).alias("_n"), F.lit(0).alias("_spine")
    )
    wanted = spine.select(by, order, F.lit(0).alias("_n"), F.lit(1).alias("_spine"))
    per_day = (
        wanted.unionByName(counted)
        .groupBy(by, order)
        .agg(F.sum("_n").alias("_n"), F.max("_spine").alias("_spine"))
    )
    ahead = W.partitionBy(by).orderBy(F.unix_date(order)).rangeBetween(0, days)
    return (
        per_day.withColumn(out, F.sum("_n").over(ahead))
        .filter(F.col("_spine") == 1)
        .select(by, order, out)
    )


def forward_count_join(
    spine: DataFrame,
    events: DataFrame,
    event_day: str,
    days: int = S.FORWARD_DAYS,
    by: str = S.AD_SET,
    order: str = S.DATE,
    out: str = "conv_7d",
) -> DataFrame:
    """The same count as an interval join of per-day counts.

    Each per-day count is sent to the `days + 1` days it counts for and summed
    there, which needs no window over an id's days.
    """
    per_day = events.groupBy(by, F.col(event_day).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    reached = per_day.select(
        by,
        F.explode(F.sequence(F.date_sub("_day", days), F.col("_day"))).alias(order),
        "_n",
    ).groupBy(by, order)
    keys = spine.select(by, order).distinct()
    return keys.join(reached.agg(F.sum("_n").alias(out)), [by, order], "left").fillna(0, [out])
