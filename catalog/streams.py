"""Queries over what micro-batches of exports leave in the layers."""

from __future__ import annotations

from datetime import date
from functools import cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import star
from catalog.layers import BY_KEY_DIGITS, DAILY_BY_KEY, DAILY_DIGITS
from catalog.registry import Registry
from pacewise.functions import measures as M
from pacewise.session import ensure_checkpoint_dir, kept
from pacewise.sources import schemas as S
from pacewise.sources.tables import export_csv
from pacewise.streaming import ingest as I

LATE, REPEATED, CORRECTED = 0, 1, 2


def _kind() -> Column:
    """One of ten kinds of an ad set's day, from its number and its date."""
    number = F.coalesce(F.col(S.AD_SET).cast("bigint"), F.lit(0))
    return F.pmod(number * 7 + F.unix_date(M.day(S.DATE)), F.lit(10))


def _wrong(raw: DataFrame, table: str) -> DataFrame:
    """The rows as an earlier export had them: other amounts, and each of them twice."""
    amount = {S.PERFORMANCE: "spend", S.BUDGET: "actual_spend", S.CONVERSIONS: "value"}[table]
    more = (F.col(amount).cast("double") + 1).cast("string")
    wrong = raw.withColumn(amount, more)
    return wrong.unionByName(wrong.withColumn(amount, (more.cast("double") + 1).cast("string")))


@cache
def _raw(spark: SparkSession, d: str, table: str) -> DataFrame:
    """The raw rows, derived and written down once for all parts of both exports."""
    return kept(star.RAW[table](spark, d))


@cache
def _until(spark: SparkSession, d: str) -> date:
    """The last day that the first export reaches."""
    days = _raw(spark, d, S.PERFORMANCE).agg(
        F.min(M.day(S.DATE)).alias("first"), F.max(M.day(S.DATE)).alias("last")
    )
    third = F.floor(F.datediff("last", "first") * 2 / 3).cast("int")
    return days.select(F.date_add("first", third)).first()[0]


def _exports(spark: SparkSession, d: str, table: str) -> tuple[DataFrame, DataFrame]:
    """The raw rows in two exports; the second has late, repeated and corrected rows."""
    raw, until = _raw(spark, d, table), F.lit(_until(spark, d)).cast("date")
    old, kind = M.day(S.DATE) <= until, _kind()
    first = raw.where(old & ~kind.isin(LATE, CORRECTED)).unionByName(
        _wrong(raw.where(old & (kind == CORRECTED)), table)
    )
    return first, raw.where(~old | kind.isin(LATE, REPEATED, CORRECTED))


@cache
def streamed(spark: SparkSession, d: str) -> tuple[I.Stream, list[dict[str, int]]]:
    """Three runs: over the first export, over the second, over nothing new."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid4().hex}"
    stream = I.Stream(f"{folder}/exports", f"{folder}/layers")
    runs = []
    for number in (1, 2, 3):
        for table in I.CLEANERS if number < 3 else ():
            rows = _exports(spark, d, table)[number - 1]
            export_csv(rows, f"{stream.source}/{table}/{I.EXPORT}={number}")
        runs.append(I.ingest(spark, stream))
    return stream, runs


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """What each run did: whether it took in batches, and the days of gold it rebuilt."""
    _, runs = streamed(spark, d)
    rows = [
        (n + 1, sum(run[t] > 0 for t in I.CLEANERS), run["days"]) for n, run in enumerate(runs)
    ]
    return spark.createDataFrame(rows, "run int, tables int, days bigint")


CLASSED = """
    SELECT *, ((coalesce(ad_set_id::BIGINT, 0) * 7 + (date - DATE '1970-01-01')) % 10) AS kind,
           (SELECT min(date) + (floor((max(date) - min(date)) * 2 / 3))::INTEGER
            FROM raw_performance) AS until"""


def add_to(r: Registry) -> None:
    r.add(
        "e06_stream_daily",
        lambda s, d: I.gold(s, streamed(s, d)[0]),
        DAILY_BY_KEY,
        BY_KEY_DIGITS,
    )
    r.add(
        "e06_stream_conversions",
        lambda s, d: I.silver(s, streamed(s, d)[0], S.CONVERSIONS),
        "SELECT * FROM slv_conversions",
    )
    r.add(
        "e06_stream_performance",
        lambda s, d: I.silver(s, streamed(s, d)[0], S.PERFORMANCE),
        "SELECT * FROM slv_performance",
        {c: DAILY_DIGITS[c] for c in ("spend", "ctr", "cpm")},
    )
    every = " UNION ALL ".join(
        f"{CLASSED} FROM {t}" for t in ("raw_performance", "raw_budget", "raw_conversions")
    ).replace("SELECT *,", "SELECT date,")
    r.add(
        "e06_stream_runs",
        _runs,
        f"""SELECT 1 AS run, 3 AS tables, count(DISTINCT date) FILTER (date <= until AND kind <> 0)
                   AS days FROM ({every})
            UNION ALL
            SELECT 2, 3, count(DISTINCT date) FILTER (date > until OR kind <= 2) FROM ({every})
            UNION ALL SELECT 3, 0, 0""",
    )
    r.add(
        "e06_closed_days",
        lambda s, d: I.closed_days(s, streamed(s, d)[0]),
        f"""SELECT date, CAST(sum(n) AS BIGINT) AS "rows", max(export) AS last_export
            FROM (SELECT date, until, unnest([1, 2]) AS run,
                         CASE WHEN run = 1 AND date <= until AND kind <> 0
                                   THEN CASE WHEN kind = 2 THEN 2 ELSE 1 END
                              WHEN run = 2 AND (date > until OR kind <= 2) THEN 1 ELSE 0 END AS n,
                         CASE WHEN n > 0 THEN run::VARCHAR END AS export
                  FROM ({CLASSED} FROM raw_performance)),
                 (SELECT max(date) FILTER (date <= until AND kind <> 0) - 8 AS closed_1,
                         max(date) FILTER (date > until OR kind <= 2) - 8 AS closed_2
                  FROM ({CLASSED} FROM raw_performance))
            WHERE n > 0 AND (date <= closed_1 AND run = 1 OR date > closed_1 AND date <= closed_2)
            GROUP BY date""",
    )

