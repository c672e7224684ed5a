"""Raw files to layers again, rewriting only the days that a change reaches.

The first run builds everything. Later ones find the days whose raw rows have changed by
their fingerprints, rewrite these days of bronze and silver, and of each gold table the
days that depend on them: daily metrics on the day itself, the seven-day count on the
days up to a week before, the next row's pacing on the day of the row before. Fingerprints
are kept last, so a run that failed is made up for by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.measures import day
from pacewise.operators import changes, clean, quality, rolled
from pacewise.operators.conformed import daily_metrics
from pacewise.session import cut
from pacewise.sources import schemas as S
from pacewise.sources.readers import cast_columns, read_strict
from pacewise.sources.tables import ensure_layers, on_days, replace_days, swap_table, table_exists

CLEANERS = {
    S.PERFORMANCE: clean.clean_performance,
    S.BUDGET: clean.clean_budget,
    S.CONVERSIONS: clean.clean_conversions,
}
DAILY, COUNTS, PACING = "daily_metrics", "conversions_7d", "pacing"
QUALITY, PRINTS = "data_quality_report", "day_fingerprints"


@dataclass
class Run:
    """Where the raw files are and how the layers are called."""

    paths: dict[str, str]
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


def _typed(bronze: DataFrame, table: str) -> DataFrame:
    types = {c: t for c, t in S.RAW_TYPES[table].items() if c != S.DATE}
    return cast_columns(bronze, types)


def _prints(spark: SparkSession, run: Run, table: str) -> DataFrame:
    name = f"{run.bronze}.{PRINTS}_{table}"
    if not table_exists(spark, name):
        return spark.createDataFrame([], changes.PRINTS)
    return spark.table(name)


def update(spark: SparkSession, run: Run) -> dict[str, list]:
    """Bring the layers up to the raw files; the days rewritten of each table.

    Days are few, whatever the size of the files: their fingerprints are compared by
    Spark and the list of changed ones comes to the driver.
    """
    ensure_layers(spark, [run.bronze, run.silver, run.gold])
    written: dict[str, list] = {}
    now, changed, before = {}, {}, {}
    for table in CLEANERS:
        raw = read_strict(spark, run.paths[table], table).withColumn(S.DATE, day(S.DATE))
        now[table] = cut(changes.fingerprints(raw))
        changed[table] = changes.changed_days(_prints(spark, run, table), now[table])
        bronze = f"{run.bronze}.{table}"
        if table == S.BUDGET and table_exists(spark, bronze):
            before[table] = cut(spark.table(bronze).select(S.AD_SET, S.DATE).distinct())
        if not changed[table]:
            if not table_exists(spark, bronze):
                _replace(raw, bronze, [], written)
                _replace(raw.transform(CLEANERS[table]), f"{run.silver}.{table}", [], written)
            continue
        _replace(on_days(raw, changed[table]), bronze, changed[table], written)
        fresh = on_days(spark.table(bronze), changed[table]).transform(CLEANERS[table])
        _replace(fresh, f"{run.silver}.{table}", changed[table], written)
    bronze = {t: spark.table(f"{run.bronze}.{t}") for t in CLEANERS}
    _daily(spark, run, changed, written)
    _counts(spark, run, bronze, changed, written)
    _pacing(spark, run, bronze[S.BUDGET], before.get(S.BUDGET), changed[S.BUDGET], written)
    if any(changed.values()) or not table_exists(spark, f"{run.gold}.{QUALITY}"):
        swap_table(quality.profile(spark.table(f"{run.gold}.{DAILY}")), f"{run.gold}.{QUALITY}")
    for table in CLEANERS:
        if changed[table]:
            swap_table(now[table], f"{run.bronze}.{PRINTS}_{table}")
    return written


def _replace(df: DataFrame, name: str, days: list, written: dict[str, list]) -> None:
    replace_days(df, name, days, sort_by=S.KEYS)
    written[name.rpartition(".")[0].split("_")[0] + "." + name.rpartition(".")[2]] = days


def _union(*lists: list) -> list:
    return changes._sorted(reduce(set.union, map(set, lists), set()))


def _missing(spark: SparkSession, name: str) -> bool:
    return not table_exists(spark, name)


def _daily(spark: SparkSession, run: Run, changed: dict, written: dict) -> None:
    days, name = _union(*changed.values()), f"{run.gold}.{DAILY}"
    if days or _missing(spark, name):
        silver = [on_days(spark.table(f"{run.silver}.{t}"), days) for t in CLEANERS]
        _replace(daily_metrics(*silver), name, days, written)


def _counts(spark: SparkSession, run: Run, bronze: dict, changed: dict, written: dict) -> None:
    """Conversions up to a week ahead: a changed conversion reaches the week before it."""
    name = f"{run.gold}.{COUNTS}"
    reached = changes.days_before(changed[S.CONVERSIONS], S.FORWARD_DAYS)
    days = _union(changed[S.PERFORMANCE], reached)
    if not days and not _missing(spark, name):
        return
    rows = _typed(on_days(bronze[S.PERFORMANCE], days), S.PERFORMANCE)
    performance = rolled.performance_by_day(rows)
    dated = [d for d in days if d is not None]
    events = rolled.conversion_days(_typed(bronze[S.CONVERSIONS], S.CONVERSIONS))
    if dated:
        last = F.date_add(F.lit(max(dated)), S.FORWARD_DAYS)
        events = events.where(F.col("conv_date").between(F.lit(min(dated)), last))
    _replace(rolled.conversions_7d(performance, events), name, days, written)


def _pacing(
    spark: SparkSession, run: Run, budget: DataFrame, before: DataFrame | None, changed: list, written: dict
) -> None:
    """The next row's ratio: a change reaches the row before it, however long ago that was."""
    name = f"{run.gold}.{PACING}"
    if not changed and not _missing(spark, name):
        return
    versions = [budget.select(S.AD_SET, S.DATE)] + ([before] if before is not None else [])
    days = changes.days_of_previous_rows(changed, *versions)
    rows = _typed(budget, S.BUDGET).select(
        S.AD_SET, S.DATE, F.col("budget_utilization").alias("pacing_ratio")
    )
    dated = [d for d in days if d is not None]
    if dated and None not in days:
        rows = rows.where(F.col(S.DATE) >= F.lit(min(dated)))
    _replace(on_days(rolled.adset_pacing(rows), days), name, days, written)
