"""Operators over daily rows: lags, weeks, backtests, a naive forecast, drift, last touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacewise.sources import schemas as S


def lag_features(
    daily: DataFrame, columns: list[str], lags: list[int], by: str = S.AD_SET, order: str = S.DATE
) -> DataFrame:
    """Add `<column>_lag<n>`: the value n rows earlier, null where there is none.

    `daily` has one row per (by, order), so a window holds one row per calendar day.
    """
    days = W.partitionBy(by).orderBy(order)
    return daily.withColumns(
        {f"{c}_lag{n}": F.lag(c, n).over(days) for c in columns for n in lags}
    )


def weekly_totals(daily: DataFrame, columns: list[str], by: str = S.AD_SET) -> DataFrame:
    """Sums per `by` and week, named by its Monday."""
    week = F.to_date(F.date_trunc("week", S.DATE)).alias("week")
    return daily.groupBy(by, week).agg(*[F.sum(c).alias(c) for c in columns])


def expanding_folds(
    df: DataFrame, folds: int, horizon: int, date_col: str = S.DATE
) -> DataFrame:
    """Each row once per fold that it belongs to, with `fold` and `split`.

    The last fold is tested on the latest `horizon` days, the one before it on the
    `horizon` days before these, and so on; each trains on all earlier days.
    """
    last = df.agg(F.max(date_col)).scalar()
    ahead = F.floor(F.datediff(last, F.col(date_col)) / F.lit(horizon)).cast("int")
    tested = F.lit(folds - 1) - ahead
    part = F.when(F.col("fold") == tested, F.lit("valid")).otherwise(F.lit("train"))
    # A row trains in the folds behind the one that tests it; old rows train in all.
    first = F.greatest(tested, F.lit(0))
    return (
        df.filter(F.col(date_col).isNotNull())
        .withColumn("fold", F.explode(F.sequence(first, F.lit(folds - 1))))
        .withColumn("split", part)
    )


def average_forecast(
    series: DataFrame, column: str, window: int = S.MA_WINDOW, order: str = S.DATE
) -> DataFrame:
    """Add `forecast`: the mean of the `window` rows before; the first row has none.

    `series` has one row per day.
    """
    before = W.orderBy(order).rowsBetween(-window, -1)
    return series.withColumn("forecast", F.avg(column).over(before))


def drift(df: DataFrame, columns: list[str], since: Column, date_col: str = S.DATE) -> DataFrame:
    """Per column the mean before and since a day, and their distance in earlier deviations."""
    late = F.col(date_col) >= since
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats += [
            F.avg(F.when(~late, x)).alias(f"{c}_was"),
            F.avg(F.when(late, x)).alias(f"{c}_is"),
            F.stddev_samp(F.when(~late, x)).alias(f"{c}_std"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_was").alias("mean_before"),
                F.col(f"{c}_is").alias("mean_since"),
                ((F.col(f"{c}_is") - F.col(f"{c}_was")) / F.nullif(F.col(f"{c}_std"), F.lit(0.0))).alias(
                    "shift"
                ),
            )
            for c in columns
        ]
    )
    return df.agg(*stats).select(F.inline(rows))


def last_touch(
    events: DataFrame,
    daily: DataFrame,
    days: int,
    event_id: str = "conversion_id",
    by: str = S.AD_SET,
    order: str = S.DATE,
) -> DataFrame:
    """Add `touch_date`: the latest day of the same `by` with a row, up to `days` back.

    Days per (by, event day) are looked up once, however many events share them: each
    such key is sent to the days it can reach and joined there.
    """
    wanted = events.select(by, order).distinct()
    reach = F.explode(F.sequence(F.date_sub(order, days), F.col(order))).alias("touch_date")
    active = daily.select(F.col(by).alias("active_by"), F.col(order).alias("active_day")).distinct()
    found = (
        wanted.select(by, order, reach)
        .join(active, (F.col(by) == F.col("active_by")) & (F.col("touch_date") == F.col("active_day")))
        .groupBy(F.col(by).alias("found_by"), F.col(order).alias("found_day"))
        .agg(F.max("touch_date").alias("touch_date"))
    )
    same = (F.col(by) == F.col("found_by")) & (F.col(order) == F.col("found_day"))
    return events.join(found, same, "left").select(event_id, by, order, "touch_date")
