"""The questions a dashboard asks of the gold tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.functions import text
from pacewise.functions.measures import pacing_band, percent_change, ratio
from pacewise.operators.ranks import exact_quantiles
from pacewise.operators.windows import moving_average
from pacewise.session import cut
from pacewise.sources import schemas as S


def _sum(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


# --- filters -----------------------------------------------------------------


def select_rows(
    df: DataFrame,
    ad_sets: list[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Chosen ad sets and an inclusive date range."""
    if ad_sets is not None:
        df = df.filter(F.col(S.AD_SET).isin(ad_sets))
    if start is not None:
        df = df.filter(F.col(S.DATE) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(S.DATE) <= F.lit(end))
    return df


def last_days(df: DataFrame, days: int, end: date | None = None) -> DataFrame:
    """The trailing `days` days, counted from `end` or else from the latest date."""
    last = F.lit(end) if end is not None else df.agg(F.max(S.DATE)).scalar()
    return df.filter(F.col(S.DATE) >= F.date_sub(last, days - 1))


def ad_set_choices(df: DataFrame) -> DataFrame:
    return df.select(S.AD_SET).distinct().orderBy(S.AD_SET)


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min(S.DATE).alias("min_date"), F.max(S.DATE).alias("max_date"))


# --- totals and series ---------------------------------------------------------


def daily_totals(df: DataFrame) -> DataFrame:
    """Spend and revenue per day; rows without a date belong to no day."""
    return df.dropna(subset=[S.DATE]).groupBy(S.DATE).agg(
        F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue")
    )


def daily_with_average(df: DataFrame, window: int = S.MA_WINDOW) -> DataFrame:
    """Daily spend and revenue with their trailing averages."""
    return moving_average(daily_totals(df), ["spend", "revenue"], window)


def series_summary(series: DataFrame, column: str, average: str) -> DataFrame:
    """Sum, mean, population std, last trailing average and length of a daily series."""
    return series.agg(
        _sum(column).alias(f"{column}_sum"),
        F.avg(column).alias(f"{column}_mean"),
        F.stddev_pop(column).alias(f"{column}_std"),
        F.coalesce(F.max_by(average, S.DATE), F.lit(0.0)).alias(f"{average}_last"),
        F.count(F.lit(1)).alias("n_days"),
    )


def kpi_totals(df: DataFrame, bookings: str = "bookings") -> DataFrame:
    return df.agg(
        _sum("spend").alias("spend_total"),
        _sum("revenue").alias("revenue_total"),
        F.coalesce(F.sum(bookings), F.lit(0)).alias("bookings_total"),
    ).withColumn("roas_overall", ratio("revenue_total", "spend_total", empty=0.0))


def _estimated(mean: Column, days: int) -> Column:
    """Bookings of a period from the mean seven-day count; halves round to even."""
    return F.bround(F.coalesce(mean, F.lit(0.0)) / 7.0 * days).cast("bigint")


def estimated_bookings(df: DataFrame, days: int) -> DataFrame:
    return df.agg(_estimated(F.avg("conv_7d"), days).alias("bookings_total"))


def period_kpis(df: DataFrame, start: date, end: date) -> DataFrame:
    """KPIs of [start, end], of the equally long period before it, and the changes.

    One pass: every row belongs to one of the two periods.
    """
    days = (end - start).days + 1
    before = start - timedelta(days=days)
    current = F.col(S.DATE) >= F.lit(start)

    def both(name: str, make) -> list[Column]:
        return [make(current).alias(name), make(~current).alias(f"{name}_prev")]

    totals = select_rows(df, start=before, end=end).agg(
        *both("spend_total", lambda p: _sum(F.when(p, F.col("spend")))),
        *both("revenue_total", lambda p: _sum(F.when(p, F.col("revenue")))),
        *both("bookings_total", lambda p: _estimated(F.avg(F.when(p, F.col("conv_7d"))), days)),
    )
    totals = totals.withColumns(
        {
            "roas_overall": ratio("revenue_total", "spend_total", empty=0.0),
            "roas_overall_prev": ratio("revenue_total_prev", "spend_total_prev", empty=0.0),
        }
    )

    def change(name: str, floor: float) -> Column:
        now, was = F.col(name), F.col(f"{name}_prev")
        return F.when(was != 0, percent_change(now, was, floor)).alias(f"{name}_change")

    return totals.select(
        "*", change("spend_total", 1e-9), change("bookings_total", 1.0), change("roas_overall", 1e-9)
    )


def first_to_last_change(df: DataFrame) -> DataFrame:
    """Percent change of spend and revenue from the first to the last row that has a date."""
    place = F.struct(S.DATE, S.AD_SET)
    return df.dropna(subset=[S.DATE]).agg(
        *[
            percent_change(F.max_by(c, place), F.min_by(c, place)).alias(f"{c}_change")
            for c in ["spend", "revenue"]
        ]
    )


def spend_scenarios(df: DataFrame, scales: list[float]) -> DataFrame:
    """Total spend under each scale."""
    grid = F.array(*[F.lit(float(s)) for s in scales])
    return (
        df.agg(_sum("spend").alias("spend"))
        .select("spend", F.explode(grid).alias("scale"))
        .select("scale", (F.col("spend") * F.col("scale")).alias("adjusted_spend"))
    )


# --- ROAS by ad set -------------------------------------------------------------


def roas_by_ad_set(df: DataFrame, min_impressions: int | None = None) -> DataFrame:
    """Ratio of sums per ad set; ad sets below the volume limit are left out.

    Rows without an ad set belong to none and are left out, too.
    """
    sums = [F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue")]
    if min_impressions is not None:
        sums += [F.sum("impressions").alias("impressions"), F.avg("ctr").alias("ctr")]
    out = df.dropna(subset=[S.AD_SET]).groupBy(S.AD_SET).agg(*sums)
    if min_impressions is not None:
        out = out.filter(F.col("impressions") >= min_impressions)
    return out.withColumn("roas", ratio("revenue", "spend", empty=0.0))


def best(per_ad_set: DataFrame, n: int = 5) -> DataFrame:
    return per_ad_set.orderBy(F.desc("roas"), S.AD_SET).limit(n)


def worst(per_ad_set: DataFrame, n: int = 5, worst_first: bool = True) -> DataFrame:
    """The n lowest; with worst_first=False they are listed from high to low."""
    lowest = per_ad_set.orderBy("roas", F.desc(S.AD_SET)).limit(n)
    return lowest if worst_first else lowest.orderBy(F.desc("roas"), S.AD_SET)


# Printed titles.
ROAS_TITLES = {
    "ad_set_id": "Ad set",
    "spend": "Spend (£)",
    "revenue": "Revenue (£)",
    "roas": "ROAS (x)",
}


def roas_table(rows: DataFrame) -> DataFrame:
    """Report columns under their printed titles."""
    return rows.select(*ROAS_TITLES).withColumnsRenamed(ROAS_TITLES)


def roas_spread(per_ad_set: DataFrame, target: float | None = None) -> DataFrame:
    """Number of ad sets and their highest, lowest and median ROAS (0 when none).

    With `target`, the ROAS that is aimed at stands beside them.
    """
    per_ad_set = cut(per_ad_set)
    median = exact_quantiles(per_ad_set, "roas", [0.5]).scalar()
    spread = per_ad_set.agg(
        F.count(F.lit(1)).alias("adsets"),
        F.coalesce(F.max("roas"), F.lit(0.0)).alias("top_roas"),
        F.coalesce(F.min("roas"), F.lit(0.0)).alias("bottom_roas"),
    ).withColumn("median_roas", F.coalesce(F.get(median, F.lit(0)), F.lit(0.0)))
    return spread if target is None else spread.withColumn("target", F.lit(float(target)))


def roas_quartiles(per_ad_set: DataFrame) -> DataFrame:
    bounds = exact_quantiles(per_ad_set, "roas", [0.25, 0.75])
    return bounds.select(
        F.get("quantiles", F.lit(0)).alias("q1"), F.get("quantiles", F.lit(1)).alias("q3")
    )


# --- pacing mix -------------------------------------------------------------------


def with_band(pacing: DataFrame) -> DataFrame:
    return pacing.withColumn("pacing_status", pacing_band())


def pacing_mix(df: DataFrame) -> DataFrame:
    """Rows per day and status."""
    return df.groupBy(S.DATE, "pacing_status").agg(F.count(F.lit(1)).alias("count"))


def pacing_totals(df: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Distinct days and rows per status over the whole selection, zeros included."""
    return df.agg(
        F.count_distinct(S.DATE).alias("days"),
        *[
            F.count_if(F.col("pacing_status") == s).alias(s)
            for s in statuses or S.PACING_BANDS
        ],
    )


# --- payloads and texts -----------------------------------------------------------


# The printed bounds of the bands.
BAND_BOUNDS = {"under": "<0.90", "on": "0.90–1.10", "over": ">1.10"}


def kpi_payload(
    df: DataFrame,
    pacing: DataFrame,
    start: date,
    end: date,
    ad_sets: list[str] | None = None,
    min_impressions: int = S.MIN_IMPRESSIONS,
) -> DataFrame:
    """One row: the period, a struct of KPI totals and a map of the pacing mix.

    With `ad_sets`, the ad sets of a selection, all of it is of these, and the row also
    has the list `roas_by_adset` of those with enough impressions, as long as the
    selection at most. For lists without such a bound there is `ad_set_payload`.
    """
    df, pacing = select_rows(df, ad_sets), select_rows(pacing, ad_sets)
    days = (end - start).days + 1
    chosen = select_rows(df, start=start, end=end)
    kpis = chosen.agg(
        _sum("spend").alias("spend_total"),
        _sum("revenue").alias("revenue_total"),
        _estimated(F.avg("conv_7d"), days).alias("bookings_total"),
    ).withColumn("roas_overall", ratio("revenue_total", "spend_total", empty=0.0))
    mix = pacing_totals(with_band(select_rows(pacing, start=start, end=end)))
    pairs = [x for band in S.PACING_BANDS for x in (F.lit(band), F.col(band))]
    if ad_sets is not None:
        rows = ad_set_payload(chosen, min_impressions)
        listed = rows.agg(F.array_sort(F.collect_list("roas_by_adset"))).scalar()
        kpis = kpis.withColumn("roas_by_adset", listed)
    return kpis.select(
        F.lit(f"{start} to {end}").alias("period"),
        F.struct("spend_total", "revenue_total", "bookings_total", "roas_overall").alias("kpis"),
        mix.select(F.create_map(*pairs)).scalar().alias("pacing_mix"),
        *(["roas_by_adset"] if ad_sets is not None else []),
    )


def ad_set_payload(df: DataFrame, min_impressions: int = S.MIN_IMPRESSIONS) -> DataFrame:
    """The payload's list of ad sets, one struct per row, so its length is no limit."""
    return roas_by_ad_set(df, min_impressions).select(
        F.struct(S.AD_SET, "roas", "spend").alias("roas_by_adset")
    )


def roas_payload(df: DataFrame, min_impressions: int = S.MIN_IMPRESSIONS, n: int = 3) -> DataFrame:
    """One row: number of ad sets, the volume limit, the n best and n worst as arrays."""
    per_ad_set = cut(roas_by_ad_set(df, min_impressions))
    fields = [S.AD_SET, "roas", "spend", "impressions"]

    def listed(rows: DataFrame, sign: int) -> Column:
        ranked = F.sort_array(
            F.collect_list(F.struct((F.col("roas") * sign).alias("rank"), *fields))
        )
        plain = F.transform(ranked, lambda r: F.struct(*[r[f].alias(f) for f in fields]))
        return rows.agg(plain).scalar()

    return per_ad_set.agg(F.count(F.lit(1)).alias("adsets")).select(
        "adsets",
        F.lit(min_impressions).alias("min_impressions"),
        listed(best(per_ad_set, n), -1).alias(f"top{n}"),
        listed(worst(per_ad_set, n), 1).alias(f"bottom{n}"),
    )


def pacing_payload(pacing: DataFrame) -> DataFrame:
    """One row: number of days, a map of the pacing totals and the bounds of the bands."""
    pairs = [x for band in S.PACING_BANDS for x in (F.lit(band), F.col(band))]
    return pacing_totals(with_band(pacing)).select(
        "days",
        F.create_map(*pairs).alias("mix_totals"),
        F.create_map(*[F.lit(x) for pair in BAND_BOUNDS.items() for x in pair]).alias("bands"),
    )


def as_json(payload: DataFrame) -> DataFrame:
    return payload.select(F.to_json(F.struct("*")).alias("payload"))


def overview_text(df: DataFrame, n: int = 5) -> DataFrame:
    """Rule-based summary: how spend and revenue moved, and the ad sets to favour."""
    top = best(roas_by_ad_set(df), n)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("roas")).alias("rank"), S.AD_SET)))
    names = top.agg(F.transform(ranked, lambda r: r[S.AD_SET].cast("string"))).scalar()
    return (
        first_to_last_change(df)
        .withColumn("_top", names)
        .select(
            text.summary(
                F.array(
                    text.change_sentence(F.col("spend_change"), F.col("revenue_change")),
                    text.focus_sentence(F.col("_top")),
                )
            ).alias("summary")
        )
    )


# --- label balance -------------------------------------------------------------------


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives, positive rate and the weight neg / pos for positives."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("pos"), neg.alias("neg")).withColumns(
        {
            "label_rate": F.col("pos") / F.greatest(F.col("pos") + F.col("neg"), F.lit(1)),
            "pos_weight": F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).otherwise(
                F.lit(1.0)
            ),
        }
    )


def importance_ranking(importances: DataFrame) -> DataFrame:
    """Share in percent per feature, largest first; unscaled when all are zero."""
    total = importances.agg(F.sum("importance")).scalar()
    share = F.when(total > 0, F.col("importance") / total * 100.0).otherwise(F.col("importance"))
    return importances.select("feature", share.alias("importance_pct")).orderBy(
        F.desc("importance_pct"), "feature"
    )
