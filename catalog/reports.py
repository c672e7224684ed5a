"""Queries a dashboard asks: filters, KPIs, rankings, mixes, texts, scenarios."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import star
from catalog.layers import pacing, train
from catalog.registry import Registry
from pacewise.functions import text
from pacewise.operators import report, whatif, windows
from pacewise.sources import schemas as S

START, END = date(1997, 1, 1), date(1998, 12, 31)
WEEK_START, WEEK_END = date(2024, 1, 11), date(2024, 1, 20)
AD_SETS = [str(i) for i in range(1, 8)]
MONEY = {"spend": 4, "revenue": 4}
KPIS = {"spend_total": 4, "revenue_total": 4, "roas_overall": 6}


def gold(spark: SparkSession, d: str) -> DataFrame:
    return star.sales_gold(spark, d)


def per_ad(spark: SparkSession, d: str) -> DataFrame:
    return report.roas_by_ad_set(gold(spark, d))


def per_ad_volume(spark: SparkSession, d: str) -> DataFrame:
    return report.roas_by_ad_set(gold(spark, d), S.MIN_IMPRESSIONS)


def add_to(r: Registry) -> None:
    filters(r)
    totals(r)
    rankings(r)
    mixes(r)
    payloads(r)
    texts(r)
    scenarios(r)


def filters(r: Registry) -> None:
    ids = ", ".join(f"'{a}'" for a in AD_SETS)
    r.add(
        "f20_selected_rows",
        lambda s, d: report.select_rows(gold(s, d), AD_SETS, START, END).select(
            *S.KEYS, "order_key", "line_number", "spend"
        ),
        f"""SELECT date, ad_set_id, order_key, line_number, spend FROM gold
            WHERE ad_set_id IN ({ids}) AND date BETWEEN '{START}' AND '{END}'""",
        {"spend": 4},
    )
    for days in (7, 14):
        r.add(
            f"f21_last_{days}_days",
            lambda s, d, days=days: report.last_days(gold(s, d), days).select(
                *S.KEYS, "order_key", "line_number"
            ),
            f"""SELECT date, ad_set_id, order_key, line_number FROM gold
                WHERE date > (SELECT max(date) FROM gold) - {days}""",
        )
    r.add(
        "f21_x02_last_7_days_to_end",
        lambda s, d: report.last_days(
            report.select_rows(gold(s, d), end=END), S.FORWARD_DAYS, END
        ).select(*S.KEYS, "order_key", "line_number"),
        f"""SELECT date, ad_set_id, order_key, line_number FROM gold
            WHERE date BETWEEN DATE '{END}' - 6 AND '{END}'""",
    )
    r.add(
        "f25_ad_set_choices",
        lambda s, d: report.ad_set_choices(gold(s, d)),
        "SELECT DISTINCT ad_set_id FROM gold ORDER BY 1",
    )
    r.add(
        "f25_date_bounds",
        lambda s, d: report.date_bounds(gold(s, d)),
        "SELECT min(date) AS min_date, max(date) AS max_date FROM gold",
    )
    r.add(
        "f26_first_to_last_change",
        lambda s, d: report.first_to_last_change(
            gold(s, d).groupBy(*S.KEYS).agg(
                F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue")
            )
        ),
        """SELECT (last(spend ORDER BY date, ad_set_id) - first(spend ORDER BY date, ad_set_id))
                  / greatest(first(spend ORDER BY date, ad_set_id), 1e-9) * 100 AS spend_change,
                  (last(revenue ORDER BY date, ad_set_id) - first(revenue ORDER BY date, ad_set_id))
                  / greatest(first(revenue ORDER BY date, ad_set_id), 1e-9) * 100 AS revenue_change
           FROM (SELECT date, ad_set_id, sum(spend) AS spend, sum(revenue) AS revenue
                 FROM gold GROUP BY ALL)""",
        {"spend_change": 4, "revenue_change": 4},
    )
    r.add(
        "f27_spend_scenarios",
        lambda s, d: report.spend_scenarios(gold(s, d), [0.5, 0.75, 1.0, 1.25, 1.5]),
        """SELECT scale, (SELECT sum(spend) FROM gold) * scale AS adjusted_spend
           FROM (SELECT unnest([0.5, 0.75, 1.0, 1.25, 1.5]::DOUBLE[]) AS scale)""",
        {"adjusted_spend": 3},
    )


def totals(r: Registry) -> None:
    r.add(
        "g11_daily_totals",
        lambda s, d: report.daily_totals(gold(s, d)),
        "SELECT date, sum(spend) AS spend, sum(revenue) AS revenue FROM gold GROUP BY date",
        MONEY,
    )
    r.add(
        "w02_moving_average",
        lambda s, d: report.daily_with_average(gold(s, d)),
        """SELECT *, avg(spend) OVER w AS spend_ma7, avg(revenue) OVER w AS revenue_ma7
           FROM (SELECT date, sum(spend) AS spend, sum(revenue) AS revenue FROM gold GROUP BY date)
           WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        MONEY | {"spend_ma7": 6, "revenue_ma7": 6},
    )
    r.add(
        "w02_moving_average_per_ad_set",
        lambda s, d: windows.moving_average(
            gold(s, d).groupBy(*S.KEYS).agg(F.sum("spend").alias("spend")),
            ["spend"],
            by=[S.AD_SET],
        ),
        """SELECT *, avg(spend) OVER (PARTITION BY ad_set_id ORDER BY date
                  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS spend_ma7
           FROM (SELECT date, ad_set_id, sum(spend) AS spend FROM gold GROUP BY ALL)""",
        {"spend": 4, "spend_ma7": 6},
    )
    r.add(
        "g19_w04_series_summary",
        lambda s, d: report.series_summary(
            report.daily_with_average(gold(s, d)), "spend", "spend_ma7"
        ),
        """SELECT sum(spend) AS spend_sum, avg(spend) AS spend_mean, stddev_pop(spend) AS spend_std,
                  max_by(ma, date) AS spend_ma7_last, count(*) AS n_days
           FROM (SELECT date, spend, avg(spend) OVER (ORDER BY date
                        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma
                 FROM (SELECT date, sum(spend) AS spend FROM gold GROUP BY date))""",
        {"spend_sum": 4, "spend_mean": 4, "spend_std": 4, "spend_ma7_last": 6},
    )
    r.add(
        "g16_kpi_totals",
        lambda s, d: report.kpi_totals(gold(s, d)),
        """SELECT sum(spend) AS spend_total, sum(revenue) AS revenue_total,
                  CAST(sum(bookings) AS BIGINT) AS bookings_total,
                  sum(revenue) / sum(spend) AS roas_overall FROM gold""",
        KPIS,
    )
    r.add(
        "g17_estimated_bookings",
        lambda s, d: report.estimated_bookings(train(s, d), 30),
        "SELECT CAST(round_even(avg(conv_7d) / 7 * 30, 0) AS BIGINT) AS bookings_total FROM train",
    )
    days = (WEEK_END - WEEK_START).days + 1
    r.add(
        "g18_period_kpis",
        lambda s, d: report.period_kpis(train(s, d), WEEK_START, WEEK_END),
        f"""SELECT *,
                CASE WHEN spend_total_prev <> 0 THEN
                    (spend_total / spend_total_prev - 1) * 100 END AS spend_total_change,
                CASE WHEN bookings_total_prev <> 0 THEN
                    (bookings_total - bookings_total_prev) * 100.0::DOUBLE
                    / bookings_total_prev END AS bookings_total_change,
                CASE WHEN roas_overall_prev <> 0 THEN
                    (roas_overall / roas_overall_prev - 1) * 100 END AS roas_overall_change
            FROM (SELECT *, revenue_total / spend_total AS roas_overall,
                         revenue_total_prev / spend_total_prev AS roas_overall_prev
                  FROM (SELECT sum(spend) FILTER (cur) AS spend_total,
                               sum(spend) FILTER (NOT cur) AS spend_total_prev,
                               sum(revenue) FILTER (cur) AS revenue_total,
                               sum(revenue) FILTER (NOT cur) AS revenue_total_prev,
                               CAST(round_even(avg(conv_7d) FILTER (cur) / 7 * {days}, 0)
                                    AS BIGINT) AS bookings_total,
                               CAST(round_even(avg(conv_7d) FILTER (NOT cur) / 7 * {days}, 0)
                                    AS BIGINT) AS bookings_total_prev
                        FROM (SELECT *, date >= '{WEEK_START}' AS cur FROM train
                              WHERE date BETWEEN DATE '{WEEK_START}' - {days} AND '{WEEK_END}')))""",
        {
            "spend_total": 4,
            "spend_total_prev": 4,
            "revenue_total": 4,
            "revenue_total_prev": 4,
            "roas_overall": 6,
            "roas_overall_prev": 6,
            "spend_total_change": 4,
            "bookings_total_change": 4,
            "roas_overall_change": 4,
        },
    )
    r.add(
        "g23_class_balance",
        lambda s, d: report.class_balance(train(s, d), "label_under_pacing_next"),
        """SELECT sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg, avg(y) AS label_rate,
                  sum(1 - y) / sum(y)::DOUBLE AS pos_weight
           FROM (SELECT label_under_pacing_next AS y FROM train)""",
        {"label_rate": 6, "pos_weight": 6},
    )


def rankings(r: Registry) -> None:
    r.add(
        "g12_roas_by_ad_set",
        per_ad,
        "SELECT ad_set_id, spend, revenue, roas FROM per_ad",
        MONEY | {"roas": 6},
    )
    r.add(
        "g13_f22_roas_with_volume",
        per_ad_volume,
        f"""SELECT ad_set_id, spend, revenue, impressions, ctr, roas FROM per_ad
            WHERE impressions >= {S.MIN_IMPRESSIONS}""",
        MONEY | {"ctr": 5, "roas": 6},
    )
    r.add(
        "t02_top_5",
        lambda s, d: report.best(per_ad(s, d)),
        """SELECT ad_set_id, spend, revenue, roas FROM per_ad
           ORDER BY roas DESC, ad_set_id LIMIT 5""",
        MONEY | {"roas": 6},
    )
    lowest = """SELECT ad_set_id, spend, revenue, roas FROM per_ad
                ORDER BY roas, ad_set_id DESC LIMIT 5"""
    r.add("t02_bottom_5", lambda s, d: report.worst(per_ad(s, d)), lowest, MONEY | {"roas": 6})
    r.add(
        "t02_bottom_5_descending",
        lambda s, d: report.worst(per_ad(s, d), worst_first=False),
        lowest,
        MONEY | {"roas": 6},
    )
    r.add(
        "f28_roas_table",
        lambda s, d: report.roas_table(
            report.best(per_ad(s, d)).withColumns(
                {"spend": F.round("spend", 4), "revenue": F.round("revenue", 4), "roas": F.round("roas", 6)}
            )
        ),
        """SELECT ad_set_id AS "Ad set", round(spend, 4) AS "Spend (£)",
                  round(revenue, 4) AS "Revenue (£)", round(roas, 6) AS "ROAS (x)"
           FROM per_ad ORDER BY roas DESC, ad_set_id LIMIT 5""",
    )
    r.add(
        "g20_roas_spread",
        lambda s, d: report.roas_spread(per_ad(s, d)),
        """SELECT count(*) AS adsets, max(roas) AS top_roas, min(roas) AS bottom_roas,
                  median(roas) AS median_roas FROM per_ad""",
        {"top_roas": 6, "bottom_roas": 6, "median_roas": 6},
    )
    r.add(
        "g21_roas_quartiles",
        lambda s, d: report.roas_quartiles(per_ad(s, d)),
        "SELECT quantile_cont(roas, 0.25) AS q1, quantile_cont(roas, 0.75) AS q3 FROM per_ad",
        {"q1": 6, "q3": 6},
    )


def mixes(r: Registry) -> None:
    r.add(
        "g14_pacing_mix",
        lambda s, d: report.pacing_mix(gold(s, d)),
        'SELECT date, pacing_status, count(*) AS "count" FROM gold GROUP BY ALL',
    )
    r.add(
        "g14_band_mix",
        lambda s, d: report.pacing_mix(pacing(s, d)),
        'SELECT date, pacing_status, count(*) AS "count" FROM pacing GROUP BY ALL',
    )
    r.add(
        "g15_g22_pacing_totals",
        lambda s, d: report.pacing_totals(gold(s, d), [*S.PACING_STATUSES, S.UNKNOWN]),
        """SELECT count(DISTINCT date) AS days,
                  count(*) FILTER (pacing_status = 'under_pacing') AS under_pacing,
                  count(*) FILTER (pacing_status = 'on_pace') AS on_pace,
                  count(*) FILTER (pacing_status = 'over_pacing') AS over_pacing,
                  count(*) FILTER (pacing_status = 'unknown') AS unknown FROM gold""",
    )


def payloads(r: Registry) -> None:
    days = (WEEK_END - WEEK_START).days + 1
    r.add(
        "g24_kpi_payload",
        lambda s, d: report.kpi_payload(train(s, d), pacing(s, d), WEEK_START, WEEK_END).select(
            "period", "kpis.*", *[F.col("pacing_mix")[b].alias(f"mix_{b}") for b in S.PACING_BANDS]
        ),
        f"""SELECT '{WEEK_START} to {WEEK_END}' AS period, k.*, m.*
            FROM (SELECT sum(spend) AS spend_total, sum(revenue) AS revenue_total,
                         CAST(round_even(avg(conv_7d) / 7 * {days}, 0) AS BIGINT) AS bookings_total,
                         sum(revenue) / sum(spend) AS roas_overall
                  FROM train WHERE date BETWEEN '{WEEK_START}' AND '{WEEK_END}') k
            CROSS JOIN (SELECT count(*) FILTER (pacing_status = 'under') AS mix_under,
                         count(*) FILTER (pacing_status = 'on') AS mix_on,
                         count(*) FILTER (pacing_status = 'over') AS mix_over
                  FROM pacing WHERE date BETWEEN '{WEEK_START}' AND '{WEEK_END}') m""",
        KPIS,
    )
    r.add(
        "g24_ad_set_payload",
        lambda s, d: report.ad_set_payload(gold(s, d)).select("roas_by_adset.*"),
        f"""SELECT ad_set_id, roas, spend FROM per_ad
            WHERE impressions >= {S.MIN_IMPRESSIONS}""",
        {"roas": 6, "spend": 4},
    )
    r.add(
        "g24_t03_roas_payload",
        lambda s, d: _listed(report.roas_payload(gold(s, d), 1000)),
        """SELECT * FROM (
             SELECT 'top' AS list, row_number() OVER (ORDER BY roas DESC, ad_set_id) AS place,
                    ad_set_id, roas, spend, impressions FROM per_ad WHERE impressions >= 1000
             UNION ALL
             SELECT 'bottom', row_number() OVER (ORDER BY roas, ad_set_id DESC), ad_set_id, roas,
                    spend, impressions FROM per_ad WHERE impressions >= 1000)
           WHERE place <= 3""",
        {"roas": 6, "spend": 4},
    )
    r.add(
        "g24_pacing_payload",
        lambda s, d: report.pacing_payload(pacing(s, d)).select(
            "days", *[F.col("mix_totals")[b].alias(b) for b in S.PACING_BANDS]
        ),
        """SELECT count(DISTINCT date) AS days,
                  count(*) FILTER (pacing_status = 'under') AS under,
                  count(*) FILTER (pacing_status = 'on') AS "on",
                  count(*) FILTER (pacing_status = 'over') AS over FROM pacing""",
    )
    r.add("g24_json_payload", lambda s, d: report.as_json(report.roas_payload(gold(s, d), 1000)))


def _listed(payload: DataFrame) -> DataFrame:
    sides = F.array(
        F.struct(F.lit("top").alias("list"), F.col("top3").alias("rows")),
        F.struct(F.lit("bottom").alias("list"), F.col("bottom3").alias("rows")),
    )
    return (
        payload.select(F.inline(sides))
        .select("list", F.posexplode("rows").alias("place", "r"))
        .select("list", (F.col("place") + 1).cast("bigint").alias("place"), "r.*")
    )


def texts(r: Registry) -> None:
    cleaned = r"""
        SELECT {key}, CASE WHEN text IS NULL OR text = '' THEN '- No suggestions' ELSE
            array_to_string(list_transform(
                CASE WHEN len(parts) > 0 THEN parts[1:3] ELSE [flat] END,
                lambda p: '- ' || left(p, 300)), chr(10)) END AS suggestions
        FROM (SELECT *, list_filter(list_transform(
                  regexp_split_to_array(flat, ' ?[-\x{{2022}}] '), lambda p: trim(p)),
                  lambda p: p <> '') AS parts
              FROM (SELECT *, regexp_replace(replace(text, '$', '£'),
                  '[\t-\r\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+',
                  ' ', 'g') AS flat FROM {table}))"""
    r.add(
        "x09_clean_documents",
        lambda s, d: star.table(s, d, "documents").select(
            "doc_id", text.clean_suggestions("text").alias("suggestions")
        ),
        cleaned.format(key="doc_id", table="documents"),
    )
    r.add(
        "x09_clean_conversations",
        lambda s, d: star.table(s, d, "conversations").select(
            "conv_id", "turn", text.clean_suggestions("text").alias("suggestions")
        ),
        cleaned.format(key="conv_id, turn", table="conversations"),
    )
    r.add(
        "x10_formatted",
        lambda s, d: star.table(s, d, "customer").select(
            "c_custkey",
            text.pounds(F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))).alias("pounds"),
            text.percent(F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal") / 4096)).alias(
                "percent"
            ),
        ),
        """SELECT c_custkey,
                  CASE WHEN c_custkey % 10 = 0 THEN '£0' ELSE '£' || format('{:,.0f}', c_acctbal)
                       END AS pounds,
                  CASE WHEN c_custkey % 10 = 0 THEN '0%' WHEN c_acctbal / 4096 <= 1
                       THEN format('{:.1f}%', c_acctbal / 4096 * 100)
                       ELSE format('{:.1f}%', c_acctbal / 4096) END AS percent
           FROM customer""",
    )
    r.add(
        "x11_overview_text",
        lambda s, d: report.overview_text(
            gold(s, d).groupBy(*S.KEYS).agg(
                F.round(F.sum("spend"), 4).alias("spend"),
                F.round(F.sum("revenue"), 4).alias("revenue"),
            )
        ),
        """SELECT format('Spend changed by {:,.1f}% and revenue by {:,.1f}%. ', sc, rc)
                  || 'Focus budget on the top ROAS ad sets (' || top
                  || '); trim or test creatives for the bottom group.' AS summary
           FROM (SELECT (last(s ORDER BY date, ad_set_id) / first(s ORDER BY date, ad_set_id) - 1)
                            * 100 AS sc,
                        (last(r ORDER BY date, ad_set_id) / first(r ORDER BY date, ad_set_id) - 1)
                            * 100 AS rc
                 FROM (SELECT date, ad_set_id, sum(spend) AS s, sum(revenue) AS r
                       FROM gold GROUP BY ALL) WHERE s > 0 OR r > 0)
           CROSS JOIN (SELECT string_agg(ad_set_id, ', ' ORDER BY roas DESC, ad_set_id) AS top
                 FROM (SELECT * FROM per_ad ORDER BY roas DESC, ad_set_id LIMIT 5))""",
    )


def _plan_sql(projected: str, source: str, gain: str) -> str:
    return f"""
        SELECT ad_set_id, quartile, in_both, spend, spend_new, roas, revenue,
               {projected} AS revenue_proj
        FROM (
          SELECT *, CASE quartile WHEN 'bottom' THEN spend * 0.9
                      WHEN 'top' THEN spend + {gain} * 0.1 * spend / top_spend
                      ELSE spend END AS spend_new
          FROM (
            SELECT *, roas <= q1 AND roas >= q3 AS in_both,
                   unnest(list_filter([CASE WHEN roas <= q1 THEN 'bottom' END,
                       CASE WHEN roas > q1 AND roas < q3 THEN 'middle' END,
                       CASE WHEN roas >= q3 THEN 'top' END], lambda g: g IS NOT NULL)) AS quartile
            FROM (SELECT *, sum(spend) FILTER (roas >= q3) OVER () AS top_spend,
                         sum(spend) FILTER (roas <= q1) OVER () AS low_spend,
                         sum(spend) OVER () AS all_spend
                  FROM ({source}) CROSS JOIN (SELECT quantile_cont(roas, 0.25) AS q1,
                            quantile_cont(roas, 0.75) AS q3 FROM ({source})))))"""


def scenarios(r: Registry) -> None:
    source = "SELECT ad_set_id, spend, revenue, roas FROM per_ad"
    volume = f"{source} WHERE impressions >= 1000"
    power = "roas * spend_new ** 0.8::DOUBLE / spend ** (-0.2::DOUBLE)"
    linear = "roas * spend_new * 0.8::DOUBLE"
    digits = MONEY | {"spend_new": 4, "roas": 6, "revenue_proj": 4}
    summed = {"base_revenue": 3, "projected_revenue": 3, "spend_delta": 3, "uplift": 3,
              "uplift_low": 3, "uplift_high": 3}

    def linear_base(s: SparkSession, d: str) -> DataFrame:
        return report.roas_by_ad_set(gold(s, d), 1000)

    def summary(plan: str) -> str:
        return f"""
            SELECT *, projected_revenue - base_revenue AS uplift,
                   (projected_revenue - base_revenue) * 0.8 AS uplift_low,
                   (projected_revenue - base_revenue) * 1.2 AS uplift_high
            FROM (SELECT sum(revenue) FILTER (NOT (in_both AND quartile = 'top')) AS base_revenue,
                         sum(revenue_proj) AS projected_revenue,
                         sum(spend_new) - sum(spend) FILTER (NOT (in_both AND quartile = 'top'))
                             AS spend_delta FROM ({plan}))"""

    r.add(
        "u03_reallocation",
        lambda s, d: whatif.reallocation(per_ad(s, d)),
        _plan_sql(power, source, "all_spend"),
        digits,
    )
    r.add(
        "u03_reallocation_summary",
        lambda s, d: whatif.reallocation_summary(whatif.reallocation(per_ad(s, d))),
        summary(_plan_sql(power, source, "all_spend")),
        summed,
    )
    r.add(
        "u03_neutral_reallocation",
        lambda s, d: whatif.reallocation(per_ad(s, d), neutral=True),
        _plan_sql(power, source, "low_spend"),
        digits,
    )
    r.add(
        "u04_linear_reallocation",
        lambda s, d: whatif.reallocation(linear_base(s, d), curve="linear"),
        _plan_sql(linear, volume, "all_spend"),
        digits,
    )
    r.add(
        "u04_linear_summary",
        lambda s, d: whatif.reallocation_summary(
            whatif.reallocation(linear_base(s, d), curve="linear")
        ),
        summary(_plan_sql(linear, volume, "all_spend")),
        summed,
    )
    r.add(
        "u05_last_week_reallocation",
        lambda s, d: whatif.reallocation(
            report.roas_by_ad_set(report.last_days(gold(s, d), 7))
        ),
        f"""SELECT * FROM ({_plan_sql(power, "SELECT * FROM week_ads", "all_spend")})
            WHERE (SELECT count(*) FROM week_ads) >= 4""",
        digits,
    )
