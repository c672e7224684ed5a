"""Both end-to-end plans, on the small sample and on a regular one with known totals."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacewise.operators import quality, report, rolled as rolled_ops, split, whatif
from pacewise.plans import conformed, rolled
from pacewise.sources import schemas as S
from pacewise.sources.tables import table_exists
from samples import regular, write

def test_conformed_plan_on_the_small_sample(spark, tmp_path):
    run = conformed.Run(write(tmp_path), "c_bronze", "c_silver", "c_gold", trees=2, model_dir=str(tmp_path / "m"))
    for _ in range(2):  # a second run replaces the tables
        result = conformed.run_all(spark, run)
    assert run.counts["c_bronze.budget_pacing"] == 8
    assert run.counts["c_gold.gld_daily_metrics"] == 13 == run.counts["c_gold.gld_training_set"]
    assert spark.table("c_gold.data_quality_report").count() == 18
    assert spark.table("c_gold.row_audit").count() == len(run.counts)
    assert set(result["under_pacing"]["metrics"]) == {"accuracy", "f1", "auc"}
    saved = spark.read.json(str(tmp_path / "m" / "bookings_report")).first()
    assert saved["model"] == "bookings"


def test_rows_with_unparsed_dates_are_kept_apart(spark, tmp_path):
    paths = write(tmp_path)
    with open(paths[S.BUDGET], "a", encoding="utf-8") as f:
        f.write("2024-08-09,A1,1,1,1.0,on_pace\n31/02/2024,A1,1,1,1.0,on_pace\n")
    run = conformed.Run(paths, bronze="u_bronze")
    spark.sql("CREATE SCHEMA IF NOT EXISTS u_bronze")
    conformed.load_bronze(spark, run)
    assert run.counts["u_bronze.budget_pacing"] == 10
    assert run.counts["u_bronze.budget_pacing_rejects"] == 2
    assert run.counts["u_bronze.conversion_events_rejects"] == 0
    lost = spark.table("u_bronze.budget_pacing_rejects").select("date", "reason").collect()
    assert sorted(r["date"] for r in lost) == ["2024-08-09", "31/02/2024"]
    assert {r["reason"] for r in lost} == {"date is no d/M/yyyy date"}


def test_conformed_plan_needs_rows(spark, tmp_path):
    run = conformed.Run({}, gold="empty_gold", trees=1)
    spark.sql("CREATE SCHEMA IF NOT EXISTS empty_gold")
    spark.createDataFrame([], "date date, ad_set_id string").write.mode("overwrite").saveAsTable("empty_gold.gld_training_set")
    with pytest.raises(RuntimeError, match="empty"):
        conformed.train_bookings(spark, run)


def _check_rolled(spark, gold: str, silver: str) -> None:
    assert table_exists(spark, f"{gold}.scored_adsets")
    rows = spark.table(f"{gold}.training_dataset")
    assert rows.count() == spark.table(f"{silver}.{S.PERFORMANCE}").count()
    assert rows.filter("spend > 0 AND abs(revenue / spend - roas) > 1e-6").isEmpty()
    risk = spark.table(f"{gold}.scored_adsets")
    assert risk.count() == rows.count()
    assert risk.filter("NOT coalesce(under_pacing_risk BETWEEN 0 AND 1, false)").isEmpty()
    daily = spark.table(f"{silver}.silver_daily")
    assert quality.key_duplicates(daily, rolled_ops.BY_AD_SET).isEmpty()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_conformed_plan_on_the_regular_sample(spark, tmp_path):
    run = conformed.Run(regular(tmp_path), "pc_bronze", "pc_silver", "pc_gold", trees=3)
    result = conformed.run_all(spark, run)
    counts = run.counts
    assert counts["pc_silver.slv_meta_campaign_performance"] == 120
    assert counts["pc_silver.slv_budget_pacing"] == counts["pc_silver.slv_conversion_events"] == 120
    assert counts["pc_gold.gld_daily_metrics"] == 120
    gold = spark.table("pc_gold.gld_daily_metrics")
    assert quality.key_count(gold, S.KEYS).first()["key_count"] == 120
    # 10 a day and step of 1 to 6, for 20 days; three times that comes in.
    kpis = report.kpi_totals(gold).first()
    assert kpis["spend_total"] == pytest.approx(4200) and kpis["revenue_total"] == pytest.approx(12600)
    assert kpis["bookings_total"] == 120 and kpis["roas_overall"] == pytest.approx(3)
    mix = report.pacing_totals(gold, S.PACING_STATUSES).first()
    assert (mix["under_pacing"], mix["on_pace"], mix["over_pacing"]) == (60, 60, 0)
    dq = {r["column_name"]: r for r in spark.table("pc_gold.data_quality_report").collect()}
    assert dq["spend"]["mean"] == pytest.approx(35) and dq["impressions"]["max"] == 6000
    assert dq["ctr"]["mean"] == pytest.approx(1) and dq["roas"]["null_fraction"] == 0
    parts = split.row_fraction_split(gold).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == {"train": 96, "test": 24}
    # Every day has one booking, and any model says so.
    assert result["bookings"]["metrics"]["mae"] == pytest.approx(0, abs=1e-6)
    summary = whatif.reallocation_summary(whatif.reallocation(report.roas_by_ad_set(gold))).first()
    assert summary["base_revenue"] == pytest.approx(12600)


def test_a_plan_can_have_gold_by_key(spark, tmp_path):
    run = conformed.Run(write(tmp_path), "k_bronze", "k_silver", "k_gold", by_key=True)
    from pacewise.sources.tables import ensure_layers

    ensure_layers(spark, ["k_bronze", "k_silver", "k_gold"])
    conformed.load_bronze(spark, run)
    conformed.build_silver(spark, run)
    conformed.build_gold(spark, run)
    quality.require_unique(spark.table("k_gold.gld_daily_metrics"), S.KEYS, "daily")
    assert run.counts["k_gold.gld_daily_metrics"] == 12


def test_rolled_plan_on_the_regular_sample(spark, tmp_path):
    run = rolled.Run(
        regular(tmp_path), "pr_bronze", "pr_silver", "pr_gold", trees=2, cv_folds=2,
        allow_leaky=True, model_dir=str(tmp_path / "m"),
    )
    info = rolled.run_all(spark, run)
    _check_rolled(spark, "pr_gold", "pr_silver")
    dq = {r["column_name"]: r for r in spark.table("pr_silver.dq_summary").collect()}
    assert dq["pacing_ratio"]["mean"] == pytest.approx(0.925)
    # Days 1 to 13 see eight days of one conversion each, the last seven see 7 to 1.
    conv = spark.table("pr_gold.adset_conversions_7d")
    assert tuple(conv.agg(F.sum("conv_7d"), F.min("conv_7d"), F.max("conv_7d")).first()) == (792, 1, 8)
    bands = report.pacing_totals(spark.table("pr_gold.adset_pacing")).first()
    assert (bands["under"], bands["on"], bands["over"]) == (60, 60, 0)
    train = spark.table("pr_gold.training_dataset")
    # Nine even days are followed by an odd one, which is under.
    assert report.class_balance(train, "label_under_pacing_next").first()["pos"] == 54
    parts = split.date_fraction_split(train)
    assert {r["split"]: r["row_count"] for r in split.window_dates(parts).collect()} == {"train": 96, "valid": 24}
    assert info["risk"]["train_end"] == "2024-08-16" and info["risk"]["holdout_auc"] > 0.6
    assert set(info["rate"]) >= {"cv_r2_mean", "cv_mae_mean", "holdout_mae", "holdout_r2"}
    averages = report.daily_with_average(train).collect()
    assert {round(r["spend_ma7"], 6) for r in averages} == {210.0}
    assert spark.table("pr_gold.scored_conversions").count() == 120
    assert spark.read.json(str(tmp_path / "m" / "conversion_rate_report")).first()["model"] == "conversion_rate"


def test_rolled_plan_on_the_small_sample(spark, tmp_path):
    paths = write(tmp_path)
    run = rolled.Run(paths, "r_bronze", "r_silver", "r_gold", trees=1, cv_folds=2)
    from pacewise.sources.tables import ensure_layers

    ensure_layers(spark, ["r_bronze", "r_silver", "r_gold"])
    rolled.load_bronze(spark, run)
    rolled.build_silver(spark, run)
    rolled.build_gold(spark, run)
    assert run.counts["r_gold.training_dataset"] == run.counts[f"r_silver.{S.PERFORMANCE}"] == 7
    assert spark.table("r_gold.adset_pacing").count() == 8
    # bucketed sides join without an exchange; a date range reads only its partitions
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = rolled_ops.silver_daily(
            spark.table(f"r_silver.{S.PERFORMANCE}"), spark.table("r_silver.revenue_by_day")
        )
        assert "SortMergeJoin" in _plan(daily) and "Exchange" not in _plan(daily)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    day = dt.date(2024, 8, 2)
    chosen = report.select_rows(spark.table("r_gold.training_dataset"), ["A1"], day, day)
    assert "PartitionFilters: [isnotnull(date" in _plan(chosen)
    assert "PushedFilters: [IsNotNull(ad_set_id), EqualTo(ad_set_id,A1)]" in _plan(chosen)
