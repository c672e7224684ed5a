"""Queries over whole training runs: reports, score tables, saved models, importances."""

from __future__ import annotations

from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.layers import train
from catalog.monitor import FOLDS, PLAN, _lagged
from catalog.outputs import _through_table, conformed_run, rolled_run
from catalog.registry import Registry
from pacewise.operators import backtest, boosted, importance, models, split
from pacewise.plans import conformed as conformed_plan
from pacewise.plans import rolled as rolled_plan
from pacewise.plans.rolled import RATE_TARGET
from pacewise.session import cut, ensure_checkpoint_dir
from pacewise.sources import schemas as S

LINEAR = "expanding"
FOLD = 2
PLANTED, CONSTANT = "planted", "constant"


def _model_dir(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/models-{uuid4().hex}"


@cache
def trained_conformed(spark: SparkSession, d: str) -> conformed_plan.Run:
    """The conformed plan to its end: both models fitted, tested and saved."""
    run = conformed_run(spark, d)
    run.model_dir = run.model_dir or _model_dir(spark)
    run.side_by_side = True
    conformed_plan.train_bookings(spark, run)
    conformed_plan.train_under_pacing(spark, run)
    return run


@cache
def trained_rolled(spark: SparkSession, d: str) -> rolled_plan.Run:
    """The rolled plan to its end: cross-validation, both models, both score tables."""
    run = rolled_run(spark, d)
    run.model_dir = run.model_dir or _model_dir(spark)
    run.side_by_side = True
    rolled_plan.train_risk(spark, run)
    rolled_plan.train_rate(spark, run)
    return run


def _conformed_report(spark: SparkSession, d: str) -> DataFrame:
    rows = []
    for name, report in trained_conformed(spark, d).reports.items():
        m = report["metrics"]
        better = m["r2"] > 0 if "r2" in m else m["auc"] > 0.5
        rows.append((name, len(report["features"]), report["rows"], better))
    return spark.createDataFrame(
        rows, "model string, features int, rows_tested bigint, better_on_holdout boolean"
    )


def _rolled_report(spark: SparkSession, d: str) -> DataFrame:
    """What cross-validation and holdout say: of risk by chance, of rates by their mean."""
    reports = trained_rolled(spark, d).reports
    risk, rate = reports["under_pacing_next"], reports["conversion_rate"]
    rows = [
        ("under_pacing_next", len(risk["importances"]), risk["folds"],
         risk["cv_auc_mean"] > 0.5 and risk["holdout_auc"] > 0.5, risk["pos_weight"],
         risk["train_end"], risk["valid_start"]),
        ("conversion_rate", len(rate["importances"]), models.CV_FOLDS,
         rate["cv_mae_mean"] > 0 and rate["holdout_mae"] > 0, 1.0,
         rate["train_end"], rate["valid_start"]),
    ]
    return spark.createDataFrame(
        rows,
        "model string, features int, cv_folds int, holds boolean, pos_weight double, "
        "train_end string, valid_start string",
    )


def _score_counts(spark: SparkSession, d: str, table: str, score: str) -> DataFrame:
    scored = spark.table(f"{trained_rolled(spark, d).gold}.{table}")
    known = F.col(score).isNotNull() & ~F.isnan(score)
    inside = F.col(score).between(0, 1) if score == "under_pacing_risk" else known
    return scored.groupBy(S.DATE).agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(known & inside).alias("in_range"),
        F.count_distinct(S.AD_SET).alias("ad_sets"),
    )


def _reloaded(spark: SparkSession, d: str) -> DataFrame:
    """Models loaded from disk score every row as the plan's tables have it."""
    run = trained_rolled(spark, d)
    table = cut(spark.table(f"{run.gold}.training_dataset"))
    out = []
    for kind, name, stored, score in (
        (boosted.BoostedModel, "under_pacing_next", "scored_adsets", "under_pacing_risk"),
        (boosted.BoostedModel, "conversion_rate", "scored_conversions", "conv_prob"),
    ):
        keys = [S.AD_SET, S.DATE]
        again = models.score_saved(spark, kind, f"{run.model_dir}/{name}", table, score, keys)
        was = spark.table(f"{run.gold}.{stored}")
        per_row = [*keys, F.round(score, 9).alias(score)]
        extra = again.select(per_row).exceptAll(was.select(per_row)).count()
        out.append((name, again.count(), extra))
    return spark.createDataFrame(out, "model string, rows_scored bigint, other_scores bigint")


def _linear_scores(spark: SparkSession, d: str) -> DataFrame:
    """The score table of the last fold's linear model, through a written table."""
    rows = _lagged(spark, d)
    scored = backtest.fold_predictions(rows, PLAN, backtest.fold_models(rows, PLAN))
    last = scored.where(F.col("fold") == FOLD)
    return _through_table(
        spark, models.score_keys(last.withColumn("score", F.col(f"{LINEAR}_prediction")), "score")
    )


@cache
def _planted(spark: SparkSession, d: str) -> tuple[DataFrame, list[str], boosted.BoostedModel]:
    """Holdout rows, features and a model of the rate, which one feature all but gives away."""
    rows = models.usable_rows(train(spark, d), RATE_TARGET).withColumns(
        {PLANTED: F.col(RATE_TARGET) * 3 + 1, CONSTANT: F.lit(7.0)}
    )
    features = [*models.checked_features(S.NEXT_DAY_RISK_FEATURES), PLANTED, CONSTANT]
    parts = split.date_fraction_split(cut(rows.select(S.DATE, RATE_TARGET, *features)))
    training = parts.where(F.col("split") == split.TRAIN)
    model, _ = boosted.fit_one(training, features, RATE_TARGET, risk=False)
    return parts.where(F.col("split") == split.VALID), features, model


def _importances(spark: SparkSession, d: str) -> DataFrame:
    holdout, features, model = _planted(spark, d)
    found = importance.permutation_importances(model.transform, holdout, features, RATE_TARGET)
    best = F.max_by("feature", "importance")
    constant = F.max(F.when(F.col("feature") == CONSTANT, F.col("importance")))
    return found.agg(
        best.alias("first"),
        constant.alias("constant_importance"),
        F.count(F.lit(1)).alias("features"),
    ).withColumn("rows_permuted", F.lit(holdout.count()))


def add_to(r: Registry) -> None:
    tested = "count(*) - floor(count(*) * 0.8::DOUBLE)::BIGINT"
    r.add(
        "p01_model_report",
        _conformed_report,
        f"""SELECT 'bookings' AS model, 12 AS features, {tested} AS rows_tested,
                   true AS better_on_holdout FROM gld_training
            UNION ALL SELECT 'under_pacing', 8, {tested}, true FROM gld_daily""",
    )
    cutoff = """list_sort(list(DISTINCT date))
                [greatest(1, floor(count(DISTINCT date) * 0.8::DOUBLE)::INT)]"""
    r.add(
        "p02_model_report",
        _rolled_report,
        f"""WITH risk AS (SELECT *, date <= (SELECT {cutoff} FROM train) AS early FROM train),
                 rate AS (SELECT * FROM train WHERE conv_next7d_rate IS NOT NULL),
                 rated AS (SELECT *, date <= (SELECT {cutoff} FROM rate) AS early FROM rate)
            SELECT 'under_pacing_next' AS model, 7 AS features, 5 AS cv_folds, true AS holds,
                   count(*) FILTER (early AND label_under_pacing_next = 0)::DOUBLE
                   / count(*) FILTER (early AND label_under_pacing_next = 1) AS pos_weight,
                   (max(date) FILTER (early))::VARCHAR AS train_end,
                   (min(date) FILTER (NOT early))::VARCHAR AS valid_start FROM risk
            UNION ALL
            SELECT 'conversion_rate', 6, 5, true, 1.0, (max(date) FILTER (early))::VARCHAR,
                   (min(date) FILTER (NOT early))::VARCHAR FROM rated""".replace(
            "WITH risk", "SELECT * FROM (WITH risk"
        )
        + ")",
        {"pos_weight": 6},
    )
    for name, table, score in (
        ("p02_scored_adsets", "scored_adsets", "under_pacing_risk"),
        ("p02_scored_conversions", "scored_conversions", "conv_prob"),
    ):
        r.add(
            name,
            lambda s, d, t=table, c=score: _score_counts(s, d, t, c),
            """SELECT date, count(*) AS rows_scored, count(*) AS in_range,
                      count(DISTINCT ad_set_id) AS ad_sets FROM train GROUP BY date""",
        )
    r.add(
        "s14_saved_models",
        _reloaded,
        """SELECT unnest(['under_pacing_next', 'conversion_rate']) AS model, n AS rows_scored,
                  0::BIGINT AS other_scores FROM (SELECT count(*) AS n FROM train)""",
    )
    r.add(
        "s12_model_scores",
        _linear_scores,
        f"""SELECT * FROM ({FOLDS}
            SELECT ad_set_id, date, prediction AS score FROM tested
            WHERE fold = {FOLD} AND kind = '{LINEAR}')""",
        {"score": 5},
    )
    r.add(
        "m14_permutation_importances",
        _importances,
        f"""SELECT 'planted' AS first, 0::DOUBLE AS constant_importance, 8::BIGINT AS features,
                   count(*) FILTER (date > cutoff)::INTEGER AS rows_permuted
            FROM train, (SELECT {cutoff} AS cutoff FROM train WHERE conv_next7d_rate IS NOT NULL)
            WHERE conv_next7d_rate IS NOT NULL""",
    )
