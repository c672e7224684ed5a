"""Raw files to deduplicated silver, joined gold, quality report and two models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.measures import day, flag
from pacewise.operators import boosted, clean, evaluate, models, quality
from pacewise.operators.conformed import daily_metrics, daily_metrics_by_key, training_set
from pacewise.operators.split import TEST, TRAIN, row_fraction_split
from pacewise.session import cut
from pacewise.sources import schemas as S
from pacewise.sources.readers import read_strict, rejects
from pacewise.sources.tables import (
    append_audit,
    ensure_layers,
    export_json,
    require_rows,
    write_table,
)

SILVER_PERFORMANCE = "slv_meta_campaign_performance"
SILVER_BUDGET = "slv_budget_pacing"
SILVER_CONVERSIONS = "slv_conversion_events"
DAILY = "gld_daily_metrics"
TRAINING = "gld_training_set"
QUALITY = "data_quality_report"
AUDIT = "row_audit"


@dataclass
class Run:
    """Where the raw files are, how the layers are called, and how far to train.

    Gold is partitioned by date, for dashboards ask for date ranges. With `by_key` it
    has one row per (date, ad set) and counts nothing twice. With `side_by_side`, models are
    grown by tasks over counted rows (see `boosted`); without, by Spark ML. Both see all
    training rows; only `most_rows` bounds them, to about as many, and it means
    `side_by_side`.
    """

    paths: dict[str, str]
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    trees: int = models.TREES
    by_key: bool = False
    side_by_side: bool = False
    most_rows: int | None = None
    model_dir: str | None = None
    counts: dict[str, int] = field(default_factory=dict)
    reports: dict[str, dict] = field(default_factory=dict)

    def write(self, df: DataFrame, layer: str, name: str, **layout) -> None:
        self.counts[f"{layer}.{name}"] = write_table(df, f"{layer}.{name}", **layout)


def load_bronze(spark: SparkSession, run: Run) -> None:
    """The four raw files as tables; dates are parsed where there are any.

    Text that is no day-first date becomes null, and silver drops the row. Such rows are
    kept as they came, with the reason, in a table of rejects.
    """
    for table in S.RAW_TYPES:
        raw = read_strict(spark, run.paths[table], table)
        if S.DATE not in raw.columns:
            run.write(raw, run.bronze, table)
            continue
        run.write(raw.withColumn(S.DATE, day(S.DATE)), run.bronze, table)
        run.write(rejects(raw), run.bronze, f"{table}_rejects")


def build_silver(spark: SparkSession, run: Run) -> None:
    for source, target, cleaner in [
        (S.PERFORMANCE, SILVER_PERFORMANCE, clean.clean_performance),
        (S.BUDGET, SILVER_BUDGET, clean.clean_budget),
        (S.CONVERSIONS, SILVER_CONVERSIONS, clean.clean_conversions),
    ]:
        run.write(spark.table(f"{run.bronze}.{source}").transform(cleaner), run.silver, target)


def build_gold(spark: SparkSession, run: Run) -> None:
    join = daily_metrics_by_key if run.by_key else daily_metrics
    daily = join(
        spark.table(f"{run.silver}.{SILVER_PERFORMANCE}"),
        spark.table(f"{run.silver}.{SILVER_BUDGET}"),
        spark.table(f"{run.silver}.{SILVER_CONVERSIONS}"),
    )
    by_day = {"sort_by": S.KEYS, "partition_by": [S.DATE]}
    run.write(daily, run.gold, DAILY, **by_day)
    run.write(training_set(spark.table(f"{run.gold}.{DAILY}")), run.gold, TRAINING, **by_day)


def build_quality(spark: SparkSession, run: Run) -> None:
    run.write(quality.profile(spark.table(f"{run.gold}.{DAILY}")), run.gold, QUALITY)


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    split = cut(row_fraction_split(df))
    return split.filter(F.col("split") == TRAIN), split.filter(F.col("split") == TEST)


def _fit(
    spark: SparkSession, run: Run, train: DataFrame, features: list[str], label: str, risk: bool
) -> tuple[models.TreeModel | boosted.BoostedModel, dict[str, float]]:
    """The model and its importances."""
    if run.side_by_side or run.most_rows:
        return boosted.fit_one(train, features, label, risk, run.trees, most_rows=run.most_rows)
    fit = models.fit_classifier if risk else models.fit_regressor
    fitted = fit(train, features, label, run.trees)
    ranked = models.importances(fitted, features, spark).collect()
    weights = {r["feature"]: r["importance"] for r in ranked}
    return models.TreeModel(features, fitted, risk), weights


def _report(spark: SparkSession, run: Run, name: str, fitted: tuple, row) -> dict:
    """Metrics, features and importances; kept as JSON next to the saved model."""
    model, weights = fitted
    features = model.features
    metrics = row.asDict()
    rows = metrics.pop("rows")
    meta = {"metrics": metrics, "features": features, "importances": weights}
    run.reports[name] = meta | {"rows": rows}
    if run.model_dir:
        model.info = {"metrics": meta["metrics"]}
        model.write().overwrite().save(f"{run.model_dir}/{name}")
        metrics = [(k, float(v)) for k, v in meta["metrics"].items() if v is not None]
        report = spark.createDataFrame(
            [(name, features, weights, dict(metrics))],
            "model string, features array<string>, importances map<string,double>, "
            "metrics map<string,double>",
        )
        export_json(report, f"{run.model_dir}/{name}_report")
    return meta


def train_bookings(spark: SparkSession, run: Run) -> dict:
    """Daily bookings from the gold training set, tested on the last fifth of the rows."""
    df = require_rows(spark.table(f"{run.gold}.{TRAINING}"), "training set")
    train, test = _parts(df)
    fitted = _fit(spark, run, train, S.BOOKINGS_FEATURES, "target_bookings", False)
    scored = cut(fitted[0].transform(test, "predicted").select("target_bookings", "predicted"))
    row = (
        evaluate.regression_metrics(scored, "target_bookings", "predicted")
        .withColumn("rows", F.lit(scored.count()))
        .first()
    )
    return _report(spark, run, "bookings", fitted, row)


def train_under_pacing(spark: SparkSession, run: Run) -> dict:
    """Under-pacing from features that do not hold the budget itself."""
    df = require_rows(spark.table(f"{run.gold}.{DAILY}"), "daily metrics")
    label = flag(F.col("pacing_status") == S.PACING_STATUSES[0])
    train, test = _parts(df.withColumn("label_under_pacing", label))
    fitted = _fit(spark, run, train, S.UNDER_PACING_FEATURES, "label_under_pacing", True)
    scored = cut(fitted[0].transform(test, "risk").select("label_under_pacing", "risk"))
    row = (
        evaluate.classification_metrics(scored, "label_under_pacing", "risk")
        .select("accuracy", "f1")
        .withColumn("auc", evaluate.roc_auc(scored, "label_under_pacing", "risk").scalar())
        .withColumn("rows", F.lit(scored.count()))
        .first()
    )
    return _report(spark, run, "under_pacing", fitted, row)


def run_all(spark: SparkSession, run: Run) -> dict:
    ensure_layers(spark, [run.bronze, run.silver, run.gold])
    load_bronze(spark, run)
    build_silver(spark, run)
    build_gold(spark, run)
    build_quality(spark, run)
    append_audit(spark, run.counts, f"{run.gold}.{AUDIT}")
    return {
        "bookings": train_bookings(spark, run),
        "under_pacing": train_under_pacing(spark, run),
    }
