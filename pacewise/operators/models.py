"""Boosted-tree models with Spark ML: fit, cross-validate, calibrate, score, save and load."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from math import ceil
from statistics import fmean, pstdev
from typing import TypeVar

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.measures import finite
from pacewise.operators.evaluate import regression_metrics, roc_auc
from pacewise.operators.ranks import exact_quantiles_of
from pacewise.operators.split import stratified_folds, target_folds
from pacewise.operators.trees import binned
from pacewise.operators.trees import of_text as trees_of_text
from pacewise.session import cut, ensure_checkpoint_dir, kept, ship_package
from pacewise.sources import schemas as S

# The published tree settings.
TREES = 400
DEPTH = 4
STEP = 0.05
ROW_SHARE = 0.8
COLUMN_SHARE = "0.9"
CALIBRATION_FOLDS = 3
CV_FOLDS = 5
CHECKPOINT_EVERY = 10
#: Folds fitted at the same time; Spark runs their jobs side by side.
PARALLEL = 3
#: Rows that one task of a fit holds. A tree is several jobs over all rows, so a fit over
#: few rows should not be spread over many tasks.
ROWS_PER_TASK = 200_000

Out = TypeVar("Out")


def each_fold(fit: Callable[[int], Out], folds: int, parallel: int = PARALLEL) -> list[Out]:
    """`fit` of every fold, some at a time, in the order of the folds."""
    with ThreadPoolExecutor(max(1, min(parallel, folds))) as pool:
        return list(pool.map(fit, range(folds)))


def forward_looking(features: list[str]) -> list[str]:
    """Features that know the future of the row's own day."""
    return [f for f in features if f in S.FORWARD_LOOKING or f.startswith(S.FORWARD_PREFIX)]


def checked_features(features: list[str], allow_leaky: bool = False) -> list[str]:
    """`next_*` features are refused; other forward-looking ones are dropped unless allowed."""
    named = [f for f in features if f.startswith(S.FORWARD_PREFIX)]
    if named:
        raise ValueError(f"features look ahead: {named}")
    leaky = set(forward_looking(features))
    return [f for f in features if allow_leaky or f not in leaky]


def with_optional(features: list[str], df: DataFrame, optional: list[str]) -> list[str]:
    """Add the optional features the table has."""
    return features + [c for c in optional if c in df.columns and c not in features]


def usable_rows(df: DataFrame, target: str) -> DataFrame:
    """Infinite numbers to null, then only rows with a target."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite(c) for c in numeric}).dropna(subset=[target])


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def _prepared(rows: DataFrame, features: list[str]) -> list:
    """Median imputation, assembly and standardisation.

    The medians are exact, those of all features come from one ordering, and they stand in
    the stage's statement. A feature without any number is 0.
    """
    numbers = [f"{f}__number" for f in features]
    medians = {
        r.column_name: r.quantiles[0] if r.n else 0.0
        for r in exact_quantiles_of(rows, numbers, [0.5]).collect()
    }
    filled = ", ".join(
        f"coalesce(nanvl(`{c}`, NULL), {medians[c]!r}D) AS `{f}__filled`"
        for f, c in zip(features, numbers)
    )
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{f}__filled" for f in features], outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True),
    ]


def _typed(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({f"{f}__number": F.col(f).cast("double") for f in features})


def _counted_rows(rows: DataFrame) -> DataFrame:
    """Each different row once with its `_weight`, in as few parts as they need.

    `_weight` is how many rows are equal, times what they weigh. Which part a row is in,
    and where, depends on the row alone, so the random choices that a fit makes by part
    are the same in each run; copies of a row are drawn together.
    """
    names = [c for c in rows.columns if c != "_weight"]
    weight = F.sum("_weight") if "_weight" in rows.columns else F.count(F.lit(1)).cast("double")
    counted = kept(rows.groupBy(*names).agg(weight.alias("_weight")).select(*names, "_weight"))
    parts = max(1, ceil(counted.count() / ROWS_PER_TASK))
    place = F.xxhash64(*names)
    return cut(counted.repartition(parts, place).sortWithinPartitions(place, *names))


def _fitted(rows: DataFrame, features: list[str], trainer: Estimator) -> PipelineModel:
    """Preparation fitted on all rows, and trees on the different ones by their weight.

    A tree is several jobs over what it is fitted on; equal rows add the same to each of
    its sums, so they are counted once and not read in every job.
    """
    rows = kept(rows)
    prepared = Pipeline(stages=_prepared(rows, features)).fit(rows)
    trees = trainer.fit(prepared.transform(_counted_rows(rows)))
    return PipelineModel([*prepared.stages, trees])


def _tree_settings(trees: int) -> dict:
    return dict(
        featuresCol="scaled",
        maxIter=trees,
        maxDepth=DEPTH,
        stepSize=STEP,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE,
        seed=S.SEED,
        checkpointInterval=CHECKPOINT_EVERY,
    )


def fit_regressor(
    df: DataFrame,
    features: list[str],
    target: str,
    trees: int = TREES,
) -> PipelineModel:
    """Imputation, scaling and a boosted-tree regressor."""
    ensure_checkpoint_dir(df.sparkSession)
    trainer = GBTRegressor(labelCol="_label", weightCol="_weight", **_tree_settings(trees))
    rows = _typed(df, features).withColumn("_label", F.col(target).cast("double"))
    rows = rows.select(*(f"{f}__number" for f in features), "_label")
    return _fitted(rows, features, trainer)


def fit_classifier(
    df: DataFrame,
    features: list[str],
    label: str,
    trees: int = TREES,
    pos_weight: float = 1.0,
) -> PipelineModel:
    """Imputation, scaling and a boosted-tree classifier; positives weigh `pos_weight`."""
    ensure_checkpoint_dir(df.sparkSession)
    trainer = GBTClassifier(labelCol="_label", weightCol="_weight", **_tree_settings(trees))
    rows = _typed(df, features).withColumns(
        {
            "_label": F.col(label).cast("double"),
            "_weight": F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)),
        }
    )
    rows = rows.select(*(f"{f}__number" for f in features), "_label", "_weight")
    return _fitted(rows, features, trainer)


def positive_weight(df: DataFrame, label: str) -> float:
    """neg / pos of the training rows, 1.0 unless both classes occur."""
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    return row["neg"] / row["pos"] if row["pos"] and row["neg"] else 1.0


def _summed(model: PipelineModel, df: DataFrame, features: list[str], out: str, risk: bool) -> DataFrame:
    """Add the weighted sum of the trees as `out`, or the probability that follows from it.

    The stages before the trees run as they are. The trees are Spark's own; only their sum
    is taken in batches for all trees of a row at once, instead of one walk per tree.
    """
    grown = model.stages[-1]
    forest, edges = trees_of_text(grown.toDebugString, len(features), grown.getMaxDepth())
    width = len(features)
    # A scaled number that is NaN lies beyond all edges, as it does in Spark's trees.
    beyond = [float("nan")] * width
    ship_package(df.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            raw = forest.raw(binned(batch.to_numpy(float), beyond, edges))
            with np.errstate(over="ignore"):
                yield pd.Series(1 - 1 / (1 + np.exp(2 * raw)) if risk else raw)

    scaled = PipelineModel(model.stages[:-1]).transform(_typed(df, features))
    numbers = vector_to_array("scaled")
    columns = F.struct(*[numbers[i].alias(f"_{i}") for i in range(width)])
    return scaled.withColumn(out, score(columns)).select(*df.columns, out)


def predict(model: PipelineModel, df: DataFrame, features: list[str], out: str) -> DataFrame:
    """Add the regression prediction as `out`."""
    return _summed(model, df, features, out, risk=False)


def predict_risk(model: PipelineModel, df: DataFrame, features: list[str], out: str) -> DataFrame:
    """Add the probability of the positive class as `out`."""
    return _summed(model, df, features, out, risk=True)


class _EnsembleWriter(MLWriter):
    def __init__(self, model: MLWritable) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        for name, stage in self.model.stages().items():
            stage.write().save(f"{path}/{name}")
        text = json.dumps(self.model.facts())
        rows = self.sparkSession.createDataFrame([(text,)], "value string")
        # Written last: what can be read is whole.
        rows.coalesce(1).write.text(f"{path}/facts")


class _EnsembleReader(MLReader):
    def __init__(self, kind: type) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> object:
        facts = json.loads(self.sparkSession.read.text(f"{path}/facts").first()[0])
        if facts["kind"] != self.kind.__name__:
            raise ValueError(f"{path} holds a {facts['kind']}, not a {self.kind.__name__}")
        return self.kind.restored(path, facts)


class _Saved(MLWritable, MLReadable):
    """A model of several parts that is saved and loaded as one."""

    def write(self) -> MLWriter:
        return _EnsembleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EnsembleReader(cls)


@dataclass
class TreeModel(_Saved):
    """A fitted tree pipeline with the features that it reads; `info` is kept beside it.

    `risk` says whether the score is the probability of the positive class or a number.
    """

    features: list[str]
    model: PipelineModel
    risk: bool = False
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        return (predict_risk if self.risk else predict)(self.model, df, self.features, out)

    def stages(self) -> dict:
        return {"trees": self.model}

    def facts(self) -> dict:
        return {"kind": "TreeModel", "features": self.features, "risk": self.risk, "info": self.info}

    @classmethod
    def restored(cls, path: str, facts: dict) -> TreeModel:
        model = PipelineModel.load(f"{path}/trees")
        return cls(facts["features"], model, facts["risk"], facts["info"])


@dataclass
class CalibratedRisk(_Saved):
    """Classifiers fitted on all but one part each, with that part's isotonic curve."""

    features: list[str]
    parts: list[tuple[PipelineModel, IsotonicRegressionModel]]
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Add the mean calibrated probability, within [0, 1]."""
        kept = df.columns
        scores: list[Column] = []
        for i, (model, curve) in enumerate(self.parts):
            raw, mapped = f"_raw{i}", f"_mapped{i}"
            df = predict_risk(model, df, self.features, raw)
            curve = curve.copy().setFeaturesCol(raw).setPredictionCol(mapped)
            df = curve.transform(df)
            scores.append(F.col(mapped))
        mean = sum(scores[1:], scores[0]) / len(scores)
        bounded = F.least(F.greatest(mean, F.lit(0.0)), F.lit(1.0))
        return df.withColumn(out, bounded).select(*kept, out)

    def stages(self) -> dict:
        named = {f"trees{i}": model for i, (model, _) in enumerate(self.parts)}
        return named | {f"curve{i}": curve for i, (_, curve) in enumerate(self.parts)}

    def facts(self) -> dict:
        return {
            "kind": "CalibratedRisk", "features": self.features, "parts": len(self.parts),
            "info": self.info,
        }

    @classmethod
    def restored(cls, path: str, facts: dict) -> CalibratedRisk:
        parts = [
            (PipelineModel.load(f"{path}/trees{i}"), IsotonicRegressionModel.load(f"{path}/curve{i}"))
            for i in range(facts["parts"])
        ]
        return cls(facts["features"], parts, facts["info"])


def score_saved(
    spark: SparkSession, kind: type, path: str, df: DataFrame, out: str, keys: list[str]
) -> DataFrame:
    """The score table of a saved model: `keys` and its score for every row of `df`."""
    return kind.load(path).transform(df, out).select(*keys, out)


def fit_calibrated(
    df: DataFrame,
    features: list[str],
    label: str,
    trees: int = TREES,
    pos_weight: float = 1.0,
    folds: int = CALIBRATION_FOLDS,
    keys: list[str] | None = None,
    parallel: int = PARALLEL,
) -> CalibratedRisk:
    """Isotonic calibration over stratified parts.

    The isotonic fit sees one weighted point per distinct score, which gives the
    same curve as the single rows and keeps its input small.
    """
    placed = cut(stratified_folds(df, label, folds, keys))

    def fit(fold: int) -> tuple[PipelineModel, IsotonicRegressionModel]:
        model = fit_classifier(
            placed.filter(F.col("fold") != fold), features, label, trees, pos_weight
        )
        held = predict_risk(model, placed.filter(F.col("fold") == fold), features, "_raw")
        points = held.groupBy("_raw").agg(
            F.avg(F.col(label).cast("double")).alias("_rate"),
            F.count(F.lit(1)).cast("double").alias("_rows"),
        )
        curve = IsotonicRegression(
            featuresCol="_raw", labelCol="_rate", weightCol="_rows", predictionCol="_mapped"
        ).fit(points)
        return model, curve

    return CalibratedRisk(features, each_fold(fit, folds, parallel))


def cross_validate_risk(
    df: DataFrame,
    features: list[str],
    label: str,
    trees: int = TREES,
    pos_weight: float = 1.0,
    k: int = CV_FOLDS,
    keys: list[str] | None = None,
    parallel: int = PARALLEL,
) -> dict[str, float]:
    """Mean and std of the AUC over stratified folds; one-class folds are skipped."""
    placed = cut(stratified_folds(df, label, k, keys))

    def auc_of(fold: int) -> float | None:
        model = fit_calibrated(
            placed.filter(F.col("fold") != fold).drop("fold"),
            features,
            label,
            trees,
            pos_weight,
            keys=keys,
            parallel=1,
        )
        held = placed.filter(F.col("fold") == fold)
        return roc_auc(model.transform(held, "_score"), label, "_score").first()["auc"]

    aucs = [auc for auc in each_fold(auc_of, k, parallel) if auc is not None]
    if not aucs:
        return {"cv_auc_mean": float("nan"), "cv_auc_std": float("nan"), "folds": 0}
    return {"cv_auc_mean": fmean(aucs), "cv_auc_std": pstdev(aucs), "folds": len(aucs)}


def cross_validate_regressor(
    df: DataFrame,
    features: list[str],
    target: str,
    trees: int = TREES,
    k: int = CV_FOLDS,
    keys: list[str] | None = None,
    parallel: int = PARALLEL,
) -> dict[str, float]:
    """Mean and std of R² and MAE over folds stratified on the binned target."""
    placed = cut(target_folds(df, target, k, keys))

    def errors(fold: int) -> tuple[float | None, float | None]:
        model = fit_regressor(placed.filter(F.col("fold") != fold), features, target, trees)
        held = predict(model, placed.filter(F.col("fold") == fold), features, "_predicted")
        row = regression_metrics(held, target, "_predicted").first()
        return row["mae"], row["r2"]

    found = [e for e in each_fold(errors, k, parallel) if e[0] is not None]
    maes, r2s = [mae for mae, _ in found], [r2 for _, r2 in found]
    if not maes:
        nothing = float("nan")
        return dict.fromkeys(["cv_r2_mean", "cv_r2_std", "cv_mae_mean", "cv_mae_std"], nothing)
    return {
        "cv_r2_mean": fmean(r2s),
        "cv_r2_std": pstdev(r2s),
        "cv_mae_mean": fmean(maes),
        "cv_mae_std": pstdev(maes),
    }


def importances(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """(feature, importance), one row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def score_keys(scored: DataFrame, score: str) -> DataFrame:
    """The published score table: key and score."""
    return scored.select(S.AD_SET, S.DATE, score)
