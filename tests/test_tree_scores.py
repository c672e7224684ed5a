"""Trees that Spark has grown score as Spark scores them, for all trees of a row at once."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pacewise.operators import models, trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    made = []
    for i in range(600):
        a, b = rng.random(), rng.random() if i % 9 else None
        made.append((i, a, b, float("nan") if i % 7 == 0 else 2.0 * (i % 5), int(a + (b or 0) > 0.8), 3 * a + (b or 0.0)))
    made += [(600, float("inf"), None, float("-inf"), 1, 1.0), (600, float("inf"), None, float("-inf"), 1, 1.0)]
    return spark.createDataFrame(made, "id int, a double, b double, c double, y int, t double").cache()


def spark_scores(model, df, risk):
    """What Spark ML itself says."""
    said = model.transform(models._typed(df, FEATURES))
    return said.select("id", (vector_to_array("probability")[1] if risk else F.col("prediction")).alias("s"))


@pytest.mark.parametrize("risk", [True, False])
def test_scores_are_those_of_spark(rows, risk):
    known = rows.where("id < 600")
    fit, predict = (models.fit_classifier, models.predict_risk) if risk else (models.fit_regressor, models.predict)
    model = fit(known, FEATURES, "y" if risk else "t", trees=25)
    got = predict(model, rows, FEATURES, "s")
    assert got.columns == [*rows.columns, "s"]
    mine, theirs = (sorted((r.id, r.s) for r in x.select("id", "s").collect()) for x in (got, spark_scores(model, rows, risk)))
    assert len(mine) == 602 and [i for i, _ in mine] == [i for i, _ in theirs]
    assert np.allclose([s for _, s in mine], [s for _, s in theirs], rtol=0, atol=1e-12)


def test_spark_walks_no_trees_for_scores(rows, monkeypatch):
    """A walk of its own for each tree and row took most of the time of large tables."""
    model = models.fit_classifier(rows.where("id < 600"), FEATURES, "y", trees=2)
    walks = []
    was = PipelineModel.transform
    monkeypatch.setattr(PipelineModel, "transform", lambda self, df: walks.append(len(self.stages)) or was(self, df))
    models.predict_risk(model, rows, FEATURES, "s").count()
    assert walks == [len(model.stages) - 1]


def test_text_of_trees():
    text = """Model: numTrees=2
  Tree 0 (weight 1.0):
    If (feature 1 <= -1.5E-4)
     Predict: 2.0
    Else (feature 1 > -1.5E-4)
     If (feature 0 <= 3.0)
      Predict: 4.0
     Else (feature 0 > 3.0)
      Predict: 8.0
  Tree 1 (weight 0.5):
    Predict: 1.0
"""
    t, edges = trees.of_text(text, 3, 4)
    assert edges == [[3.0], [-1.5e-4], []]
    x = np.array([[9.0, -1.5e-4, 0], [3.0, 0.0, 0], [3.1, 0.0, 0], [np.inf, np.inf, 0], [-np.inf, -np.inf, 0]])
    assert t.raw(trees.binned(x, [0.0] * 3, edges)).tolist() == [2.5, 4.5, 8.5, 8.5, 2.5]
    with pytest.raises(ValueError, match="not a line"):
        trees.of_text("Model\n  Tree 0 (weight 1.0):\n    If (feature 0 in {1.0})\n", 1, 4)
