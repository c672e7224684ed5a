from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewise.operators import boosted, evaluate, models

FEATURES = ["a", "b", "c"]


def table(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    return x, (x[:, 0] + x[:, 1] ** 2 > 0.8).astype(float), 3 * x[:, 0] - x[:, 1]


def bins_of(x):
    edges = [np.quantile(x[:, j], np.arange(1, 32) / 32).tolist() for j in range(x.shape[1])]
    return boosted.binned(x, [0.5] * x.shape[1], edges)


@pytest.fixture(scope="module")
def rows(spark):
    x, y, t = table(900)
    rng = random.Random(3)
    made = [(i, *map(float, x[i]), int(y[i]) if i % 11 else None, float(t[i])) for i in range(len(x))]
    made = [(i, a if rng.random() > 0.05 else None, b, c if i % 13 else float("nan"), y, t) for i, a, b, c, y, t in made]
    return spark.createDataFrame(made, "id int, a double, b double, c double, y int, t double").cache()


def test_trees_learn_and_are_the_same_again():
    x, y, t = table(2000)
    other, y2, t2 = table(1000, 2)
    ones = np.ones(2000)
    risk = boosted.grow(bins_of(x), y, ones, 100, True, 1)
    assert boosted.area(y2, risk.raw(bins_of(other))) > 0.97
    rate = boosted.grow(bins_of(x), t, ones, 100, False, 1)
    assert np.abs(rate.raw(bins_of(other)) - t2).mean() < 0.12
    assert risk.gain[2] < 0.05 * risk.gain.sum()
    again = boosted.grow(bins_of(x), y, ones, 100, True, 1)
    assert (again.raw(bins_of(other)) == risk.raw(bins_of(other))).all()
    assert risk.feature.shape == (100, 15) and risk.value.shape == (100, 16)


def test_one_tree_splits_where_squares_say():
    bins = np.array([[0], [0], [1], [1], [2], [2]])
    y = np.array([0.0, 0, 0, 0, 10, 10])
    tree = boosted.grow(bins, y, np.ones(6), 60, False, 3)
    assert set(tree.last[:, 0].tolist()) <= {0, 1, boosted.BINS} and (tree.last[:, 0] == 1).mean() > 0.5
    assert tree.raw(bins)[4] > 6 and tree.raw(bins)[0] < 1
    flat = boosted.grow(bins * 0, y, np.ones(6), 5, False, 3)
    assert np.ptp(flat.raw(bins * 0)) == 0


def test_isotonic_and_area():
    x, y = np.array([1.0, 2, 3, 4, 4, 5]), np.array([0.0, 1, 0, 1, 0, 1])
    xs, ys = boosted.isotonic(x, y)
    assert np.interp(x, xs, ys).tolist() == [0.0, 0.5, 0.5, 0.5, 0.5, 1.0]
    assert boosted.area(np.array([0, 1, 1, 0]), np.array([0.1, 0.4, 0.4, 0.4])) == pytest.approx(0.75)
    assert boosted.area(np.ones(3), np.arange(3)) is None


def test_places_inside_folds():
    place = np.arange(23)
    for fold in range(5):
        rest = place[place % 5 != fold]
        assert boosted._inner_place(rest, fold, 5).tolist() == list(range(len(rest)))


def test_a_calibrated_model_and_its_cross_validation(spark, rows, tmp_path):
    model, info = boosted.fit_risk(rows, FEATURES, "y", trees=40, pos_weight=models.positive_weight(rows, "y"))
    assert info["folds"] == 5 and info["cv_auc_mean"] > 0.9 and info["rows_fitted"] == rows.where("y IS NOT NULL").count()
    assert sum(info["importances"].values()) == pytest.approx(1) and info["importances"]["c"] < 0.2
    scored = model.transform(rows, "s").cache()
    assert scored.columns == [*rows.columns, "s"] and scored.where("s IS NULL OR s < 0 OR s > 1").isEmpty()
    assert evaluate.roc_auc(scored, "y", "s").first().auc > 0.95
    model.write().save(str(tmp_path / "m"))
    again = boosted.BoostedModel.load(str(tmp_path / "m")).transform(scored, "s2")
    assert again.where("s <> s2").isEmpty()


def test_rates_and_a_bound_on_rows(rows):
    model, info = boosted.fit_rate(rows, FEATURES, "t", trees=40)
    assert info["cv_r2_mean"] > 0.8 and 0 < info["cv_mae_mean"] < 0.4
    error = model.transform(rows, "s").agg(F.avg(F.abs(F.col("s") - F.col("t")))).first()[0]
    assert error < 0.3
    _, fewer = boosted.fit_rate(rows, FEATURES, "t", trees=2, most_rows=300)
    assert 200 < fewer["rows_fitted"] < 400
    _, again = boosted.fit_rate(rows.repartition(5), FEATURES, "t", trees=2, most_rows=300)
    assert again == fewer


def test_one_class_and_features_without_numbers(spark):
    df = spark.createDataFrame([(float(i), None, 1) for i in range(30)], "a double, b double, y int")
    model, info = boosted.fit_risk(df, ["a", "b"], "y", trees=3)
    assert info["folds"] == 0 and np.isnan(info["cv_auc_mean"])
    assert model.transform(df, "s").where("s < 0.9").isEmpty()


def test_one_fit_and_its_importances(rows):
    model, gains = boosted.fit_one(rows, FEATURES, "y", True, trees=30)
    assert min(gains, key=gains.get) == "c" and gains["c"] < 0.2 and model.risk and not model.curves
    assert evaluate.roc_auc(model.transform(rows, "s"), "y", "s").first().auc > 0.95
