from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pacewise.operators import importance, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    made = []
    for i in range(400):
        a, b = rng.random(), rng.random() if i % 9 else None
        made.append((i, a, b, 2.0, int(a > 0.5) if i % 10 else None, 3 * a + (b or 0.0)))
    return spark.createDataFrame(made, "id int, a double, b double, c double, y int, t double").cache()


def test_medians_are_exact(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 10, 1000, 7)] + [(None,), (float("nan"),)], "x double")
    df = df.withColumn("none", F.lit(None).cast("double"))
    typed = models._typed(df, ["x", "none"])
    filled = models._prepared(typed, ["x", "none"])[0].transform(typed)
    got = [r.x__filled for r in filled.where("x IS NULL OR isnan(x)").collect()]
    assert got == [5.0, 5.0] and {r.none__filled for r in filled.collect()} == {0.0}


def test_a_fit_is_the_same_however_its_rows_lie(rows):
    fits = [models.fit_regressor(df, FEATURES, "t", trees=3) for df in (rows, rows.repartition(5), rows.orderBy("t"))]
    scores = [sorted((r.id, r.s) for r in models.predict(m, rows, FEATURES, "s").collect()) for m in fits]
    assert scores[0] == scores[1] == scores[2]


def test_an_ensemble_is_saved_and_loaded_as_one(spark, rows, tmp_path):
    known = rows.dropna(subset=["y"])
    model = models.fit_calibrated(known, FEATURES, "y", trees=3)
    model.info = {"auc": "0.9"}
    path = str(tmp_path / "risk")
    model.write().overwrite().save(path)
    again = models.CalibratedRisk.load(path)
    assert again is not model and again.features == FEATURES and again.info == {"auc": "0.9"}
    assert len(again.parts) == models.CALIBRATION_FOLDS
    both = again.transform(model.transform(rows, "s1"), "s2")
    assert both.where(~F.col("s1").eqNullSafe(F.col("s2"))).isEmpty() and both.count() == 400
    scored = models.score_saved(spark, models.CalibratedRisk, path, rows, "s1", ["id"])
    assert scored.columns == ["id", "s1"] and scored.count() == 400
    with pytest.raises(Exception, match="exists"):
        model.write().save(path)
    model.write().overwrite().save(path)


def test_single_models_keep_their_features_and_kind(spark, rows, tmp_path):
    known = rows.dropna(subset=["y"])
    for name, model in (
        ("t", models.TreeModel(FEATURES, models.fit_regressor(rows, FEATURES, "t", trees=2))),
        ("y", models.TreeModel(FEATURES, models.fit_classifier(known, FEATURES, "y", trees=2), risk=True)),
    ):
        model.write().save(str(tmp_path / name))
        again = models.TreeModel.load(str(tmp_path / name))
        got = again.transform(model.transform(rows, "s1"), "s2")
        assert again.risk == model.risk and got.where("s1 <> s2 OR s2 IS NULL").isEmpty()
    with pytest.raises(ValueError, match="TreeModel"):
        models.CalibratedRisk.load(str(tmp_path / "t"))


def test_permuting_is_a_permutation_of_one_feature_at_a_time(rows):
    got = importance.permuted(rows, FEATURES, ["id", "t"]).collect()
    was = {r.id: r for r in rows.collect()}
    assert len(got) == 4 * 400
    for feature in (None, *FEATURES):
        part = [r for r in got if r.permuted == feature]
        assert sorted(r.id for r in part) == sorted(was)
        for f in FEATURES:
            same = sum(r[f] == was[r.id][f] for r in part)
            assert same == 400 if f != feature or f == "c" else same < 100
            assert sorted(str(r[f]) for r in part) == sorted(str(r[f]) for r in was.values())
    again = importance.permuted(rows.repartition(3), FEATURES, ["id", "t"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_planted_feature_ranks_first_and_a_constant_has_none(rows):
    model = models.TreeModel(FEATURES, models.fit_regressor(rows, FEATURES, "t", trees=20))
    got = {r.feature: r for r in importance.permutation_importances(model.transform, rows, FEATURES, "t").collect()}
    assert max(got, key=lambda f: got[f].importance) == "a" and got["c"].importance == 0.0
    assert got["a"].importance > got["b"].importance > 0
    assert got["a"].permuted_error == pytest.approx(got["a"].base_error + got["a"].importance)
    risk = models.TreeModel(FEATURES, models.fit_classifier(rows.dropna(subset=["y"]), FEATURES, "y", trees=5), risk=True)
    by_risk = importance.permutation_importances(risk.transform, rows, FEATURES, "y").collect()
    assert max(by_risk, key=lambda r: r.importance).feature == "a"
    assert importance.permutation_importances(model.transform, rows.limit(0), FEATURES, "t").collect() == []
