from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pacewise.operators import evaluate, models, split
from pacewise.sources import schemas as S


@pytest.fixture(scope="module")
def days(spark):
    start = dt.date(2024, 1, 1)
    rows = [(f"A{i % 7}", start + dt.timedelta(days=i // 7), i) for i in range(70)]
    return spark.createDataFrame(rows, "ad_set_id string, date date, n int")


def test_row_split_cuts_inside_one_day(days):
    out = split.row_fraction_split(days, 0.25).cache()
    assert out.count() == 70
    assert out.filter("split = 'train'").count() == int(70 * 0.75)
    train_end = out.filter("split = 'train'").agg(F.max("date")).first()[0]
    test_start = out.filter("split = 'test'").agg(F.min("date")).first()[0]
    assert train_end == test_start  # 52 rows are seven and a half days


def test_row_split_on_a_day_boundary_and_at_the_ends(days):
    even = split.row_fraction_split(days, 0.5)
    assert even.filter("split = 'train'").agg(F.max("date")).first()[0] == dt.date(2024, 1, 5)
    assert split.row_fraction_split(days, 0.0).filter("split = 'test'").isEmpty()
    assert split.row_fraction_split(days, 1.0).filter("split = 'train'").isEmpty()
    assert split.row_fraction_split(days.limit(0)).isEmpty()


def test_row_split_puts_missing_dates_last(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", None), ("c", None)], "k string, date date")
    rows = {r["k"]: r["split"] for r in split.row_fraction_split(df, 0.5).collect()}
    assert rows == {"a": "train", "b": "test", "c": "test"}
    rows = split.row_fraction_split(df, 0.34).collect()
    assert sorted(r["split"] for r in rows if r["date"] is None) == ["test", "test"]


def test_date_split(days, spark):
    assert split.train_cutoff(days).first()[0] == dt.date(2024, 1, 8)
    out = split.date_fraction_split(days)
    windows = {r["split"]: r for r in split.window_dates(out).collect()}
    assert windows["valid"]["start"] == dt.date(2024, 1, 9) and windows["valid"]["row_count"] == 14
    single = days.filter("date = '2024-01-03'")
    assert split.train_cutoff(single).first()[0] == dt.date(2024, 1, 3)
    assert split.date_fraction_split(single).filter("split = 'valid'").isEmpty()


def test_folds_are_even_within_each_class(days):
    labelled = days.withColumn("y", (F.col("n") % 3 == 0).cast("int"))
    sizes = split.stratified_folds(labelled, "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_target_bins_match_numpy(days):
    import numpy as np

    values = [int(r["n"]) for r in days.collect()]
    want = np.clip(np.digitize(values, np.quantile(values, [0, 0.25, 0.5, 0.75, 1])), 1, 4)
    got = {r["n"]: r["bin"] for r in split.target_bins(days, "n").collect()}
    assert [got[v] for v in values] == list(want)


def _pairs(seed: int, n: int = 200):
    rng = random.Random(seed)
    return [(i, rng.randint(0, 1), round(rng.random(), 1)) for i in range(n)]


def test_auc_counts_pairs(spark):
    rows = _pairs(1)
    df = spark.createDataFrame(rows, "id int, y int, p double")
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df, "y", "p").first()["auc"] == pytest.approx(won)
    assert evaluate.roc_auc(df.filter("y = 1"), "y", "p").first()["auc"] is None


def test_roc_area_is_the_auc_with_and_without_thinning(spark):
    df = spark.createDataFrame(_pairs(2), "id int, y int, p double")
    auc = evaluate.roc_auc(df, "y", "p").first()["auc"]
    for thin in (True, False):
        points = evaluate.roc_points(df, "y", "p", thin).orderBy(F.desc("threshold")).collect()
        xy = [(r["fpr"], r["tpr"]) for r in points]
        assert xy[0] == (0.0, 0.0) and xy[-1] == (1.0, 1.0)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(xy, xy[1:]))
        assert area == pytest.approx(auc)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9, 2.0), (0, 0.6, 1.0), (1, 0.2, 4.0), (0, 0.1, 3.0)], "y int, p double, z double")
    row = evaluate.classification_metrics(df, "y", "p").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 1)
    assert row["accuracy"] == 0.5 and row["f1"] == 0.5
    assert evaluate.classification_metrics(df.limit(0), "y", "p").first()["f1"] == 0.0
    reg = evaluate.regression_metrics(df, "z", "z").first()
    assert reg["mae"] == 0.0 and reg["r2"] == 1.0
    constant = evaluate.regression_metrics(df.withColumn("c", F.lit(1.0)), "c", "z").first()
    assert constant["r2"] == 0.0


def test_label_noise_flips_the_exact_share(spark):
    df = spark.createDataFrame(_pairs(3), "id int, y int, p double")
    flipped = evaluate.flip_labels(df, "y", 0.13, ["id"], out="z")
    assert flipped.filter("y <> z").count() == int(200 * 0.13)
    row = evaluate.noise_robustness(df, "y", "p", 0.0, ["id"]).first()
    assert row["auc_base"] == row["auc_noisy"]


def test_feature_gate():
    assert "conv_7d" not in models.checked_features(S.NEXT_DAY_RISK_FEATURES)
    assert "conv_7d" in models.checked_features(S.NEXT_DAY_RISK_FEATURES, allow_leaky=True)
    with pytest.raises(ValueError):
        models.checked_features(["next_pacing_ratio"], allow_leaky=True)


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    rows = []
    for i in range(240):
        a, b = rng.random(), rng.random()
        gap = None if i % 11 == 0 else b
        rows.append((f"A{i % 6}", start + dt.timedelta(days=i // 6), a, gap, int(a > 0.6), 3 * a + rng.random() / 10))
    return spark.createDataFrame(rows, "ad_set_id string, date date, a double, b double, y int, z double")


def test_regressor_beats_the_mean_and_keeps_columns(learnable):
    model = models.fit_regressor(learnable, ["a", "b"], "z", trees=8)
    out = models.predict(model, learnable, ["a", "b"], "p")
    assert out.columns == [*learnable.columns, "p"] and out.count() == 240
    assert evaluate.regression_metrics(out, "z", "p").first()["r2"] > 0.3
    weights = {r[0]: r[1] for r in models.importances(model, ["a", "b"], learnable.sparkSession).collect()}
    assert weights["a"] > weights["b"]


def test_calibrated_risk_is_a_probability_and_separates(learnable):
    weight = models.positive_weight(learnable, "y")
    model = models.fit_calibrated(learnable, ["a", "b"], "y", trees=4, pos_weight=weight)
    out = model.transform(learnable, "risk").cache()
    assert out.count() == 240
    assert out.filter("risk < 0 OR risk > 1 OR risk IS NULL").isEmpty()
    assert evaluate.roc_auc(out, "y", "risk").first()["auc"] > 0.8


def test_cross_validation(learnable):
    risk = models.cross_validate_risk(learnable, ["a", "b"], "y", trees=2, k=2)
    assert risk["folds"] == 2 and 0.5 < risk["cv_auc_mean"] <= 1
    rate = models.cross_validate_regressor(learnable, ["a", "b"], "z", trees=3, k=2)
    assert rate["cv_mae_mean"] > 0 and rate["cv_r2_mean"] < 1


def test_trees_read_copies_of_a_row_once(learnable, monkeypatch):
    seen = []

    class Recorded(models.GBTRegressor):
        def fit(self, df, params=None):
            seen.append(df.agg(F.count("*"), F.sum("_weight")).first())
            return super().fit(df, params)

    monkeypatch.setattr(models, "GBTRegressor", Recorded)
    different = learnable.select("a", "b", "z").distinct().count()
    copies = learnable.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    models.fit_regressor(copies, ["a", "b"], "z", trees=2)
    assert tuple(seen[0]) == (different, 3.0 * learnable.count())
