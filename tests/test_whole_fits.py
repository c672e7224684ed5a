"""Fits over counted rows: all rows are seen, and counts stand for copies."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import training
from pacewise.operators import boosted, models, trees


def cells(n=300, seed=1, width=3):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, trees.BINS, (n, width)).astype(np.uint8)
    y = (bins[:, 0].astype(int) + bins[:, -1] > 30).astype(float)
    return bins, y, rng.integers(1, 5, n)


def walked(t, bins):
    out = np.full(len(bins), t.start)
    for feature, last, value in zip(t.feature, t.last, t.value):
        for i, row in enumerate(bins):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > last[node])
            out[i] += value[node - len(feature)]
    return out


def test_all_labelled_rows_are_fitted(spark):
    hashed = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    rows = spark.range(60_000).select(hashed.alias("a"), (hashed * 2).alias("t"), F.when(F.col("id") % 10 > 0, (hashed > 0.5).cast("int")).alias("y"))
    _, rate = boosted.fit_rate(rows, ["a"], "t", trees=1)
    _, risk = boosted.fit_risk(rows, ["a"], "y", trees=1)
    assert rate["rows_fitted"] == 60_000 and risk["rows_fitted"] == 54_000


def test_registered_runs_bound_no_rows(spark, monkeypatch):
    class Made:
        model_dir, most_rows, side_by_side = "unused", None, False

    seen = []
    for plan, steps in (
        (training.rolled_plan, ("train_risk", "train_rate")),
        (training.conformed_plan, ("train_bookings", "train_under_pacing")),
    ):
        for step in steps:
            monkeypatch.setattr(plan, step, lambda _, run: seen.append((run.side_by_side, run.most_rows)))
    for name in ("rolled_run", "conformed_run"):
        monkeypatch.setattr(training, name, lambda *_: Made())
    training.trained_rolled.__wrapped__(spark, "unused")
    training.trained_conformed.__wrapped__(spark, "unused")
    assert seen == [(True, None)] * 4


def test_counts_stand_for_copies(monkeypatch):
    monkeypatch.setattr(models, "ROW_SHARE", 1.0)
    bins, y, n = cells()
    weight = np.where(y == 1, 2.0, 1.0)
    for risk in (True, False):
        one = boosted.grow(bins, y, weight, 8, risk, 1, n)
        other = boosted.grow(bins.repeat(n, 0), y.repeat(n), weight.repeat(n), 8, risk, 1)
        assert np.allclose(one.raw(bins), other.raw(bins), atol=1e-9)
    x = bins[:, 0] / 7
    assert np.allclose(boosted.isotonic(x, y, n), boosted.isotonic(x.repeat(n), y.repeat(n)))
    assert boosted.area(y, x, n) == pytest.approx(boosted.area(y.repeat(n), x.repeat(n)))


def test_every_copy_is_drawn_by_itself():
    copies = np.array([1, 1000, 1])
    seen = boosted._drawn(np.random.default_rng(1), copies, np.array([1]), 3)
    assert 700 < seen[1] < 900 and set(seen[[0, 2]]) <= {0.0, 1.0}


@pytest.mark.parametrize("width", [1, 2, 3, 7])
def test_bits_find_the_leaves_that_walking_finds(width):
    bins, _, _ = cells(700, 2, width)
    t = boosted.grow(bins, bins.sum(axis=1) % 9.0, np.ones(len(bins)), 5, False, 1)
    assert np.allclose(t.raw(bins), walked(t, bins))
    again = trees.Trees.restored(t.facts())
    assert (again.raw(bins) == t.raw(bins)).all()


def test_cells_come_back_from_words_in_one_order():
    rng = np.random.default_rng(4)
    width, n = 14, 50
    bins = rng.integers(0, trees.BINS, (n, width))
    words = np.zeros((n, 2), np.int64)
    for j in range(width):
        words[:, j // 12] = words[:, j // 12] * trees.BINS + bins[:, j]
    y, slot = rng.integers(0, 2, n).astype(float), rng.integers(0, 15, n).astype(np.int32)
    facts = {"features": [f"f{j}" for j in range(width)], "medians": [], "edges": []}

    def part(rows):
        return [words[rows].tobytes(), y[rows].tobytes(), slot[rows].tobytes(), np.ones(len(rows), np.int64).tobytes()]

    one = boosted._cells(facts, [part(np.arange(n))])
    other = boosted._cells(facts, [part(np.arange(20, n)), part(np.arange(20))])
    assert (one.bins == other.bins).all() and (one.slot == other.slot).all() and (one.y == other.y).all()
    assert sorted(map(tuple, one.bins)) == sorted(map(tuple, bins.astype(np.uint8)))
    got, _, count = one.within(np.ones(n, bool))
    assert count.sum() == n and len(got) <= n


def test_folds_without_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, t double")
    _, info = boosted.fit_rate(df, ["a"], "t", trees=1)
    assert info["rows_fitted"] == 0 and np.isnan(info["cv_mae_mean"])
