from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from pacewise.llm import boosting, quality
from tests.llm.conftest import sentence


def test_trees_separate_what_one_split_cannot():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_flat_arrays_score_like_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    model = boosting.fit(x, (x[:, 0] + rng.normal(size=600) > 0).astype(float), trees=8, depth=3)
    for row, got in zip(x[:50], model.scores(x[:50])):
        margin = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert got == pytest.approx(1 / (1 + np.exp(-margin)))


@pytest.mark.parametrize("y", [[], [1, 1], [0]])
def test_without_two_labels_the_score_is_constant(y):
    model = boosting.fit(np.zeros((len(y), 3)), np.array(y, float))
    assert len(set(model.scores(np.ones((4, 3))))) == 1


@pytest.mark.parametrize("text", ["", None, " ", "\n\n", "x", "漢字" * 10, "\x00", "a b " * 10_000, "!" * 99])
def test_statistics_are_finite(text):
    found = quality.features(pd.Series([text]))
    assert found.shape == (1, len(quality.NAMES)) and np.isfinite(found).all()


def test_held_out_accuracy(spark, documents):
    pick = random.Random(0)
    rows, labels = [], []
    for i in range(600):
        good = pick.random() < 0.7
        text = sentence(i, pick.randint(10, 80))
        rows.append((i, text if good else " | ".join(text.split()), "s"))
        labels.append((i, int(good)))
    rows += [(None, None, "s"), (700, "", "s"), (3, rows[3][1], "s")]
    labels += [(701, 1), (None, 1), (702, None), (4, 0), (4, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = documents(rows)
    got = quality.scored(docs, known).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    for r in got:
        name = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.held_out == (zlib.crc32(name) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    again = quality.scored(docs.repartition(3), known).collect()
    assert sorted((r.doc_id or -1, r.score) for r in again) == sorted((r.doc_id or -1, r.score) for r in got)
    kept = quality.accepted(docs, known)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark, documents):
    rows = [(i, sentence(i, 30) if i % 2 else sentence(i, 30).upper(), "s") for i in range(200)]
    labels = [(i, i % 2) for i in range(200)]
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    schema, docs = "doc_id long, quality int", documents(rows)
    one, two = (
        {r.doc_id: r.score for r in quality.scored(docs, spark.createDataFrame(x, schema)).collect()}
        for x in (labels, other)
    )
    assert one == two


def test_nothing_to_learn_or_score(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scored(documents([]), none).count() == 0
    assert quality.scored(documents([(1, "a", "s")]), none).first().score == 0.5


def test_the_commonest_word_may_be_long():
    text = " ".join(f"repeatedword {c}" for c in "abcdefghij")
    assert quality.statistics(text)[quality.NAMES.index("commonest")] == 0.5
