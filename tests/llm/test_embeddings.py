from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from pacewise.llm import embeddings


def brute(rows):
    units = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            if a @ b >= 0.93:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return Counter(
        (r[0], links[i], min((g for g in groups[find(i)] if g is not None), default=None))
        for i, r in enumerate(rows)
    )


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    made = []

    def add(vector, label=1):
        made.append((len(made), np.asarray(vector, np.float32).tolist(), label))

    hub = rng.normal(size=16)
    for _ in range(120):  # one dense group around a vector, at all distances
        add(hub + rng.normal(size=16) * rng.uniform(0, 0.5), int(rng.integers(1, 3)))
    for _ in range(100):
        add(rng.normal(size=16) * rng.uniform(0.01, 100))
    for i in range(12):  # a chain along a circle
        add([np.cos(i / 3), np.sin(i / 3), *[0] * 14], 7)
    add(hub * 3)
    add(hub * 3)
    add([0.0] * 16)
    add([float("nan")] + [1.0] * 15)
    add([float("inf")] + [1.0] * 15)
    add([])
    add([1.0, 2.0], 1)
    add([2.0, 4.0], 1)
    made.append((900, None, 1))
    made.append((901, [1.0, None, 3.0], 1))
    made.append((902, made[0][1], None))
    made.append((5, made[5][1], made[5][2]))
    made.append((None, [0.0] * 15 + [1.0], 3))
    return made


@pytest.mark.parametrize("part, cell", [(1536, 50_000), (9, 5)])
def test_links_match_brute_force(spark, rows, part, cell, monkeypatch):
    monkeypatch.setattr(embeddings, "PART", part)
    monkeypatch.setattr(embeddings, "CELL", cell)
    df = spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        "vec_id long, embedding array<float>, label int, node string, cell string",
    )
    got = embeddings.similarity_links(df).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_close_vectors_are_close_in_some_subspace():
    rng = np.random.default_rng(1)
    limits = embeddings.budgets(64, 0.93)
    turn = embeddings.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    for _ in range(300):
        a = rng.normal(size=64)
        b = a + rng.normal(size=64) * 0.39
        a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
        if a @ b >= 0.93:
            apart = ((a - b) @ turn) ** 2
            assert any(
                apart[s].sum() <= limits[i] for i, s in enumerate(embeddings.subspaces(64))
            )


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.similarity_links(df).count() == 0
