from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pacewise.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, sums long"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Plain rounds over all entries; rows are (vec_id, embedding, label)."""
    kept = [
        (i, [math.floor(scale * x) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return [], None
    dims = len(kept[0][1])
    cuts = [dims * p // parts for p in range(parts + 1)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][a:b] for r in first] for a, b in zip(cuts, cuts[1:])]

    def nearest(part, book):
        return min((sum((x - c) ** 2 for x, c in zip(part, e)), i) for i, e in enumerate(book))

    def assign():
        return [
            [nearest(v[a:b], book) for book, a, b in zip(books, cuts, cuts[1:])] for _, v, _ in kept
        ]

    for _ in range(rounds):
        found = assign()
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            members = defaultdict(list)
            for (_, v, _), own in zip(kept, found):
                members[own[p][1]].append(v[a:b])
            for e, held in members.items():
                books[p][e] = [sum(x) // len(held) for x in zip(*held)]
    found = assign()
    by_label = defaultdict(int)
    for (_, _, lab), own in zip(kept, found):
        by_label[lab] += sum(d for d, _ in own)
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [
        (i, "".join(f"{e:02x}" for _, e in own), sum(d for d, _ in own), by_label[lab])
        for (i, _, lab), own in zip(kept, found)
    ], hashlib.sha256(text.encode()).hexdigest()


def made(seed: int, n: int, dims: int, spread: float = 1.0) -> list:
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(9)]
    return [
        (i, [x + rng.gauss(0, spread / 5) for x in rng.choice(centres)], rng.choice([1, 2, None]))
        for i in range(n)
    ]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], schema)


def result(df):
    rows = df.collect()
    assert len({r.codebooks_sha256 for r in rows}) <= 1
    return Counter((r.vec_id, r.code, r.error, r.label_error) for r in rows), {
        r.codebooks_sha256 for r in rows
    }


def test_codes_equal_plain_rounds(spark):
    rows = made(1, 400, 32)
    rows += [
        (1000, None, 1),
        (1001, [0.0] * 31 + [None], 1),
        (1002, [0.0] * 31 + [float("nan")], 1),
        (1003, [0.0] * 31 + [float("inf")], 1),
        (1004, [0.0] * 32, None),
        (-5, [-0.001] * 32, 2),  # floors go down
        (None, [0.3] * 32, 1),
        rows[7],
        rows[7],  # repeated rows
    ]
    want, digest = brute(rows)
    got, digests = result(codes.compressed(spark, frame(spark, rows)))
    assert got == Counter(want) and digests == {digest}


def test_fewer_rows_than_entries_and_equal_entries(spark):
    rows = [(i, [float(i % 3)] * 16, 1) for i in range(10)]
    want, digest = brute(rows)
    got, digests = result(codes.compressed(spark, frame(spark, rows)))
    assert got == Counter(want) and digests == {digest}


def test_parts_that_do_not_divide_and_more_rounds(spark):
    rows = made(3, 300, 21, 3.0)
    want, digest = brute(rows, parts=4, entries=20, rounds=6)
    df = codes.compressed(spark, frame(spark, rows), parts=4, entries=20, rounds=6)
    got, digests = result(df)
    assert got == Counter(want) and digests == {digest}


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 9000 for x in v], lab) for i, v, lab in made(4, 120, 16)]
    want, digest = brute(rows, parts=2, entries=12)
    got, digests = result(codes.compressed(spark, frame(spark, rows), parts=2, entries=12))
    assert got == Counter(want) and digests == {digest}
    beyond = [*rows, (999, [1e300] * 16, 1)]
    again, _ = result(codes.compressed(spark, frame(spark, beyond), parts=2, entries=12))
    assert again == got


def test_other_lengths_have_no_code(spark):
    rows = made(5, 40, 16)
    odd = [(500, [1.0] * 8, 1), (501, [], None)]
    want, _ = brute(rows)
    sums = {i: s for i, _, _, s in want}
    got, _ = result(codes.compressed(spark, frame(spark, rows + odd)))
    by_label = {lab: sums[i] for i, _, lab in rows}
    assert got == Counter([*want, (500, None, None, by_label[1]), (501, None, None, by_label[None])])


def test_empty_table_and_nothing_to_code(spark):
    assert codes.compressed(spark, frame(spark, [])).collect() == []
    assert codes.compressed(spark, frame(spark, [(1, None, 1)])).collect() == []
    assert [r.code for r in codes.compressed(spark, frame(spark, [(1, [], 1)])).collect()] == ["00" * 16]


def test_decoded_vectors_are_the_named_entries(spark):
    rows = made(6, 60, 16)
    coded, books, _ = codes.train(frame(spark, rows))
    back = {r.vec_id: r.vector for r in codes.decoded(coded, books).collect()}
    for row in coded.collect():
        whole = [math.floor(256 * x) for x in rows[row.vec_id][1]]
        assert row.error == sum((a - 256 * b) ** 2 for a, b in zip(whole, back[row.vec_id]))


def test_lists_adapt(spark):
    # Far apart groups ask for nothing: lists become as short as they may.
    rows = [(i, [float(i % 64) * 10 + (i % 7) / 100] * 16, 1) for i in range(640)]
    _, _, sizes = codes.train(frame(spark, rows), parts=1, rounds=4)
    assert sizes[0] == codes.FIRST and sizes[-1] == codes.LEAST
    usage = np.zeros((1, codes.MOST + 2), np.int64)
    usage[0, codes.MOST + 1] = 10
    assert codes.adapted(8, usage) == 16


@pytest.mark.parametrize("seed", range(6))
def test_bounds_decide_as_distances_do(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 9, (300, 3))  # many ties
    entries = rng.integers(-9, 9, (40, 3))
    b = int(rng.integers(1, 12))
    near, bounds = codes.listed(x, entries, b)
    for _ in range(8):
        moved = entries + rng.integers(-2, 3, entries.shape)
        moves = np.sqrt(((moved - entries) ** 2).sum(axis=1)) * (1 + 1e-12)
        entries, b = moved, int(rng.integers(1, 12))
        near, bounds, asked = codes.reassigned(x, near, bounds, moves, entries, b)
        apart = codes.squared(x, entries)
        assert (near[:, 0] == apart.argmin(axis=1)).all()
        assert (bounds[:, 0] >= np.sqrt(apart.min(axis=1)) - 1e-9).all()
        assert (asked[asked <= codes.MOST] <= 12).all()
        for row in range(len(x)):
            listed = near[row][near[row] != codes.NONE]
            assert len(set(listed.tolist())) == len(listed)
            rest = np.delete(np.sqrt(apart[row]), listed)
            assert not len(rest) or bounds[row, -1] <= rest.min() + 1e-6
