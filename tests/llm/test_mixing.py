from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from pacewise.llm import mixing
from tests.llm.conftest import WORD


def fill(sizes: dict, weights=(5.0, 2.0, 1.0), share=1.5, most=2) -> dict:
    """Targets by raising the level until all is given."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


@pytest.fixture(scope="module")
def rows():
    made = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 7}") for i in range(300)]
    return made + [
        (300, None, "s1"), (301, "", "s2"), (302, " \t\n", "s2"), (303, "a\x85b c ", None),
        (None, "x y z", "s3"), (5, "w w w w w w", "s5"), (5, "w w w w w w", "s5"), (306, "z", "Z"),
        (307, " ".join(["long"] * 900), "s6"),
    ]


def test_targets_and_words(documents, rows):
    got = mixing.mix(documents(rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = fill(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (i, len(WORD.findall(t or ""))) for i, t, _ in rows
    )
    by_target = {(r.source_size, round(r.target, 6)) for r in got}
    assert by_target == {(sizes[s], round(want[s], 6)) for s in sizes}


def test_taken_words_come_near_targets(spark, documents, rows):
    unique = [r for r in rows if r[0] not in (5, None)]
    docs = documents(unique)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    taken, biggest = defaultdict(int), defaultdict(int)
    for doc_id, _, source in unique:
        r = got[doc_id]
        assert r.size == 0 or r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
        biggest[source] = max(biggest[source], r.size)
        target = r.target
        got[source] = target
    for source in taken:
        assert abs(taken[source] - got[source]) <= biggest[source] / 2 + 1e-6
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {i: got[i].taken for i, _, _ in unique}


def test_one_repeated_row_still_meets_its_target(documents):
    rows = [(1, "a b c d", "p")] * 90 + [(2, "x " * 100, "q"), (3, "y " * 300, "r")]
    got = mixing.mix(documents(rows)).collect()
    p = [r for r in got if r.doc_id == 1]
    assert len(p) == 90 and abs(sum(r.taken for r in p) - p[0].target) <= 2


def test_mixed_repeats_whole_rows(documents, rows):
    docs = documents([r for r in rows if r[0] not in (5, None)])
    times = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect() if r.size}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        {i: n for i, n in times.items() if n}
    )


def test_nothing_to_mix(documents):
    assert mixing.mix(documents([])).count() == 0
    got = mixing.mix(documents([(1, "", "a"), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_mixed_meets_targets_with_ids_missing_or_repeated(documents, rows):
    made = rows + [(None, "n " * (i % 9), f"s{i % 7}") for i in range(80)]
    made += [(5, "five " * (1 + i % 3), "s2") for i in range(90)]
    docs = documents(made)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text, r.source) for r in out.collect()]
    assert set(got) <= set(made) and {None, 5} <= {r[0] for r in got}
    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in made:
        sizes[source] += len(WORD.findall(text or ""))
        biggest[source] = max(biggest[source], len(WORD.findall(text or "")))
    for _, text, source in got:
        taken[source] += len(WORD.findall(text))
    for source, target in fill(sizes).items():
        assert abs(taken[source] - target) <= biggest[source] / 2 + 1e-6
    most = Counter(made)
    assert all(n <= 2 * most[r] for r, n in Counter(got).items())
