from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from pacewise.llm import components, ngrams
from tests.llm.conftest import WORD, sentence


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    classes = {}
    for i, (doc_id, _, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(doc_id)
    return Counter(
        (doc_id, links[i], min((d for d in classes[find(i)] if d is not None), default=None))
        for i, (doc_id, _, _) in enumerate(rows)
    )


def edited(base, number, every=40):
    words = base.split()
    for i in range(number % every, len(words), every):
        words[i] = f"e{number}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    made = [(i, edited(sentence(1, 200), i), "s") for i in range(40)]  # one dense group
    made += [(100 + i, sentence(100 + i), "s") for i in range(30)]  # nothing alike
    chain = sentence(7, 120).split()
    made += [(200 + i, " ".join(chain[i * 8 : i * 8 + 90]), "s") for i in range(4)]
    made += [
        (300, "short text", "s"), (301, "Short\ttext", "s"), (302, "text short", "s"),
        (303, None, "s"), (304, "", "s"), (305, " \n", "s"), (306, "a", "s"),
        (307, sentence(9), "s"), (307, sentence(9), "s"), (308, sentence(9).upper(), "s"),
        (None, sentence(9), "s"), (None, "alone with no id at all here", "s"),
        (310, "a b c d e f", "s"), (311, "a b c d e g", "s"),
        (312, "x y z v w " * 500, "s"), (313, "x y z v w " * 400, "s"),
        (314, sentence(20, 3000), "s"), (315, edited(sentence(20, 3000), 1, 500), "s"),
    ]
    return made


@pytest.mark.parametrize("tile", [512, 3])
def test_links_match_brute_force(documents, rows, tile, monkeypatch):
    monkeypatch.setattr(ngrams, "TILE", tile)
    got = ngrams.similarity_classes(documents(rows)).collect()
    assert Counter((r.doc_id, r.n_links, r.class_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_one_document_of_each_group_stays(documents, rows):
    known = [r for r in rows if r[0] is not None]
    docs = documents(known)
    out = ngrams.one_of_each(docs)
    assert out.columns == docs.columns
    want = {class_id for _, _, class_id in brute(known)}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_empty_table(documents):
    assert ngrams.similarity_classes(documents([])).count() == 0
    assert ngrams.similarity_classes(documents([(1, "", "s")])).first().n_links == 0


def test_prefixes_shorten_until_the_recall_is_met():
    full = [ngrams.MAX_DEPTH] * ngrams.TREES
    assert ngrams.shortened({0.99: 3.0}) == full
    for recall in (0.9, 0.99, 0.999, 0.9999):
        for alike in ({0.8: 1.0}, {0.8: 1.0, 0.85: 5.0}, {0.82: 2.0}):
            depths = ngrams.shortened(alike, recall)
            assert max(depths) - min(depths) <= 1 and ngrams.expected_recall(depths, alike) >= recall
            if depths != full:  # the trie shortened last was needed
                last = max(i for i, d in enumerate(depths) if d == min(depths))
                longer = [d + (i == last) for i, d in enumerate(depths)]
                assert ngrams.expected_recall(longer, alike) < recall
    assert min(ngrams.shortened({0.0: 1.0})) == 1


def test_prefixes_meet_as_often_as_sets_are_alike():
    rng = np.random.default_rng(3)
    common, own = rng.integers(0, 1 << 63, 800, dtype=np.uint64), rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    flat = np.concatenate([np.sort(np.r_[common, own[:200]]), np.sort(np.r_[common, own[200:]])])
    words = ngrams.words_of_tries(flat, np.array([0, 1000, 2000]), 2000, 3)
    alike = 800 / 1200
    for depth in (1, 2, 3):
        keys = ngrams.prefixes(words, [depth] * 2000)
        assert abs((keys[0] == keys[1]).mean() - alike**depth) < 0.05
    mixed = ngrams.prefixes(words, [1] * 1000 + [3] * 1000)
    assert (mixed[:, 1000:] == keys[:, 1000:]).all()


def test_recall_at_the_threshold_is_measured(documents):
    """Pairs of similarity 0.8 to 0.83: nearly all of them are found, by a known rate."""
    rows = []
    for i in range(400):
        words = sentence(i, 124).split()  # 120 shingles, 13 lost by 3 edits apart
        other = list(words)
        other[30] = other[100] = f"x{i}"
        rows += [(2 * i, " ".join(words), "s"), (2 * i + 1, " ".join(other), "s")]
    alike = [len(shingles(a[1]) & shingles(b[1])) / len(shingles(a[1]) | shingles(b[1])) for a, b in zip(rows[::2], rows[1::2])]
    assert 0.8 <= min(alike) and max(alike) < 0.86
    got = ngrams.similarity_classes(documents(rows)).collect()
    assert sum(r.n_links for r in got) / 2 >= 0.99 * 400


def test_a_chain_of_blocks_is_not_verified_all_against_all(documents, monkeypatch):
    """Each text shares trie nodes with the next ones only; its set moves a bounded number of times."""
    monkeypatch.setattr(ngrams, "TILE", 8)
    words = sentence(77, 30_000).split()
    rows = [(i, " ".join(words[i * 9 : i * 9 + 100]), "s") for i in range(3000)]
    moved, tiles = [], ngrams._tiles

    def counted(rows, unit):
        out = tiles(rows, unit)
        moved.append(out.count())
        return out

    monkeypatch.setattr(ngrams, "_tiles", counted)
    got = ngrams.similarity_classes(documents(rows)).collect()
    assert sum(moved) <= 3 * ngrams.TREES * len(rows)
    want = brute_chain(rows)
    assert sum(r.n_links for r in got) >= 0.999 * 2 * want


def brute_chain(rows):
    sets = [shingles(t) for _, t, _ in rows]
    return sum(
        len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
        for i in range(len(sets)) for j in range(i + 1, min(i + 6, len(sets)))
    )


def test_components_match_brute_force(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)]
    edges += [(300, 300), (None, 5), (7, None), (205, 201), (201, 205), (201, 203), (203, 400)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)}
    assert got == want | dict.fromkeys((201, 203, 205, 400), 201)


def test_forest_connects_what_the_matrix_connects():
    links = np.zeros((6, 6), bool)
    for i, j in ((0, 3), (3, 5), (1, 2)):
        links[i, j] = links[j, i] = True
    i, j = components.forest(links)
    assert sorted(zip(i.tolist(), j.tolist())) == [(2, 1), (3, 0), (5, 0)]


def test_one_row_of_each_class_stays_with_ids_missing_or_repeated(documents, rows):
    base = sentence(40, 200)
    more = [(None, edited(sentence(9, 60), 3, 200), "s"), (None, None, "s"), (None, "", "s"), (None, "", "s")]
    more += [(None, edited(base, i, 200), "s") for i in range(6)]  # a class without ids
    more += [(100, edited(sentence(2, 200), 1, 200), "s"), (99, edited(sentence(2, 200), 2, 200), "s")]
    more += [(98, edited(sentence(3, 200), i, 200), "s") for i in range(3)]  # one id, one class
    made = rows + more
    out = [(r.doc_id, r.text) for r in ngrams.one_of_each(documents(made)).collect()]
    sets = [shingles(t) for _, t, _ in made]
    classes = []
    for i, own in enumerate(sets):
        met = [c for c in classes if any(own and len(own & sets[j]) >= 0.8 * len(own | sets[j]) for j in c)]
        classes = [c for c in classes if c not in met] + [[i, *(j for c in met for j in c)]]
    empty = {made[i][:2] for i, own in enumerate(sets) if not own}
    assert Counter(x for x in out if not shingles(x[1])) == Counter(empty)
    for members in (c for c in classes if sets[c[0]]):
        found = [x for x in out if x in {made[i][:2] for i in members}]
        least = min((made[i][0] for i in members if made[i][0] is not None), default=None)
        assert [x[0] for x in found] == [least]


def test_texts_of_rows_without_an_id_meet_their_own_class_only(documents, monkeypatch):
    rows = [(None, edited(sentence(i % 10, 200), i, 200), "s") for i in range(60)]
    met, shingled = [], ngrams._shingled
    monkeypatch.setattr(ngrams, "_shingled", lambda df, *more: met.append(df.count()) or shingled(df, *more))
    ngrams.similarity_classes(documents(rows)).collect()
    assert met[-1] == 60  # after the sample


def test_prefixes_are_shortened_by_all_links_and_not_by_a_sample(documents, monkeypatch):
    monkeypatch.setattr(ngrams, "LEAST_SIMILAR", 1.0)
    seen, shortened = [], ngrams.shortened
    monkeypatch.setattr(ngrams, "shortened", lambda alike, *more: seen.append(alike) or shortened(alike, *more))
    rows = [(i, edited(sentence(1, 200), i, 200), "s") for i in range(40)]  # one dense group
    ngrams.similarity_classes(documents(rows)).collect()
    links = sum(n * many for (_, n, _), many in brute(rows).items()) / 2
    # One pair of a trie node would be a few dozen at most.
    assert links > 700 and 0.98 * links <= sum(seen[-1].values()) <= 1.02 * links
