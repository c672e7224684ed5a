from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pacewise.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, top=10):
    """Scores everything: (item_id, rank, doc_id, score) of each item."""
    held = [(i, Counter(t), len(t)) for i, text in docs if (t := terms_of(text))]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        own, points = dict.fromkeys(terms_of(text)), []
        for doc, tf, size in held:
            m = 10 + 90 * size * n // total
            score = sum(
                weight[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in own if t in tf
            )
            if score > 0:
                points.append((-score, doc is None, doc or 0, doc))
        points.sort(key=lambda p: p[:3])
        out += [(item, r + 1, p[3], -p[0]) for r, p in enumerate(points[:top])]
    return out


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 30)))) for i in range(n)]


def tables(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, terms string")
    q = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, rank int, doc_id int")
    return d, q


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, df.collect()))


ITEMS = [
    (1, "w1 w2 w50"), (2, "W3, w3; w3 w0"), (3, "none of these"), (4, None), (5, ""), (6, "w59"),
    (7, " ".join(f"w{i}" for i in range(60))), (7, "w9 w8"), (7, "w9 w8"), (None, "w30 w31 w0"),
    (8, "çá w0"),
]


def test_best_documents_are_those_of_scoring_all(spark):
    docs = corpus(1, 700)
    docs += [
        (2000, None), (2001, ""), (2002, " .,; \x00"), (2003, "ÇÁ çá W0"), (None, "w30 w31"),
        (None, "w30 w31"), (2004, "w1 w2 w50 " * 3000), docs[5], docs[5],
    ]
    docs += [(3000 - i, "w50 w51 w52") for i in range(60)]  # ties
    got = found(ranked.best_documents(*tables(spark, docs, ITEMS)))
    assert got == Counter(brute(docs, ITEMS))


def test_small_segments_and_blocks_of_items(spark):
    docs = corpus(2, 300)
    df = ranked.best_documents(
        *tables(spark, docs, ITEMS), top=4, segment_docs=17, items_at_once=2, terms_at_once=40
    )
    assert found(df) == Counter(brute(docs, ITEMS, 4))


def test_many_blocks_in_a_segment(spark):
    docs = corpus(3, 6000, 200)
    docs, items = tables(spark, docs, [(i, f"w{i} w{i + 1} w{i + 40} w0 w1") for i in range(12)])
    got = found(ranked.best_documents(docs.coalesce(1), items))
    assert got == Counter(brute(corpus(3, 6000, 200), [tuple(r)[:2] for r in items.collect()]))


def test_empty_tables(spark):
    docs, items = tables(spark, corpus(4, 20), ITEMS)
    assert ranked.best_documents(docs.limit(0), items).collect() == []
    assert ranked.best_documents(docs, items.limit(0)).collect() == []
    assert ranked.best_documents(docs.selectExpr("doc_id", "'' AS text"), items).collect() == []


def test_a_term_of_every_document_weighs_nothing(spark):
    docs = [(i, "same" if i else "same other") for i in range(600)]
    got = found(ranked.best_documents(*tables(spark, docs, [(1, "same other"), (2, "same")])))
    assert got == Counter(brute(docs, [(1, "same other"), (2, "same")]))


def index_of(docs, items, top=3):
    """One segment and its index, without Spark."""
    numbers, terms = {}, []
    for _, text in items:
        terms.append(np.array([numbers.setdefault(t, len(numbers) + 1) for t in dict.fromkeys(terms_of(text))]))
    own = ranked.Items([i for i, _ in items], terms, numbers)
    rows = [(n, Counter(t)) for n, (_, text) in enumerate(docs) for t in [terms_of(text)]]
    entries = sorted((numbers[t], n, k) for n, tf in rows for t, k in tf.items() if t in numbers)
    term = np.array([e[0] for e in entries])
    edges = np.flatnonzero(np.diff(term, append=-1)) + 1
    row = {
        "lengths": np.array([len(terms_of(t)) for _, t in docs], np.int64).tobytes(),
        "terms": term[edges - 1].astype(np.int32).tobytes(),
        "ends": edges.astype(np.int64).tobytes(),
        "docs": np.array([e[1] for e in entries], np.uint16).tobytes(),
    }
    tf = np.array([e[2] for e in entries], np.int64)
    n, total = len(docs), sum(len(terms_of(t)) for _, t in docs)
    df = np.zeros(len(numbers) + 1, np.int64)
    df[term[edges - 1]] = np.diff(edges, prepend=0)
    weights = ranked.weights_of(df, n)
    pairs = ranked.pairs_of(own, weights)
    segment = ranked.Segment(row, len(numbers))
    impacts = segment.impacts(tf, weights, n, total)
    at, block, best = segment.block_best(impacts)
    joint = [(p, d // ranked.BLOCK, j) for p, ds, js in segment.joint(*pairs, impacts) for d, j in zip(ds, js)]
    most = {}
    for p, b, j in joint:
        most[p, b] = max(most.get((p, b), 0), j)
    row |= {
        "impacts": impacts.tobytes(), "best_at": at.astype(np.int32).tobytes(),
        "best_block": block.astype(np.uint8).tobytes(), "best": best.tobytes(),
        "pairs": np.array([p for p, _ in most], np.int32).tobytes(),
        "pair_block": np.array([b for _, b in most], np.uint8).tobytes(),
        "joint": np.array(list(most.values()), np.int64).tobytes(),
    }
    return own, pairs, segment, impacts, ranked.Searcher(row, own, pairs, len(numbers))


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_pairs_tighten_them(seed):
    docs = corpus(seed + 10, 2500, 40)
    items = [(q, " ".join(random.Random(q).sample([f"w{i}" for i in range(40)], 9))) for q in range(6)]
    own, pairs, segment, impacts, searcher = index_of(docs, items)
    numbers = {p: i for i, p in enumerate(zip(pairs[0].tolist(), pairs[1].tolist()))}
    tighter = 0
    for terms in own.terms:
        order = terms[np.argsort(searcher.best[searcher.place[terms]].max(axis=1), kind="stable")]
        bounds = searcher.bounds(order, ranked._own_pairs(terms, numbers))
        alone = np.cumsum(searcher.best[searcher.place[order]], axis=0)
        assert (bounds[1:] <= alone).all()
        tighter += int((bounds[1:] < alone).sum())
        score = np.zeros(len(docs), np.int64)
        for k, t in enumerate(order.tolist()):
            span = slice(segment.begin[t], segment.end[t])
            score[segment.docs[span]] += impacts[span]
            assert (score <= bounds[k + 1][np.arange(len(docs)) // ranked.BLOCK]).all()
    assert tighter
