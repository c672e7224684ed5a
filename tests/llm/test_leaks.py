from __future__ import annotations

import random
import re
from collections import Counter

from pacewise.llm import leaks
from pacewise.llm.words import words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return [(m[0], m.span()) for m in WORD.finditer((text or "").translate(ASCII))]


def brute(docs, items, window=10):
    """Compares every window with every place."""
    windows = []
    for name, text in items:
        words = [w for w, _ in plain(text)]
        size = min(len(words), window)
        for i in range(len(words) - size + 1 if words else 0):
            windows.append((str(name) if name is not None else "", words[i : i + size]))
    out = []
    for doc, text in docs:
        words = plain(text)
        only = [w for w, _ in words]
        hit, names = set(), set()
        for name, part in windows:
            for i in range(len(only) - len(part) + 1):
                if only[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    names.add(name)
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], words[i][1][1])
            else:
                spans.append(words[i][1])
        out.append((doc, len(words), len(hit), tuple(sorted(names)), tuple(spans)))
    return out


def run(spark, docs, items, **settings):
    d = spark.createDataFrame([(*r, 1, "y") for r in docs], "doc_id long, text string, items int, spans string")
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    rows = leaks.scanned(d, q, **settings).collect()
    return Counter(
        (r.doc_id, r.n_words, r.n_hit, tuple(r.items), tuple((s.begin, s.end) for s in r.spans))
        for r in rows
    )


def passage(rng, n):
    return " ".join(f"w{rng.randrange(12)}" for _ in range(n))


def cases():
    rng = random.Random(4)
    items = [(i, passage(rng, rng.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    items += [
        (20, "Éclair über! 10 a-b C_d"), (21, None), (22, ""), (23, " .;"), (None, "only nameless words"),
        (24, "dup dup"), (24, "dup dup"), (25, "dup dup dup"), (9, "nine as well"), (10, "TEN nine\nas WELL"),
    ]
    docs = [(i, passage(rng, rng.randrange(60))) for i in range(60)]
    docs += [(100 + i, f"Before. {t.upper() if t else ''}, after") for i, (_, t) in enumerate(items)]
    docs += [
        (200, None), (201, ""), (202, "?!"), (203, "dup, DUP -- dup dup"), (None, "only nameless words"),
        (None, "only nameless words"), (204, "dupdup dup"), (205, "x" * 100_000 + " dup dup"),
        (206, "éclair über 10 a b c d"), (207, "ÉCLAIR über 10 a b c d"), (208, "dup " * 5000),
        (209, "ten nine as well nine as well"),
    ]
    return docs, items


def test_scan_equals_comparing_all_windows(spark):
    docs, items = cases()
    assert run(spark, docs, items) == Counter(brute(docs, items))


def test_several_automata_find_the_same(spark):
    docs, items = cases()
    assert run(spark, docs, items, words_at_once=12) == Counter(brute(docs, items))


def test_other_windows(spark):
    docs, items = cases()
    assert run(spark, docs, items, window=4) == Counter(brute(docs, items, 4))


def test_empty_tables(spark):
    docs, items = cases()
    assert run(spark, [], items) == Counter()
    assert run(spark, docs, []) == Counter(brute(docs, []))


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + " ﬀ Ａ b\U0001f600c" + "Aa0\x00Zz\x7f_`{"
    assert [w.decode() for w in words_of(text)] == [w for w, _ in plain(text)]


def test_spellings_are_never_found_across_words():
    words = [f"w{i}".encode() for i in range(60_000)]
    spelled = leaks.spelled(words)
    assert len(set(spelled.values())) == len(words) and leaks.UNKNOWN not in spelled.values()
    scanner = leaks.Scanner([("a", words[-12:]), ("b", words)], 10)
    assert {(a, b) for a, b, _ in scanner.scan([b"x", *words[55_290:55_300]])} == {(1, 11)}
    few = leaks.Scanner([("a", [b"x", b"y", b"x"])], 2)
    assert [(a, b) for a, b, _ in few.scan([b"y", b"x", b"x", b"y"])] == [(0, 2), (2, 4)]


def test_cleaning_leaves_what_stands_around():
    assert leaks.without_spans("Keep this. Leaked words here! And this.", [(11, 28)]) == "Keep this. ! And this."
    assert leaks.without_spans("all", [(0, 3)]) == ""
    assert leaks.without_spans("none", []) == "none"
