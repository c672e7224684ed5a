from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from pacewise.llm import chunks, shards, store
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").translate(LOWER)


ROWS = [
    (1, "Same Text", "a"),
    (2, "same text", "b"),
    (3, "SAME TEXT ", "a"),
    (4, None, None),
    (5, "", "a"),
    (None, "", "a"),
    (6, "ÄPFEL", "a"),
    (7, "äpfel", "a"),
    (8, "Äpfel", "a"),
    (9, sentence(1, 4000), "a"),
    (10, sentence(1, 4000).upper(), "a"),
    (11, sentence(1, 4000) + " end", "a"),
    (11, sentence(1, 4000) + " end", "a"),
    (None, "no id", "a"),
    (12, "日本語" * 5000, "a"),
]


def test_groups_match_brute_force(documents):
    got = chunks.exact_groups(documents(ROWS), least=16, most=64).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in ROWS:
        groups[normal(text)].append(doc_id)
    want = []
    for doc_id, text, _ in ROWS:
        ids = groups[normal(text)]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        want.append((doc_id, keep, len(ids), doc_id == keep, digest))
    assert Counter(map(tuple, got)) == Counter(want)


def test_kept_rows_have_all_columns_and_no_repetition(documents):
    docs = documents(ROWS)
    kept = chunks.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 5, 7, 8, 10, 11, 12]


def test_chunks_are_the_text(spark):
    text = sentence(3, 5000) + "\r\n" + "ß" * 3000
    df = spark.createDataFrame([(text,)], "text string")
    (found,) = df.select(chunks.chunks(df.text, 64, 512)).first()
    assert "".join(found) == text and len(found) > 20
    assert max(map(len, found)) <= 512 + 4


def test_an_insertion_changes_few_chunks(spark):
    # Marks come from the text, so cuts behind a change fall where they fell before.
    text = " ".join(["the cat is at a dark place", sentence(4, 3000), "that best man"] * 3)
    text = text.replace(" w1", " ats a1").replace(" w2", " est b")
    df = spark.createDataFrame([(text,), ("Neu " + text,)], "text string")
    one, two = (set(r[0]) for r in df.select(chunks.chunks(df.text, 64, 512)).collect())
    assert len(one & two) > 0.5 * len(one)


def test_identifiers_that_clash_are_found(spark, monkeypatch):
    def weak(chunk, seed):
        return store.F.struct((store.F.length(chunk) * (seed - 1)).alias("a"), (
            store.F.xxhash64(chunk) * (seed - 1)).alias("b"))

    monkeypatch.setattr(chunks, "identifier", weak)
    pieces = spark.createDataFrame([("ab",), ("cd",), ("ab",)], "chunk string")
    assert chunks.verified_seed(pieces) == 2


def test_empty_table(documents):
    assert chunks.exact_groups(documents([])).count() == 0
    assert shards.shards(documents([])).count() == 0


def bits(doc_id):
    digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    return f"{int(digest[:15], 16):060b}"


def test_shards_split_only_where_needed(documents):
    rows = [(i, "x" * (i % 50), "a") for i in range(400)] + [(999, "y" * 5000, "a"), (400, None, "a")]
    got = shards.shards(documents(rows), limit_bytes=700).collect()
    sizes = {(len(p), p): 0 for p in ()}
    sizes = defaultdict(lambda: [0, 0])
    for doc_id, text, _ in rows:
        for d in range(61):
            entry = sizes[bits(doc_id)[:d]]
            entry[0] += len(text or "")
            entry[1] += 1
    for r in got:
        depth = next(
            d for d in range(61)
            if sizes[bits(r.doc_id)[:d]][0] <= 700 or sizes[bits(r.doc_id)[:d]][1] == 1
        )
        prefix = bits(r.doc_id)[:depth]
        assert (r.shard, r.depth, r.shard_bytes, r.shard_docs) == (prefix, depth, *sizes[prefix])
    assert len(got) == len(rows)


def test_a_repeated_id_is_split_by_its_rows(documents):
    rows = [(1, "x" * 100, "a")] * 64 + [(None, "y" * 100, "a")] * 8
    got = shards.shards(documents(rows), limit_bytes=1000).collect()
    assert len(got) == 72
    held = Counter()
    for r in got:
        held[r.shard] += r.n_bytes
    assert max(held.values()) <= 1000


def test_shards_are_written_one_folder_each(spark, documents, tmp_path):
    docs = documents([(i, "x" * 40, "a") for i in range(50)]).drop("shard")
    shards.write_shards(docs, str(tmp_path / "out"), limit_bytes=500)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and len(list((tmp_path / "out").glob("_shard=*"))) > 3


@pytest.mark.parametrize("text", ["ABC xyz", "ÀBC", "", None, "İSTANBUL Σ"])
def test_ascii_lower(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(store.ascii_lower(df.text)).first()[0] == normal(text)
