from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from tokenizers import Tokenizer

import corpus_pipeline
from pacewise.llm import mixing, ngrams, quality
from pacewise.llm.queries import tokenizer
from pacewise.llm.store import stored
from tests.llm.conftest import sentence
from tests.llm.test_ngrams import shingles


def write_tables(spark, folder):
    rows = [(i, sentence(i, 40 + i % 60), "en", f"src{i % 4}", 0) for i in range(120)]
    rows += [(200 + i, sentence(i, 40 + i % 60).upper(), "en", "src1", 0) for i in range(10)]
    rows += [(300 + i, sentence(50 + i, 90 + i) + " tail", "en", None, 0) for i in range(5)]
    rows += [(400 + i, " | ".join(sentence(i, 50).split()), "en", "src0", 0) for i in range(40)]
    rows += [(500, None, None, None, None), (501, "", "en", "src2", 0), (120, sentence(3), "en", "src0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, 1) for i in range(0, 120, 2)] + [(400 + i, 0) for i in range(0, 40, 2)]
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages_do_what_brute_force_does(spark, tmp_path):
    rows = write_tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    after = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), "test-stage")
        after.append([r.asDict() for r in docs.collect()])
    columns = {"doc_id", "text", "lang", "source", "n_chars"}
    assert all(set(r) == columns for rows in after[:-1] for r in rows)

    good, exact, near, mixed, encoded = after
    source = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = {r.doc_id: r.predicted for r in quality.scored(source, labels).collect()}
    assert Counter(r["doc_id"] for r in good) == Counter(r[0] for r in rows if judged[r[0]])
    assert {r["doc_id"] for r in good} >= set(range(120))  # clean documents stay

    groups = defaultdict(list)
    for r in good:
        groups[(r["text"] or "").lower()].append(r["doc_id"])
    assert Counter(r["doc_id"] for r in exact) == Counter(max(g) for g in groups.values())

    kept, sets = [], {r["doc_id"]: shingles(r["text"]) for r in exact}
    for doc_id in sorted(sets):
        own = sets[doc_id]
        if not any(own and len(own & sets[k]) >= 0.8 * len(own | sets[k]) for k in kept):
            kept.append(doc_id)
    assert sorted(r["doc_id"] for r in near) == kept

    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in near],
                                  "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(frame).collect() if r.size}
    assert Counter(r["doc_id"] for r in mixed) == Counter({i: n for i, n in taken.items() if n})

    library, texts = Tokenizer.from_file(tokenizer()), {r["doc_id"]: r["text"] for r in mixed}
    assert len(encoded) == len(mixed)
    for r in encoded:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        joined = " ".join(map(str, ids))
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.ids_sha256 for r in run) == Counter(r["ids_sha256"] for r in encoded)
    assert ngrams.WORDS == 5 and ngrams.THRESHOLD == 0.8
