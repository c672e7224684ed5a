"""Ranked lexical search by MaxScore with bounds of term pairs.

The documents are cut into segments, each with an inverted index of the terms that items
ask for: where a term stands, its impacts, and the greatest impact in each block of
documents. For pairs of an item's terms the index also keeps the pair's intersection
list: in which blocks both stand in one document, and the greatest impact that they have
there together. A query bounds what a set of terms can add to a document by matching
terms to pairs: a pair adds no more than its joint maximum, or either's own, which is
less than the sum of both. Terms that can't reach the tenth best score by themselves
name no candidates, blocks that can't reach it are skipped, and candidates are dropped as
soon as what is left can't lift them there. All that is dropped is below the tenth best
score for certain, so results are those of scoring everything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacewise.llm.store import ship_package, stored
from pacewise.llm.words import TO_WORDS, words_of

TOP = 10
#: Documents and postings of a segment, documents of a block, and segments of a file.
SEGMENT_DOCS, SEGMENT_POSTINGS, BLOCK, SEGMENTS_IN_FILE = 16_384, 1_000_000, 1_024, 4
#: Items and terms that are searched at once; more make more passes.
ITEMS_AT_ONCE, TERMS_AT_ONCE = 4_000, 200_000
#: Fixed values of the score: its scale, and how much of a text's length counts, in hundredths.
SCALE, LENGTH, EVEN = 1_000_000_000, 90, 10


class Items(NamedTuple):
    """Items searched at once: their ids, and for each the numbers of its terms."""

    ids: list
    terms: list[np.ndarray]
    numbers: dict[bytes, int]


def _blocks_of_items(
    items: DataFrame, id_col: str, text_col: str, most: int, most_terms: int
) -> Iterator[Items]:
    ids, terms, numbers = [], [], {}
    for row in items.select(id_col, text_col).toLocalIterator():
        own = dict.fromkeys(words_of(row[1]))
        if not own:
            continue
        if ids and (len(ids) >= most or len(numbers) + len(own) > most_terms):
            yield Items(ids, terms, numbers)
            ids, terms, numbers = [], [], {}
        # Numbers begin with 1: 0 is what filter(None, ...) takes out.
        terms.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in own]))
        ids.append(row[0])
    if ids:
        yield Items(ids, terms, numbers)


def _blob(a: np.ndarray, kind: type) -> bytes:
    return a.astype(kind).tobytes()


def _row(values: dict, doc_ids: pa.Array) -> pa.RecordBatch:
    """One segment as a batch of one row."""
    offsets = pa.array([0, len(doc_ids)], pa.int32())
    arrays = {"doc_ids": pa.ListArray.from_arrays(offsets, doc_ids)}
    for name, v in values.items():
        arrays[name] = pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64())
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


POSTINGS = {"lengths": "binary", "terms": "binary", "ends": "binary", "docs": "binary", "tf": "binary"}


def postings(docs: DataFrame, numbers: dict[bytes, int], segment_docs: int) -> DataFrame:
    """Segments of rows (doc_id, text): an inverted index of the numbered terms.

    A row holds its documents' ids and lengths, the terms that occur, and for each, up to
    `ends`, the places of its documents and how often it occurs there. Documents without
    any of the terms are only counted: n_docs and n_words are over all with a term at all.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, empty = numbers.get, None
        ids, lengths, counts, hits = [], [], [], []
        n_docs = n_words = 0

        def flush() -> pa.RecordBatch:
            nonlocal n_docs, n_words
            size = max(len(counts), 1)
            owner = np.repeat(np.arange(len(counts)), counts)
            keys = np.array(hits, np.int64) * size + owner
            keys, tf = np.unique(keys, return_counts=True)
            term, doc = keys // size, keys % size
            edges = np.flatnonzero(np.diff(term, append=-1)) + 1
            row = _row(
                {
                    "lengths": _blob(np.array(lengths, np.int64), np.int64),
                    "terms": _blob(term[edges - 1], np.int32),
                    "ends": _blob(edges, np.int64),
                    "docs": _blob(doc, np.uint16),
                    "tf": _blob(tf, np.int64),
                    "n_docs": n_docs,
                    "n_words": n_words,
                },
                pa.concat_arrays(ids) if ids else empty,
            )
            for held in (ids, lengths, counts, hits):
                held.clear()
            n_docs = n_words = 0
            return row

        for batch in batches:
            empty = batch.column("doc_id").slice(0, 0)
            taken = []
            for i, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().translate(TO_WORDS).split()
                if not words:
                    continue
                n_docs, n_words = n_docs + 1, n_words + len(words)
                before = len(hits)
                hits.extend(filter(None, map(get, words)))
                if len(hits) == before:
                    continue
                taken.append(i)
                lengths.append(len(words))
                counts.append(len(hits) - before)
                if len(counts) >= segment_docs or len(hits) >= SEGMENT_POSTINGS:
                    ids.append(batch.column("doc_id").take(pa.array(taken)))
                    taken = []
                    yield flush()
            if taken:
                ids.append(batch.column("doc_id").take(pa.array(taken)))
        if n_docs:
            yield flush()

    columns = ", ".join(f"{n} {t}" for n, t in POSTINGS.items())
    return docs.mapInArrow(
        index, f"doc_ids array<{kind}>, {columns}, n_docs long, n_words long"
    )


def weights_of(df: np.ndarray, n: int) -> np.ndarray:
    """A term's weight by how many of `n` documents hold it."""
    return np.array(
        [math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64
    )


def pairs_of(items: Items, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with intersection lists: each item's terms next to each other by weight.

    Terms of similar weight are on the same side of the division into terms that name
    candidates and terms that don't, which is where a joint bound helps. Returns the
    pairs' terms, the smaller number first, in order and each once.
    """
    found = set()
    for terms in items.terms:
        order = terms[np.lexsort((terms, weights[terms]))].tolist()
        found.update((min(p), max(p)) for p in zip(order, order[1:]))
    table = np.array(sorted(found), np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]


class Segment:
    """A segment's arrays, read from a row of postings() or indexed()."""

    def __init__(self, row: dict, last: int) -> None:
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        terms = np.frombuffer(row["terms"], np.int32)
        ends = np.frombuffer(row["ends"], np.int64)
        self.docs = np.frombuffer(row["docs"], np.uint16).astype(np.int64)
        # Where each of all terms begins and ends; both are 0 if it is not here.
        self.begin, self.end = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
        self.begin[terms], self.end[terms] = np.concatenate([[0], ends[:-1]]), ends
        self.terms, self.ends = terms, ends
        self.blocks = -(-len(self.lengths) // BLOCK)

    def impacts(self, tf: np.ndarray, weights: np.ndarray, n: int, total: int) -> np.ndarray:
        m = EVEN + (LENGTH * self.lengths * n) // total
        share = (SCALE * tf) // (1000 * tf + 8 * m[self.docs])
        sizes = np.diff(self.ends, prepend=0)
        return np.repeat(weights[self.terms], sizes) * share

    def block_best(self, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term's place, block, greatest impact) where a term occurs in a block."""
        owner = np.repeat(np.arange(len(self.terms)), np.diff(self.ends, prepend=0))
        key = owner * self.blocks + self.docs // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        best = np.maximum.reduceat(impacts, first) if len(first) else impacts[:0]
        return key[first] // max(self.blocks, 1), key[first] % max(self.blocks, 1), best

    def joint(
        self, a: np.ndarray, b: np.ndarray, impacts: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(pair, places, joint impacts) of each pair that meets in a document."""
        at, held = np.full(len(self.lengths), -1, np.int64), None
        here = np.flatnonzero((self.end[a] > self.begin[a]) & (self.end[b] > self.begin[b]))
        for pair in here.tolist():  # pairs of one first term stand together
            first, second = int(a[pair]), int(b[pair])
            if first != held:
                if held is not None:
                    at[self.docs[self.begin[held] : self.end[held]]] = -1
                span = np.arange(self.begin[first], self.end[first])
                at[self.docs[span]] = span
                held = first
            own = np.arange(self.begin[second], self.end[second])
            other = at[self.docs[own]]
            both = other >= 0
            if both.any():
                yield pair, self.docs[own[both]], impacts[own[both]] + impacts[other[both]]


INDEX = {
    "lengths": "binary", "terms": "binary", "ends": "binary", "docs": "binary", "impacts": "binary",
    "best_at": "binary", "best_block": "binary", "best": "binary",
    "pairs": "binary", "pair_block": "binary", "joint": "binary",
}


def _tenth(values: np.ndarray, top: int) -> int:
    return int(np.partition(values, -top)[-top]) if len(values) >= top else 0


def indexed(
    segments: DataFrame,
    items: Items,
    weights: np.ndarray,
    pairs: tuple[np.ndarray, np.ndarray],
    n: int,
    total: int,
    top: int,
) -> DataFrame:
    """Segments with impacts, greatest impacts by block, and the pairs' intersection lists.

    A last row of each task has `floors` instead: for each item a score that `top`
    documents reach for certain, because they hold one of its terms or pairs so often.
    """
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    a, b = pairs
    numbers = {p: i for i, p in enumerate(zip(a.tolist(), b.tolist()))}
    own_pairs = [_own_pairs(t, numbers) for t in items.terms]
    last = len(weights) - 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_term, by_pair = np.zeros(last + 1, np.int64), np.zeros(len(a), np.int64)
        doc_kind = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in POSTINGS}
                segment = Segment(row, last)
                impacts = segment.impacts(np.frombuffer(row["tf"], np.int64), weights, n, total)
                at, block, best = segment.block_best(impacts)
                for t, start, end in zip(
                    segment.terms.tolist(), [0, *segment.ends[:-1].tolist()], segment.ends.tolist()
                ):
                    by_term[t] = max(by_term[t], _tenth(impacts[start:end], top))
                which, blocks, joints = [], [], []
                for pair, docs, joint in segment.joint(a, b, impacts):
                    by_pair[pair] = max(by_pair[pair], _tenth(joint, top))
                    first = np.flatnonzero(np.diff(docs // BLOCK, prepend=-1))
                    which.append(np.full(len(first), pair))
                    blocks.append(docs[first] // BLOCK)
                    joints.append(np.maximum.reduceat(joint, first))
                none = [np.zeros(0, np.int64)]
                ids = batch.column("doc_ids")[i].values
                doc_kind = ids.type
                yield _row(
                    {
                        **{c: row[c] for c in ("lengths", "terms", "ends", "docs")},
                        "impacts": _blob(impacts, np.int64),
                        "best_at": _blob(at, np.int32),
                        "best_block": _blob(block, np.uint8),
                        "best": _blob(best, np.int64),
                        "pairs": _blob(np.concatenate(which or none), np.int32),
                        "pair_block": _blob(np.concatenate(blocks or none), np.uint8),
                        "joint": _blob(np.concatenate(joints or none), np.int64),
                        "floors": b"",
                    },
                    ids,
                )
        if doc_kind is not None:
            floors = [
                max(by_term[t].max(initial=0), by_pair[p].max(initial=0))
                for t, p in zip(items.terms, own_pairs)
            ]
            yield _row(
                {**dict.fromkeys(INDEX, b""), "floors": _blob(np.array(floors), np.int64)},
                pa.array([], doc_kind),
            )

    columns = ", ".join(f"{name} {t}" for name, t in INDEX.items())
    return segments.mapInArrow(index, f"doc_ids array<{kind}>, {columns}, floors binary")


def _own_pairs(terms: np.ndarray, numbers: dict[tuple[int, int], int]) -> np.ndarray:
    """The numbers of all pairs of an item's terms that have a list."""
    own = sorted(terms.tolist())
    if len(own) ** 2 < len(numbers):
        tries = ((x, y) for i, x in enumerate(own) for y in own[i + 1 :])
        found = [numbers[p] for p in tries if p in numbers]
    else:
        held = set(own)
        found = [i for (x, y), i in numbers.items() if x in held and y in held]
    return np.array(found, np.int64)


class Searcher:
    """Searches a segment for items; `floors` are scores that count at least."""

    def __init__(
        self, row: dict, items: Items, pairs: tuple[np.ndarray, np.ndarray], last: int
    ) -> None:
        self.segment = Segment(row, last)
        self.impacts = np.frombuffer(row["impacts"], np.int64)
        self.items, self.a, self.b = items, *pairs
        blocks = self.segment.blocks
        place = np.full(last + 1, -1)
        place[self.segment.terms] = np.arange(len(self.segment.terms))
        self.place = place
        # One more row, of zeros, for what doesn't occur here.
        self.best = np.zeros((len(self.segment.terms) + 1, blocks), np.int64)
        at = np.frombuffer(row["best_at"], np.int32)
        self.best[at, np.frombuffer(row["best_block"], np.uint8)] = np.frombuffer(row["best"], np.int64)
        which = np.frombuffer(row["pairs"], np.int32)
        self.pair_row = np.full(len(self.a) + 1, -1)
        met = np.unique(which)
        self.pair_row[met] = np.arange(len(met))
        self.joint = np.zeros((len(met) + 1, blocks), np.int64)
        self.joint[self.pair_row[which], np.frombuffer(row["pair_block"], np.uint8)] = np.frombuffer(
            row["joint"], np.int64
        )

    def bounds(self, terms: np.ndarray, own_pairs: np.ndarray) -> np.ndarray:
        """For each number of first terms and each block what these terms can add together.

        Terms come in ascending order of their greatest impact. A term joins the earlier,
        unmatched partner with which the joint maximum saves most.
        """
        best = self.best[self.place[terms]]
        rank = {t: i for i, t in enumerate(terms.tolist())}
        partners: dict[int, list[tuple[int, np.ndarray]]] = {}
        for pair in own_pairs.tolist():
            i, j = rank.get(int(self.a[pair])), rank.get(int(self.b[pair]))
            if i is None or j is None:
                continue
            i, j = min(i, j), max(i, j)
            together = np.maximum(self.joint[self.pair_row[pair]], np.maximum(best[i], best[j]))
            partners.setdefault(j, []).append((i, best[i] + best[j] - together))
        out = np.zeros((len(terms) + 1, best.shape[1]), np.int64)
        matched: set[int] = set()
        for j in range(len(terms)):
            out[j + 1] = out[j] + best[j]
            open_ = [(i, saved) for i, saved in partners.get(j, ()) if i not in matched]
            if open_:
                i, saved = max(open_, key=lambda p: int(p[1].sum()))
                out[j + 1] -= saved
                matched.update((i, j))
        return out

    def search(
        self, terms: np.ndarray, own_pairs: np.ndarray, floor: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """(documents' places, scores) of all documents that score `floor` or more, and 1."""
        segment, floor = self.segment, max(floor, 1)
        none = np.zeros(0, np.int64)
        terms = terms[self.place[terms] >= 0]
        if not len(terms):
            return none, none
        terms = terms[np.argsort(self.best[self.place[terms]].max(axis=1), kind="stable")]
        bounds = self.bounds(terms, own_pairs)
        alive = bounds[-1] >= floor
        if not alive.any():
            return none, none
        # Documents with none but the first `skipped` terms stay under the floor.
        skipped = int(np.flatnonzero((bounds[:, alive] < floor).all(axis=1))[-1])
        score = np.zeros(len(segment.lengths), np.int64)
        for t in terms[skipped:].tolist():
            span = slice(segment.begin[t], segment.end[t])
            score[segment.docs[span]] += self.impacts[span]
        block = np.arange(len(score)) // BLOCK
        found = np.flatnonzero((score > 0) & (score + bounds[skipped][block] >= floor) & alive[block])
        where = np.zeros(len(score), bool)
        for k in range(skipped - 1, -1, -1):
            if not len(found):
                break
            t = int(terms[k])
            span = slice(segment.begin[t], segment.end[t])
            docs = segment.docs[span]
            where[:] = False
            where[found] = True
            some = where[docs]
            score[docs[some]] += self.impacts[span][some]
            found = found[score[found] + bounds[k][found // BLOCK] >= floor]
        return found, score[found]


def _order(pair: tuple) -> tuple:
    """Highest scores first, equal ones by id, rows without an id last."""
    score, doc_id = pair
    return (-score, doc_id is None, doc_id if doc_id is not None else 0)


def found(
    index: DataFrame,
    items: Items,
    pairs: tuple[np.ndarray, np.ndarray],
    floors: np.ndarray,
    last: int,
    top: int,
) -> DataFrame:
    """Each task's best documents of every item: item (its place), score, doc_id."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    numbers = {p: i for i, p in enumerate(zip(pairs[0].tolist(), pairs[1].tolist()))}
    own_pairs = [_own_pairs(t, numbers) for t in items.terms]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items.ids]
        own_floors, doc_kind = floors.copy(), None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in INDEX}
                searcher = Searcher(row, items, pairs, last)
                ids = batch.column("doc_ids")[i].values
                doc_kind = ids.type
                for q, terms in enumerate(items.terms):
                    docs, scores = searcher.search(terms, own_pairs[q], int(own_floors[q]))
                    if len(docs) > top:  # all that tie with the last of the best stay
                        some = scores >= _tenth(scores, top)
                        docs, scores = docs[some], scores[some]
                    if len(docs):
                        named = ids.take(pa.array(docs)).to_pylist()
                        best[q] = sorted([*best[q], *zip(scores.tolist(), named)], key=_order)[:top]
                        if len(best[q]) == top:
                            own_floors[q] = max(own_floors[q], best[q][-1][0])
        if doc_kind is not None:
            rows = [(q, score, doc) for q, held in enumerate(best) for score, doc in held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], doc_kind),
                ],
                names=["item", "score", "doc_id"],
            )

    return index.drop("floors").mapInArrow(search, f"item int, score long, doc_id {kind}")


def _search_block(rows: DataFrame, items: Items, top: int, segment_docs: int) -> DataFrame | None:
    """The best documents of these items: item, rank, doc_id, score; None without documents."""
    segments = stored(
        postings(rows, items.numbers, segment_docs), "segments", maxRecordsPerFile=SEGMENTS_IN_FILE
    )
    n, total = segments.agg(F.sum("n_docs"), F.sum("n_words")).first()
    if not n:
        return None
    last = len(items.numbers)
    df = np.zeros(last + 1, np.int64)
    for term, many in _document_counts(segments).collect():
        df[term] = many
    weights = weights_of(df, n)
    pairs = pairs_of(items, weights)
    index = stored(
        indexed(segments, items, weights, pairs, n, total, top),
        "index",
        maxRecordsPerFile=SEGMENTS_IN_FILE,
    )
    floors = np.zeros(len(items.ids), np.int64)
    filled = index.where(F.octet_length("floors") > 0).select("floors")
    for item, floor in _greatest(filled).collect():
        floors[item] = floor
    index = index.where(F.octet_length("floors") == 0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found(index, items, pairs, floors, last, top).withColumn(
        "rank", F.row_number().over(order)
    )
    return ranked.where(F.col("rank") <= top)


def _document_counts(segments: DataFrame) -> DataFrame:
    """How many documents hold a term: (term, many), a row for each term of the items."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch.column("terms"), batch.column("ends")):
                many = np.diff(np.frombuffer(ends.as_py(), np.int64), prepend=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(terms.as_py(), np.int32)), pa.array(many)],
                    names=["term", "many"],
                )

    counted = segments.select("terms", "ends").mapInArrow(count, "term int, many long")
    return counted.groupBy("term").agg(F.sum("many").alias("many"))


def _greatest(filled: DataFrame) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("floors"):
                floors = np.frombuffer(row.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(floors), dtype=np.int32)), pa.array(floors)],
                    names=["item", "floor"],
                )

    return filled.mapInArrow(spread, "item int, floor long").groupBy("item").agg(
        F.max("floor").alias("floor")
    )


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    segment_docs: int = SEGMENT_DOCS,
    items_at_once: int = ITEMS_AT_ONCE,
    terms_at_once: int = TERMS_AT_ONCE,
) -> DataFrame:
    """The `top` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters or digits and characters beyond ASCII, A-Z
    lower-cased. With N documents that have a term, L terms in all of them, n in one, df
    documents holding a term and tf its occurrences in one, a term weighs
    floor(1000 ln((2N + 2) / (2df + 1))) and adds weight * (10^9 tf div (1000 tf + 8m)),
    m = 10 + (90nN div L), in whole numbers, once for each different term of the item.
    Documents that score 0 are not returned. Equal scores come by ascending doc_id, rows
    without an id last.

    Null and empty texts have no terms: such a document is never found, such an item
    finds nothing. Each row of `docs` is a document of its own and each row of `items`
    an item of its own, repeated ones too. Empty tables give an empty result; other
    columns are not read.

    Items go to the executors, and their terms' counts to the driver, in blocks of
    `items_at_once` items and `terms_at_once` terms (or one item, if it has more); each
    block is a pass over the documents. Documents are not shuffled: every task builds
    and searches its own segments, and hands on its `top` best of every item.
    """
    if segment_docs > 1 << 16:
        raise ValueError("a segment holds at most 65,536 documents")
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_kind = items.schema[item_id_col].dataType.simpleString()
    doc_kind = rows.schema["doc_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    for block in _blocks_of_items(items, item_id_col, item_text_col, items_at_once, terms_at_once):
        ranked = _search_block(rows, block, top, segment_docs)
        if ranked is None:
            continue
        named = spark.createDataFrame(
            list(enumerate(block.ids)), f"item_no int, item_id {item_kind}"
        )
        # One row for each item of the block, which is bounded.
        result = result.union(
            ranked.join(F.broadcast(named), F.col("item") == F.col("item_no")).select(
                "item_id", "rank", "doc_id", "score"
            )
        )
    return result
