"""Benchmark decontamination with one Aho-Corasick automaton over the items' windows.

Items and documents are read as words, lower-cased; a window is ten words of an item in
a row. All windows go into one automaton whose letters are words, so a document is
scanned once, whatever the number of windows, and a match never begins or ends within a
word. Matches are mapped back to where their words stand in the document as written.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.llm.store import ship_package
from pacewise.llm.words import WRITTEN, words_of

WINDOW = 10
#: Words of the items in one automaton; more items make more automata.
WORDS_AT_ONCE = 200_000
#: Automata that a worker keeps.
KEPT = 4
#: A word is this many characters to the automaton, each of a few kinds only: the automaton
#: looks through the kinds that can follow one by one.
LETTERS = 3
UNKNOWN = "\0" * LETTERS


def spelled(words: Iterable[bytes]) -> dict[bytes, str]:
    """A spelling for each different word; a place in it has characters of its own.

    So a word's spelling is never found across two others.
    """
    distinct = list(dict.fromkeys(words))
    kinds = 2
    while kinds**LETTERS < len(distinct):
        kinds += 1

    def spelling(number: int) -> str:
        out = []
        for place in range(LETTERS):
            number, kind = divmod(number, kinds)
            out.append(chr(1 + place * kinds + kind))
        return "".join(out)

    return {w: spelling(i) for i, w in enumerate(distinct)}


class Scanner:
    """Finds the windows of items (name, words) in documents."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.names = [name for name, _ in items]
        self.letters = spelled(w for _, words in items for w in words)
        holders: dict[str, list[int]] = {}
        for i, (_, words) in enumerate(items):
            text = "".join(map(self.letters.__getitem__, words))
            for at in range(max(len(words) - window, 0) + 1 if words else 0):
                held = holders.setdefault(text[at * LETTERS : (at + window) * LETTERS], [])
                if not held or held[-1] != i:
                    held.append(i)
        self.automaton = ahocorasick.Automaton()
        for text, held in holders.items():
            self.automaton.add_word(text, (len(text) // LETTERS, held))
        if holders:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, word behind the last, items) of every occurrence of a window."""
        if not self.letters:
            return
        text = "".join(map(self.letters.get, words, repeat(UNKNOWN)))
        for last, (length, held) in self.automaton.iter(text):
            end = (last + 1) // LETTERS
            yield end - length, end, held


@lru_cache(maxsize=KEPT)
def _scanner(name: str, window: int) -> Scanner:
    with open(SparkFiles.get(name), "rb") as f:
        return Scanner(pickle.load(f), window)


def _share(spark: SparkSession, items: list[tuple[str, list[bytes]]]) -> str:
    folder = tempfile.mkdtemp(prefix="items-", dir=SparkFiles.getRootDirectory())
    path = os.path.join(folder, os.path.basename(folder) + ".bin")
    with open(path, "wb") as f:
        pickle.dump(items, f)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def share_items(
    items: DataFrame, id_col: str, text_col: str, most: int = WORDS_AT_ONCE
) -> list[str]:
    """Give the items to all executors, in files of at most `most` words or one item."""
    names, held, size = [], [], 0
    for row in items.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        words = words_of(row[1])
        if held and size + len(words) > most:
            names.append(_share(items.sparkSession, held))
            held, size = [], 0
        if words:
            held.append((row[0] or "", words))
            size += len(words)
    if held:
        names.append(_share(items.sparkSession, held))
    return names


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """The longest runs of hit words, as (first, last)."""
    edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return [(a, b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


SPANS = "array<struct<begin:long,end:long>>"


def scanned(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    words_at_once: int = WORDS_AT_ONCE,
) -> DataFrame:
    """What every document shares with the items: doc_id, n_words, n_hit, items, spans.

    A word is a run of ASCII letters or digits and characters beyond ASCII, A-Z
    lower-cased. A window is `window` words of an item in a row; an item of fewer words,
    but not none, is one window. A word of a document is hit if it lies in an occurrence
    of any window. `items` are the ids, as texts, of all items with an occurring window,
    sorted and each once; `spans` are the longest runs of hit words as positions of
    characters in the text as it is written, the end behind the last.

    Null and empty texts, and texts of signs alone, have no words. Repeated documents are
    scanned each; repeated items, and items with one id, count once. An item without an
    id goes by the empty text. Without documents the result is empty, without items
    nothing is hit. Other columns are not read.

    The items are split into automata of at most `words_at_once` words, each a file that
    all executors get; memory holds KEPT of them and one batch of documents. Documents
    are not shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    names = share_items(items, item_id_col, item_text_col, words_at_once)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = np.zeros(len(texts), np.int64)
            hits: dict[int, np.ndarray] = {}
            found: dict[int, set[str]] = {}
            for turn, name in enumerate(names):
                scanner = _scanner(name, window)
                for i, text in enumerate(texts):
                    words = words_of(text)
                    sizes[i] = len(words)
                    for begin, end, held in scanner.scan(words):
                        if i not in hits:
                            hits[i] = np.zeros(len(words), bool)
                        hits[i][begin:end] = True
                        found.setdefault(i, set()).update(scanner.names[h] for h in held)
            if not names:
                sizes[:] = [len(words_of(t)) for t in texts]
            n_hit = np.zeros(len(texts), np.int64)
            spans: list[list[dict]] = [[] for _ in texts]
            for i, hit in hits.items():
                n_hit[i] = np.count_nonzero(hit)
                at = [m.span() for m in WRITTEN.finditer(texts[i])]
                spans[i] = [{"begin": at[a][0], "end": at[b][1]} for a, b in _runs(hit)]
            ids = [sorted(found.get(i, ())) for i in range(len(texts))]
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(n_hit),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(spans, kind),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans {SPANS}"
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its spans; what stands around them is joined by one space."""
    kept, at = [], 0
    for begin, end in [*spans, (len(text), len(text))]:
        if piece := text[at:begin].strip():
            kept.append(piece)
        at = end
    return " ".join(kept)
