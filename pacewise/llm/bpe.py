"""Encoding and decoding with a byte-pair vocabulary whose words end in `</w>`.

Spark counts the words of all documents. The most frequent are compiled, with their
ids, into the transducer of `lexicon`, which every executor gets as a file and maps
into memory. Documents are encoded batch by batch: each distinct word is looked up
once, and a word that the lexicon lacks is merged exactly, pair by pair. The size of
the lexicon is a matter of speed alone; ids never depend on it.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.llm.lexicon import Lexicon, compile_lexicon
from pacewise.llm.store import ship_package, stored

#: Words in the lexicon, at most this many bytes long; both bound what reaches the driver.
LEXICON_WORDS, LEXICON_BYTES = 131_072, 48
#: Characters taken at a time; what one task counts, and remembers, at most, by words and
#: by characters; of words that have been merged MERGED, and none beyond KEPT_CHARS. Workers
#: keep what they remember while later queries run in them.
SLICE_CHARS, COUNTED_WORDS, REMEMBERED, MERGED = 1_000_000, 250_000, 250_000, 50_000
COUNTED_CHARS, REMEMBERED_CHARS, KEPT_CHARS = 50_000_000, 10_000_000, 256
#: Words of more bytes are merged by a heap instead of by looking for the lowest rank.
SHORT_BYTES = 64

# White space and words of the vocabulary's pre-tokenizer.
WHITE = "\t-\r \x85\xa0  -     　"
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
)
END = "</w>"

ID_BITS = 20
ID_MASK, UNMERGED = (1 << ID_BITS) - 1, 1 << 60

SPLIT = re.compile(f"[{WHITE}]+")
#: Outside of this range the library's own normalizer is asked; str.split() takes the
#: four separators for white space, which they are not here.
UNUSUAL, SEPARATOR = re.compile("[^\x00-ɏ]"), re.compile("[\x1c-\x1f]")


class Vocabulary:
    """Merges, ids and special tokens of a tokenizer file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.normalizer = Tokenizer.from_file(path).normalizer
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.tokens = {i: t for t, i in chain(vocab.items(), self.special.items())}
        letters = _byte_letters(pre_tokenizers.ByteLevel.alphabet())
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.outer = [vocab[letters[b] + END] for b in range(256)]
        # Both of a pair's ids, and a rank with the id that it makes, are packed in one int.
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            self.merges[vocab[left] << ID_BITS | vocab[right]] = rank << ID_BITS | made

    def words_of(self, text: str) -> list:
        """The text between white space, lower-cased; special tokens as their ids."""
        if "<" in text and self.special_split.search(text):
            found, at = [], 0
            for hit in self.special_split.finditer(text):
                found += self.words_of(text[at : hit.start()])
                found.append(self.special[hit[0]])
                at = hit.end()
            return found + self.words_of(text[at:])
        if UNUSUAL.search(text) or SEPARATOR.search(text):
            return [w for w in SPLIT.split(text) if w]
        return text.lower().split()

    def parts_of(self, word: str) -> list[str]:
        """The words that the pre-tokenizer finds in a piece without white space."""
        if UNUSUAL.search(word):
            word = self.normalizer.normalize_str(word)
        else:
            word = word.lower()
        return WORD.findall(word)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the leftmost pair of the lowest rank is merged until none is left."""
        if len(word) > SHORT_BYTES:
            return self.merge_long(word)
        find = self.merges.get
        ids = [self.inner[b] for b in word[:-1]] + [self.outer[word[-1]]]
        ranks = [find(a << ID_BITS | b, UNMERGED) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != UNMERGED:
            i = ranks.index(best)
            made = best & ID_MASK
            ids[i : i + 2] = [made]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = find(made << ID_BITS | ids[i + 1], UNMERGED)
            if i:
                ranks[i - 1] = find(ids[i - 1] << ID_BITS | made, UNMERGED)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same, in time that grows little faster than the word.

        Places are linked, and a heap holds (rank, place) of the pairs that can be merged;
        an entry whose place has gone or makes another pair by now is skipped.
        """
        find = self.merges.get
        ids = [self.inner[b] for b in word[:-1]] + [self.outer[word[-1]]]
        end = len(ids)
        following, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [
            (rank, i)
            for i, (a, b) in enumerate(zip(ids, ids[1:]))
            if (rank := find(a << ID_BITS | b, UNMERGED)) != UNMERGED
        ]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = following[i]
            if ids[i] < 0 or j == end or find(ids[i] << ID_BITS | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank & ID_MASK, -1
            following[i] = after = following[j]
            if after < end:
                before[after] = i
                if (new := find(ids[i] << ID_BITS | ids[after], UNMERGED)) != UNMERGED:
                    heappush(heap, (new, i))
            if (first := before[i]) >= 0:
                if (new := find(ids[first] << ID_BITS | ids[i], UNMERGED)) != UNMERGED:
                    heappush(heap, (new, first))
        return [i for i in ids if i >= 0]


def _byte_letters(alphabet: list[str]) -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100."""
    own = {ord(c) for c in alphabet if ord(c) < 256}
    others = iter(sorted(c for c in alphabet if ord(c) >= 256))
    return [chr(b) if b in own else next(others) for b in range(256)]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _texts(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[str]:
    for batch in batches:
        for text in batch.column(column):
            yield text.as_py() or ""


def count_words(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """How often each word (utf-8 bytes) occurs in all documents: word, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen, chars = _vocabulary(tokenizer), Counter(), 0

        def flush() -> pa.RecordBatch:
            parts = Counter()
            for piece, n in seen.items():
                if isinstance(piece, str):
                    for part in vocabulary.parts_of(piece):
                        parts[part] += n
            seen.clear()
            rows = [(w, n) for p, n in parts.items() if len(w := p.encode()) <= LEXICON_BYTES]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])],
                names=["word", "n"],
            )

        for text in _texts(batches, "text"):
            seen.update(vocabulary.words_of(text))
            chars += len(text)
            if len(seen) > COUNTED_WORDS or chars > COUNTED_CHARS:
                yield flush()
                chars = 0
        if seen:
            yield flush()

    texts = docs.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(count, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = LEXICON_WORDS
) -> str:
    """Compile up to `size` of the most frequent words and give the file to all executors.

    Returns the name under which SparkFiles knows it. Words are taken from a count on
    under which at most `size` words lie, found from how many words have which count, on
    a logarithmic scale; so the driver gets a histogram and then `size` words at most.
    """
    spark = docs.sparkSession
    counts = count_words(docs, tokenizer, text_col).where("n > 1")
    counts = stored(counts.withColumn("scale", F.floor(F.log2("n") * 16)), "words")
    least, room = None, size
    for scale, words in counts.groupBy("scale").count().orderBy(F.desc("scale")).collect():
        if words > room:
            break
        least, room = scale, room - words
    top = counts.where(F.col("scale") >= F.lit(least)).select("word").collect() if least is not None else []
    vocabulary = Vocabulary(tokenizer)
    words = {bytes(r[0]): vocabulary.merge(bytes(r[0])) for r in top}
    return _share(spark, words)


def _share(spark: SparkSession, words: dict[bytes, list[int]]) -> str:
    # Spark serves the file from the driver's own folder of shared files.
    folder = tempfile.mkdtemp(prefix="lexicon-", dir=SparkFiles.getRootDirectory())
    path = os.path.join(folder, os.path.basename(folder) + ".bin")
    compile_lexicon(words, path)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _gather(offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the items of rows `which` lie, one after another, and their new offsets."""
    lengths = offsets[which + 1] - offsets[which]
    ends = np.cumsum(lengths)
    at = np.repeat(offsets[which] - ends + lengths, lengths) + np.arange(lengths.sum())
    return at, np.concatenate([[0], ends])


class Encoder:
    """Encodes slices of documents; remembers the pieces that it met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.merged: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        """Drop all pieces: a row has its ids, between two offsets, and its tokens as text."""
        self.rows: dict = {}
        self.chars = 0
        self.ids, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.shown: list[str] = []

    def words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words as (flat ids, offsets)."""
        raw = [p.encode() for p in parts]
        places = self.lexicon.places(raw)
        own = []
        missing = np.flatnonzero(places < 0)
        for i in missing.tolist():
            ids = self.merged.get(parts[i])
            if ids is None:
                ids = self.vocabulary.merge(raw[i])
                if len(self.merged) >= MERGED:
                    self.merged.clear()
                if len(parts[i]) <= KEPT_CHARS:
                    self.merged[parts[i]] = ids
            own.append(ids)
        # Behind the lexicon's rows stand those of the merged words.
        rows = places.copy()
        rows[missing] = len(self.lexicon.offsets) - 1 + np.arange(len(missing))
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        offsets = np.concatenate(
            [self.lexicon.offsets, self.lexicon.offsets[-1] + np.cumsum(sizes)]
        )
        more = np.fromiter(chain.from_iterable(own), np.int64, int(sizes.sum()))
        at, ends = _gather(offsets, rows)
        known = len(self.lexicon.ids)
        flat = np.empty(len(at), np.int64)
        old = at < known
        flat[old] = self.lexicon.ids[at[old]]
        flat[~old] = more[at[~old] - known]
        return flat, ends

    def learn(self, pieces: list) -> None:
        """Add rows for pieces between white space that have none."""
        parts: dict = {}
        sizes, spread = [], []
        for piece in pieces:
            found = [piece] if isinstance(piece, int) else self.vocabulary.parts_of(piece)
            sizes.append(len(found))
            for part in found:
                spread.append(parts.setdefault(part, len(parts)))
        specials = [(i, p) for p, i in parts.items() if isinstance(p, int)]
        flat, offsets = self.words([p if isinstance(p, str) else "?" for p in parts])
        for i, special in specials:  # `?` is one token, so is a special one
            flat[offsets[i]] = special
        at, part_ends = _gather(offsets, np.array(spread, np.int64))
        ends = part_ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        tokens = self.vocabulary.tokens
        names = [tokens[i] for i in flat[at].tolist()]
        bounds = ends.tolist()
        self.shown += [" ".join(names[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.rows.update(zip(pieces, range(len(self.rows), len(self.rows) + len(pieces))))
        self.chars += sum(len(p) for p in pieces if isinstance(p, str))
        self.ids = np.concatenate([self.ids, flat[at]])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends[1:]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, offsets by text, and the decoded texts."""
        split = [self.vocabulary.words_of(t) for t in texts]
        if len(self.rows) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        new = set(chain.from_iterable(split)).difference(self.rows)
        if new:
            self.learn(list(new))
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        numbers = list(map(self.rows.__getitem__, chain.from_iterable(split)))
        at, ends = _gather(self.offsets, np.array(numbers, np.int64))
        word_ends = np.concatenate([[0], np.cumsum(lengths)])
        starts = word_ends.tolist()
        shown = self.shown.__getitem__
        decoded = [" ".join(map(shown, numbers[a:b])) for a, b in zip(starts, starts[1:])]
        return self.ids[at], ends[word_ends], decoded


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, name: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(_vocabulary(tokenizer), Lexicon(SparkFiles.get(name)))


def _slices(texts: list[str], most: int) -> Iterator[list[str]]:
    held, chars = [], 0
    for text in texts:
        if held and chars + len(text) > most:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """Token ids of every whole text, and what they decode to: doc_id, ids, decoded.

    As the tokenizers library encodes without special tokens around the text; special
    tokens written in it become their ids. Decoding joins the tokens by spaces, as
    this vocabulary has no decoder. Null and empty texts, and texts of white space
    alone, have no ids and decode to the empty text. Each row is one result, repeated
    ones too; an empty table gives an empty result; other columns are not read.
    `tokenizer` is the file's path on every executor. Memory holds SLICE_CHARS
    characters, or one text if that is longer, and REMEMBERED_CHARS of earlier pieces.
    """
    ship_package(docs.sparkSession)
    name = build_lexicon(docs, tokenizer, text_col, lexicon_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, name)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            for part in _slices(texts, SLICE_CHARS):
                ids, offsets, decoded = encoder.encode(part)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), lists, pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )
                at += len(part)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
