"""A quality classifier: boosted trees over statistics of the whole text.

The statistics are counts of characters, words and lines, so they need no language and
no vocabulary. A bounded sample of labelled documents is fitted on the driver; the
trees, a few arrays, then score every document where it lies.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.boosting import Trees, fit
from pacewise.llm.store import ship_package

#: About so many labelled rows are fitted; a hash of the id chooses among more.
TRAIN_ROWS = 20_000
CUTOFF = 0.3
#: Documents with this remainder are held out.
FOLDS, HELD_OUT = 5, 0

NAMES = (
    "chars words word_length letters upper digits blanks sentence_marks exclamations bars "
    "symbols others distinct commonest repeats lines repeated_lines line_length short shouted "
    "with_symbol ended longest_word"
).split()

_LETTER, _UPPER, _DIGIT, _BLANK, _SENTENCE, _LOUD, _BAR, _SYMBOL, _OTHER = range(9)


def _classes() -> np.ndarray:
    kinds = np.full(0x250, _OTHER, np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c.isupper():
            kinds[code] = _UPPER
        elif c.isalpha():
            kinds[code] = _LETTER
        elif c.isdigit():
            kinds[code] = _DIGIT
        elif c.isspace():
            kinds[code] = _BLANK
        elif c in ".,;:'\"()-":
            kinds[code] = _SENTENCE
        elif c in "!?":
            kinds[code] = _LOUD
        elif c == "|":
            kinds[code] = _BAR
        elif code < 0x80:
            kinds[code] = _SYMBOL
    return kinds


_KINDS = _classes()


def statistics(text: str) -> list[float]:
    """The values of NAMES for one text; an empty one has zeros."""
    if not text:
        return [0.0] * len(NAMES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = codes < 0x250
    kinds = np.bincount(_KINDS[codes[known]], minlength=9) / len(text)
    # Letters of other scripts count as letters.
    kinds[_LETTER] += 1 - np.count_nonzero(known) / len(text)
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    n, different = len(words), Counter(words)
    some = max(n, 1)
    repeats = sum(map(eq, words, islice(words, 1, None)))
    commonest = max(different.values(), default=0)
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        np.log1p(len(text)),
        np.log1p(n),
        lengths.mean() if n else 0.0,
        kinds[_LETTER] + kinds[_UPPER],
        kinds[_UPPER] / max(kinds[_LETTER] + kinds[_UPPER], 1e-9),
        kinds[_DIGIT],
        kinds[_BLANK],
        kinds[_SENTENCE],
        kinds[_LOUD],
        kinds[_BAR],
        kinds[_SYMBOL],
        kinds[_OTHER],
        np.log1p(len(different)) / np.log1p(some),
        commonest / some,
        repeats / some,
        np.log1p(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)),
        np.count_nonzero(lengths <= 3) / some,
        sum(map(str.isupper, words)) / some,
        sum(not w.isalnum() for w in words) / some,
        sum(w[-1] in ".!?" for w in words) / some,
        np.log1p(lengths.max()) if n else 0.0,
    ]


def features(texts: pd.Series) -> np.ndarray:
    rows = [statistics(t or "") for t in texts]
    return np.array(rows, float).reshape(len(rows), len(NAMES))


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves remainder 0 by 5; null has the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def sample(
    docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """About `rows` labelled training documents: doc_id, label, x.

    Ids whose labels contradict each other are left out, and so are null labels.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .where(~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("labelled_id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
        .where("label = most")
        .select("labelled_id", F.col("label").cast("double").alias("label"))
    )
    share = min(1.0, rows / max(known.count(), 1))
    place = F.pmod(F.xxhash64("labelled_id", F.lit(11)), F.lit(1 << 60))
    chosen = known.where(place < F.lit(int(share * (1 << 60))))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "label": batch["label"], "x": list(features(batch["text"]))}
            )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    # At most about `rows` rows of two numbers, whatever the size of the input.
    chosen = F.broadcast(chosen)
    return (
        texts.join(chosen, F.col("doc_id") == F.col("labelled_id"))
        .select("doc_id", "label", "text")
        .mapInPandas(describe, f"doc_id {kind}, label double, x array<double>")
        .groupBy("doc_id")
        .agg(F.min_by(F.struct("label", "x"), "x").alias("row"))
        .select("doc_id", "row.*")
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Trees:
    """Fit the trees on a sample of about `rows` labelled documents that are not held out."""
    ship_package(docs.sparkSession)
    found = sample(docs, labels, rows, id_col, text_col, label_col).toPandas()
    found = found.sort_values("doc_id")
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(NAMES))
    return fit(x, found["label"].to_numpy(float))


def score(model: Trees, text: Column) -> Column:
    """The model's score, 0 to 1, as a column."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(features(texts)))

    return F.pandas_udf(run, "double")(text)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAIN_ROWS,
    cutoff: float = CUTOFF,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """Score every row: doc_id, held_out, score, predicted.

    Only the whole text is looked at. Null and empty texts have the score of the empty
    text. Repeated rows are scored alike; an empty table gives an empty result; without
    usable labels every score is 0.5. Other columns are not read.
    """
    model = train(docs, labels, rows, id_col, text_col, label_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        score(model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def accepted(
    docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that score `cutoff` or more, all columns."""
    model = train(docs, labels)
    return docs.where(score(model, F.col(text_col)) >= cutoff)
