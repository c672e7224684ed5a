"""Boosted trees of many fits side by side, over one table of counted bins.

Spark ML grows the trees of a fit one after another, by jobs over all rows. That is right
for one fit over many rows; cross-validating a calibrated classifier is nineteen fits, most
of which differ only in the rows that they leave out. Here all labelled rows are filled and
binned once. Rows with the same bins, label and fold are one counted row, a cell; a row's
place in its class by hash decides all its folds. Every ensemble is one task, which reads
the cells as a stream from Spark: neither rows nor cells pass through the driver. A tree
draws each row by itself, also within a cell. Scoring runs over all rows, batch by batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.operators import models
from pacewise.operators.ranks import exact_quantiles_of, hash_position
from pacewise.operators.split import target_bins
from pacewise.operators.trees import BINS, Trees, binned, paired
from pacewise.session import kept, ship_package
from pacewise.sources import schemas as S

#: Rows that a step of growing takes at a time.
ROWS_AT_ONCE = 32_768
#: Bins of 32 that fit one number of 64 bits.
BINS_PER_WORD = 12
#: Cells that travel as one row.
CELLS_AT_ONCE = 100_000
CELL_PARTS = "word binary, y binary, slot binary, n binary"
#: Added to a node's second derivatives; a child has at least as many.
SHRINK = LEAST_WEIGHT = 1.0


def _drawn(rng: np.random.Generator, copies: np.ndarray | None, several: np.ndarray, n: int) -> np.ndarray:
    """Of each row's copies how many a tree sees; every copy is drawn by itself."""
    seen = (rng.random(n) < models.ROW_SHARE).astype(float)
    if len(several):
        seen[several] = rng.binomial(copies[several], models.ROW_SHARE)
    return seen


def _by_bin(codes: list[np.ndarray], node: np.ndarray, sums: list[np.ndarray], nodes: int, width: int) -> list[np.ndarray]:
    """Each of the sums by node, feature and bin; features are counted two at a time."""
    cells = nodes * BINS * BINS
    out = [np.zeros((nodes, len(codes) * 2, BINS)) for _ in sums]
    for i, code in enumerate(codes):
        both = [np.zeros(cells) for _ in sums]
        for a in range(0, len(node), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            keys = node[part].astype(np.int64) * (BINS * BINS) + code[part]
            for total, x in zip(both, sums):
                total += np.bincount(keys, x[part], cells)
        for total, by_bin in zip(both, out):
            square = total.reshape(nodes, BINS, BINS)
            by_bin[:, 2 * i], by_bin[:, 2 * i + 1] = square.sum(axis=2), square.sum(axis=1)
    return [by_bin[:, :width] for by_bin in out]


def _down(bins: np.ndarray, node: np.ndarray, feature: np.ndarray, last: np.ndarray) -> None:
    """Move rows from the nodes of a level to those of the next, in place."""
    width = bins.shape[1]
    for a in range(0, len(node), ROWS_AT_ONCE):
        part = slice(a, a + ROWS_AT_ONCE)
        own = node[part]
        at = np.arange(len(own)) * width + feature[own]
        node[part] = 2 * own + (bins[part].ravel().take(at) > last[own])


def grow(
    bins: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int, risk: bool, seed: int,
    copies: np.ndarray | None = None,
) -> Trees:
    """Fit trees to a 0/1 label by its log-odds, or to a number by squares.

    A row stands for as many equal ones as `copies` says.
    """
    n, width = bins.shape
    rng = np.random.default_rng(seed)
    all_weight = weight if copies is None else weight * copies
    mean = float(np.average(y, weights=all_weight)) if n else 0.0
    share = min(max(mean, 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share))) if risk else mean
    inner, leaves = (1 << models.DEPTH) - 1, 1 << models.DEPTH
    feature = np.zeros((trees, inner), np.int64)
    last = np.full((trees, inner), BINS, np.int64)
    value, gain = np.zeros((trees, leaves)), np.zeros(width)
    raw, some = np.full(n, start), max(1, int(np.ceil(float(models.COLUMN_SHARE) * width)))
    bins = np.ascontiguousarray(bins, np.uint8)
    codes = paired(bins)
    several = np.flatnonzero(copies > 1) if copies is not None else np.zeros(0, np.int64)
    for t in range(trees):
        seen = _drawn(rng, copies, several, n) * weight
        p = 1 / (1 + np.exp(-raw)) if risk else raw
        slope = seen * (p - y)
        curve = seen * p * (1 - p) if risk else seen
        columns = np.sort(rng.permutation(width)[:some])
        node = np.zeros(n, np.uint8)
        for level in range(models.DEPTH):
            nodes = 1 << level
            sums = [s[:, columns] for s in _by_bin(codes, node, [slope, curve], nodes, width)]
            left = [s.cumsum(axis=2) for s in sums]
            right = [s[:, :, -1:] - s for s in left]
            score = sum(g * g / (h + SHRINK) for g, h in (left, right))
            whole = left[0][:, :, -1:] ** 2 / (left[1][:, :, -1:] + SHRINK)
            won = np.where((left[1] >= LEAST_WEIGHT) & (right[1] >= LEAST_WEIGHT), score - whole, 0)
            best = won.reshape(nodes, -1).argmax(axis=1)
            most = won.reshape(nodes, -1).max(axis=1)
            at = np.arange(nodes) + nodes - 1
            split = most > 1e-12
            feature[t, at] = columns[best // BINS]
            last[t, at] = np.where(split, best % BINS, BINS)
            np.add.at(gain, feature[t, at][split], most[split])
            _down(bins, node, feature[t, at], last[t, at])
        g, h = np.bincount(node, slope, leaves), np.bincount(node, curve, leaves)
        value[t] = -models.STEP * g / (h + SHRINK)
        raw += value[t][node]
    return Trees(start, feature, last, value, gain)


def isotonic(
    x: np.ndarray, y: np.ndarray, copies: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step means of y over x, as points to interpolate between."""
    copies = np.ones(len(x)) if copies is None else copies
    xs, inverse = np.unique(x, return_inverse=True)
    counts = np.bincount(inverse, copies)
    means = np.bincount(inverse, y * copies) / counts
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i, (m, w) in enumerate(zip(means, counts)):
        blocks.append([m, float(w), i, i])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, end = blocks.pop()
            b = blocks[-1]
            blocks[-1] = [(b[0] * b[1] + m2 * w2) / (b[1] + w2), b[1] + w2, b[2], end]
    keep, level = [], []
    for m, _, a, b in blocks:
        for i in sorted({int(a), int(b)}):
            keep.append(i)
            level.append(m)
    return xs[keep], np.array(level)


def area(y: np.ndarray, score: np.ndarray, copies: np.ndarray | None = None) -> float | None:
    """AUC, ties counting half; None where a class is missing."""
    copies = np.ones(len(y)) if copies is None else copies
    pos, neg = float(copies[y == 1].sum()), float(copies[y != 1].sum())
    if not pos or not neg:
        return None
    _, inverse = np.unique(score, return_inverse=True)
    lost = np.bincount(inverse, copies * (y != 1))
    won = np.cumsum(lost) - lost / 2
    return float((won[inverse] * copies)[y == 1].sum() / (pos * neg))


@dataclass
class BoostedModel(models._Saved):
    """Ensembles over the same bins, with a curve each where they say a probability."""

    features: list[str]
    medians: list[float]
    edges: list[list[float]]
    parts: list[Trees]
    curves: list[tuple[np.ndarray, np.ndarray]]
    risk: bool = False
    info: dict = field(default_factory=dict)

    def score(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for i, trees in enumerate(self.parts):
            raw = trees.raw(bins)
            if self.curves:
                raw = np.interp(raw, *self.curves[i])
            elif self.risk:
                raw = 1 / (1 + np.exp(-raw))
            out += raw / len(self.parts)
        return np.clip(out, 0, 1) if self.risk else out

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Add the score of every row, in batches; `out` is a double."""
        features, model = self.features, self
        ship_package(df.sparkSession)

        @F.pandas_udf("double")
        def score(columns: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in columns:
                yield pd.Series(model.score(binned(batch.to_numpy(float), model.medians, model.edges)))

        numbers = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
        return df.withColumn(out, score(numbers))

    def stages(self) -> dict:
        return {}

    def facts(self) -> dict:
        held = {k: getattr(self, k) for k in ("features", "medians", "edges", "risk", "info")}
        curves = [[x.tolist(), y.tolist()] for x, y in self.curves]
        return held | {"kind": "BoostedModel", "parts": [t.facts() for t in self.parts], "curves": curves}

    @classmethod
    def restored(cls, path: str, facts: dict) -> BoostedModel:
        curves = [(np.array(x), np.array(y)) for x, y in facts["curves"]]
        parts = [Trees.restored(t) for t in facts["parts"]]
        return cls(facts["features"], facts["medians"], facts["edges"], parts, curves, facts["risk"], facts["info"])


@dataclass
class Cells:
    """Counted rows of bins, label and slot, in an order of their own.

    A slot is a row's place among those of its class, modulo the number of slots: all that
    decides the folds.
    """

    features: list[str]
    medians: list[float]
    edges: list[list[float]]
    bins: np.ndarray
    y: np.ndarray
    slot: np.ndarray
    n: np.ndarray

    def within(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bins, labels and counts of some cells; those that differ by slot alone are one."""
        some = np.flatnonzero(mask)
        if not len(some):
            return self.bins[some], self.y[some], self.n[some]
        bins, y = self.bins[some], self.y[some]
        new = np.ones(len(some), bool)
        new[1:] = (y[1:] != y[:-1]) | (bins[1:] != bins[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        return bins[first], y[first], np.add.reduceat(self.n[some], first)


@dataclass
class Binned:
    """The cells of all labelled rows as a table of parts, and how its bins came about."""

    features: list[str]
    medians: list[float]
    edges: list[list[float]]
    slots: int
    rows: int
    parts: DataFrame


def _words(width: int) -> list[str]:
    return [f"_word{i}" for i in range(-(-width // BINS_PER_WORD))]


def counted(
    df: DataFrame, features: list[str], label: str, risk: bool, slots: int, most_rows: int | None = None
) -> Binned:
    """The rows that fits see; classes are the label, or the quartiles of a number.

    Rows without the label are left out. All others are used, unless the caller wants no
    more than about `most_rows`: these are chosen by a hash of the row, the same in every
    run.
    """
    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y")
    )
    if most_rows:
        share = min(1.0, most_rows / max(rows.count(), 1))
        place = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 60))
        rows = rows.where(place < F.lit(int(share * (1 << 60))))
    rows = kept(rows)
    probs = [i / BINS for i in range(1, BINS)]
    found = {r.column_name: r.quantiles for r in exact_quantiles_of(rows, features, probs).collect()}
    edges = [sorted(set(found[f] or [])) for f in features]
    medians = [found[f][BINS // 2 - 1] if found[f] else 0.0 for f in features]
    classed = rows if risk else target_bins(rows, "_y", "_bin")
    placed = hash_position(classed, rows.columns, ["_y" if risk else "_bin"])
    placed = placed.select(*features, "_y", F.pmod("position", F.lit(slots)).cast("int").alias("_slot"))
    same = placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("_n"))
    words = _words(len(features))
    ship_package(df.sparkSession)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = binned(batch[features].to_numpy(float), medians, edges).astype(np.int64)
            out = {
                w: reduce(lambda a, b: a * BINS + b, bins[:, i * BINS_PER_WORD : (i + 1) * BINS_PER_WORD].T)
                for i, w in enumerate(words)
            }
            yield pd.DataFrame(out | {c: batch[c] for c in ("_y", "_slot", "_n")})

    keys = [*words, "_y", "_slot"]
    schema = ", ".join(f"{w} bigint" for w in words) + ", _y double, _slot int, _n bigint"
    cells = same.mapInPandas(packed, schema).groupBy(*keys).agg(F.sum("_n").alias("_n"))

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), CELLS_AT_ONCE):
                part = batch.iloc[a : a + CELLS_AT_ONCE]
                held = [part[words].to_numpy(np.int64), part["_y"].to_numpy(float)]
                held += [part["_slot"].to_numpy(np.int32), part["_n"].to_numpy(np.int64)]
                yield pd.DataFrame([[x.tobytes() for x in held]], columns=["word", "y", "slot", "n"])

    parts = kept(cells.mapInPandas(together, CELL_PARTS))
    return Binned(features, medians, edges, slots, rows.count(), parts)


def _cells(facts: dict, parts: list[list[bytes]]) -> Cells:
    """The parts as one, in the order of bins, label and slot."""
    width = len(facts["features"])
    words, y, slot, n = (
        np.concatenate([np.zeros(0, kind)] + [np.frombuffer(p[i], kind) for p in parts])
        for i, kind in enumerate((np.int64, float, np.int32, np.int64))
    )
    words = words.reshape(len(y), -1) if len(y) else np.zeros((0, 1), np.int64)
    order = np.lexsort((slot, y, *words.T[::-1]))
    bins = np.empty((len(y), width), np.uint8)
    for j in range(width):
        i, k = divmod(j, BINS_PER_WORD)
        after = min(BINS_PER_WORD, width - i * BINS_PER_WORD) - 1 - k
        bins[:, j] = (words[order, i] // BINS**after) % BINS
    return Cells(facts["features"], facts["medians"], facts["edges"], bins, y[order], slot[order], n[order])


def _inner_place(place: np.ndarray, fold: int, k: int) -> np.ndarray:
    """Places among the rows of a class that are not in the fold."""
    return place - (place - fold + k - 1) // k


def _weights(y: np.ndarray, pos_weight: float) -> np.ndarray:
    return np.where(y == 1, pos_weight, 1.0)


def _calibrated(c: Cells, rows: np.ndarray, place: np.ndarray, job: dict) -> BoostedModel:
    """`rows` says which cells are fitted on, `place` where they stand among these."""
    parts, curves = [], []
    for j in range(models.CALIBRATION_FOLDS):
        here = place % models.CALIBRATION_FOLDS == j
        bins, y, n = c.within(rows & ~here)
        fit = grow(bins, y, _weights(y, job["pos_weight"]), job["trees"], True, S.SEED + j, n)
        parts.append(fit)
        bins, y, n = c.within(rows & here)
        curves.append(isotonic(fit.raw(bins), y, n) if len(y) else (np.zeros(1), np.zeros(1)))
    return BoostedModel(c.features, c.medians, c.edges, parts, curves, True)


def _fit(c: Cells, job: dict) -> dict:
    """One ensemble: the model itself, or what it says of the fold that it left out."""
    fold, k = job["fold"], job["cv_folds"]
    held = c.slot % k == fold if fold >= 0 else np.zeros(len(c.y), bool)
    if job["what"] == "risk":
        place = _inner_place(c.slot, fold, k) if fold >= 0 else c.slot
        model = _calibrated(c, ~held, place, job)
    else:
        risk = job["what"] == "plain"
        bins, y, n = c.within(~held)
        fit = grow(bins, y, _weights(y, job["pos_weight"]), job["trees"], risk, S.SEED, n)
        model = BoostedModel(c.features, c.medians, c.edges, [fit], [], risk)
    if fold < 0:
        return model.facts()
    bins, y, n = c.within(held)
    score = model.score(bins)
    if job["what"] == "risk":
        return {"auc": area(y, score, n)}
    if not len(y):
        return {"mae": None, "r2": None}
    spread = float((n * (y - np.average(y, weights=n)) ** 2).sum())
    r2 = 1 - float((n * (y - score) ** 2).sum()) / spread if spread else None
    return {"mae": float(np.average(np.abs(y - score), weights=n)), "r2": r2}


def side_by_side(spark: SparkSession, s: Binned, jobs: list[dict]) -> list[dict]:
    """The outcome of every job, each grown in a task of its own over the same cells."""
    ship_package(spark)
    facts = {"features": s.features, "medians": s.medians, "edges": s.edges}
    texts = [json.dumps(j) for j in jobs]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[list[bytes]]] = {}
        for batch in batches:
            for number, *part in batch[["number", "word", "y", "slot", "n"]].itertuples(index=False):
                # Every job has one row without cells, should there be none.
                held.setdefault(number, []).extend([part] if part[0] is not None else [])
        for number in sorted(held):
            outcome = json.dumps(_fit(_cells(facts, held.pop(number)), json.loads(texts[number])))
            yield pd.DataFrame({"number": [number], "outcome": [outcome]})

    number = F.explode(F.array(*[F.lit(i) for i in range(len(jobs))])).alias("number")
    empty = spark.createDataFrame([(None,) * 4], CELL_PARTS)
    rows = s.parts.unionByName(empty).select(number, "*")
    # One job a task.
    ran = rows.repartitionById(len(jobs), "number").mapInPandas(run, "number int, outcome string")
    found = {r.number: json.loads(r.outcome) for r in ran.collect()}
    return [found[i] for i in range(len(jobs))]


def _gains(facts: dict) -> dict[str, float]:
    gain = np.sum([t["gain"] for t in facts["parts"]], axis=0)
    total = gain.sum() or 1.0
    return {f: float(g / total) for f, g in zip(facts["features"], gain)}


def fit_one(
    df: DataFrame, features: list[str], label: str, risk: bool, trees: int = models.TREES,
    pos_weight: float = 1.0, most_rows: int | None = None,
) -> tuple[BoostedModel, dict[str, float]]:
    """A plain classifier or regression, and its importances: each feature's share of gain."""
    s = counted(df, features, label, risk, 1, most_rows)
    job = {"what": "plain" if risk else "rate", "trees": trees, "pos_weight": pos_weight}
    (model,) = side_by_side(df.sparkSession, s, [job | {"cv_folds": 1, "fold": -1}])
    return BoostedModel.restored("", model), _gains(model)


def fit_risk(
    df: DataFrame, features: list[str], label: str, trees: int = models.TREES, pos_weight: float = 1.0,
    cv_folds: int = models.CV_FOLDS, most_rows: int | None = None,
) -> tuple[BoostedModel, dict]:
    """A calibrated classifier, its cross-validated AUC and the plain fit's importances."""
    s = counted(df, features, label, True, cv_folds * models.CALIBRATION_FOLDS, most_rows)
    job = {"what": "risk", "trees": trees, "pos_weight": pos_weight, "cv_folds": cv_folds}
    jobs = [job | {"fold": k} for k in range(-1, cv_folds)] + [job | {"what": "plain", "fold": -1}]
    model, *folds, plain = side_by_side(df.sparkSession, s, jobs)
    aucs = [f["auc"] for f in folds if f["auc"] is not None]
    info = {
        "cv_auc_mean": float(np.mean(aucs)) if aucs else float("nan"),
        "cv_auc_std": float(np.std(aucs)) if aucs else float("nan"),
        "folds": len(aucs),
        "importances": _gains(plain),
        "rows_fitted": s.rows,
    }
    return BoostedModel.restored("", model), info


def fit_rate(
    df: DataFrame, features: list[str], target: str, trees: int = models.TREES,
    cv_folds: int = models.CV_FOLDS, most_rows: int | None = None,
) -> tuple[BoostedModel, dict]:
    """A regression, its cross-validated errors and its importances."""
    s = counted(df, features, target, False, cv_folds, most_rows)
    job = {"what": "rate", "trees": trees, "pos_weight": 1.0, "cv_folds": cv_folds}
    model, *folds = side_by_side(df.sparkSession, s, [job | {"fold": k} for k in range(-1, cv_folds)])
    maes = [f["mae"] for f in folds if f["mae"] is not None]
    r2s = [f["r2"] for f in folds if f["r2"] is not None]
    info = {
        name: float(f(values)) if values else float("nan")
        for name, f, values in (
            ("cv_r2_mean", np.mean, r2s), ("cv_r2_std", np.std, r2s),
            ("cv_mae_mean", np.mean, maes), ("cv_mae_std", np.std, maes),
        )
    }
    return BoostedModel.restored("", model), info | {"importances": _gains(model), "rows_fitted": s.rows}
