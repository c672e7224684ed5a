"""Compression of vectors to codes by product quantisation in whole numbers.

Components become integers, vectors are cut into parts, and each part position has a
codebook. Assigning parts to their nearest entries keeps Drake and Hamerly's bounds:
each part stores its `b` closest entries in order, an upper bound for the first, lower
bounds for the others and one outer bound for all that are not listed. After entries
have moved, the bounds move with them; where the first entry is still nearest by its
bounds nothing is computed, and where it is not certain, integer distances decide, over
as many of the listed entries as the bounds leave open, or over all. `b` adapts from
round to round to how many entries were asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.llm.store import ship_package, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries that a part lists: at first, at least and at most.
FIRST, LEAST, MOST = 8, 4, 32
#: `b` covers what all but this share of the parts ask for.
BEYOND = 0.02
#: Integer components are smaller than this, so that squared distances fit 64 bits.
LARGEST = 1 << 24
#: Marks places of a list that hold no entry.
NONE = 255


def edges(dims: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; equal ones if `parts` divides `dims`."""
    return [dims * p // parts for p in range(parts + 1)]


@dataclass
class Codebooks:
    """For each part position the entries as rows of integers."""

    dims: int
    entries: list[np.ndarray]

    @property
    def size(self) -> int:
        return len(self.entries[0])

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, in decimal, comma-joined."""
        text = ",".join(str(x) for e in self.entries for x in e.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to integer entries, exact."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * x.shape[1] * int(top) ** 2 < 1 << 53:
        # Whole numbers of this size are added in doubles without loss.
        a, b = x.astype(np.float64), entries.astype(np.float64)
        apart = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return apart.astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[None, :, j]) ** 2
    return out


def listed(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The `b` nearest entries of each row, ties to the lower index, and their bounds."""
    apart = squared(x, entries)
    order = np.argsort(apart, axis=1, kind="stable")
    ranked = np.sqrt(np.take_along_axis(apart, order[:, : b + 1], axis=1))
    near = np.full((len(x), b), NONE, np.uint8)
    bounds = np.full((len(x), b + 1), np.inf)
    held = min(b, len(entries))
    near[:, :held] = order[:, :held]
    bounds[:, : ranked.shape[1]] = ranked
    return near, bounds


def resized(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of `b` entries; those that no longer fit are covered by the outer bound."""
    old = near.shape[1]
    if b <= old:
        outer = bounds[:, b:].min(axis=1, keepdims=True)
        return near[:, :b], np.concatenate([bounds[:, :b], outer], axis=1)
    more = np.full((len(near), b - old), NONE, np.uint8)
    wide = np.repeat(bounds[:, -1:], b - old, axis=1)
    return np.concatenate([near, more], axis=1), np.concatenate([bounds, wide], axis=1)


def reassigned(
    x: np.ndarray,
    near: np.ndarray,
    bounds: np.ndarray,
    moves: np.ndarray,
    entries: np.ndarray,
    b: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists and bounds after the entries have moved, and how many entries each row asked for.

    bounds[:, 0] is over the distance to near[:, 0], bounds[:, z] under that to near[:, z],
    and the last one under those to all entries that aren't listed.
    """
    by_entry = np.zeros(NONE + 1)
    by_entry[: len(moves)] = moves
    furthest = moves.max(initial=0)
    upper = bounds[:, 0] + by_entry[near[:, 0]]
    lower = bounds[:, 1:].copy()
    lower[:, :-1] -= by_entry[near[:, 1:]]
    lower[:, -1] -= furthest
    # lower[:, z] is made to hold for every entry of rank z + 1 and more.
    least = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
    near, bounds = near.copy(), np.concatenate([upper[:, None], lower], axis=1)
    asked = np.zeros(len(x), np.int64)

    def unsure(rows: np.ndarray) -> np.ndarray:
        slack = 1e-9 * (1 + upper[rows] + furthest)
        return least[rows] <= (upper[rows] + slack)[:, None]

    rows = np.flatnonzero(unsure(np.arange(len(x)))[:, 0])
    own = entries[near[rows, 0]]
    upper[rows] = np.sqrt(((x[rows] - own) ** 2).sum(axis=1))
    bounds[rows, 0] = upper[rows]
    asked[rows] = 1
    still = unsure(rows)
    rows, still = rows[still[:, 0]], still[still[:, 0]]
    # The bounds are in order, so the unsure ones come first.
    reach = still.sum(axis=1)
    asked[rows] = np.where(reach < near.shape[1], reach + 1, MOST + 1)
    for z in np.unique(reach[reach < near.shape[1]]).tolist():
        some = rows[reach == z]
        candidates = near[some, : z + 1]
        apart = ((x[some][:, None, :] - entries[candidates]) ** 2).sum(axis=2)
        order = np.lexsort((candidates, apart), axis=1)
        near[some, : z + 1] = np.take_along_axis(candidates, order, axis=1)
        bounds[some, : z + 1] = np.sqrt(np.take_along_axis(apart, order, axis=1))
    near, bounds = resized(near, bounds, b)
    every = rows[reach >= least.shape[1]]
    if len(every):
        near[every], bounds[every] = listed(x[every], entries, b)
    return near, bounds, asked


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _packed(near: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Lists and bounds of all parts as bytes; bounds are rounded to the safe side."""
    small = _down(bounds)
    small[:, :, 0] = np.nextafter(bounds[:, :, 0].astype(np.float32), np.float32(np.inf))

    def rows(a: np.ndarray) -> pa.Array:
        raw, width = np.ascontiguousarray(a).tobytes(), a[0].nbytes if len(a) else 0
        return pa.array([raw[i * width : (i + 1) * width] for i in range(len(a))], pa.binary())

    return rows(near), rows(small)


def _unpacked(batch: pa.RecordBatch, parts: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8)
    bounds = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), np.float32)
    return near.reshape(n, parts, -1), bounds.reshape(n, parts, -1).astype(np.float64)


def _integers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, dims)


def integers(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int
) -> DataFrame:
    """Rows (vec_id, label, vector) with integer components, of vectors that can be coded."""
    within = float(LARGEST // scale)
    numbers = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), numbers.alias("vector")
    ).where(F.col("vector").isNotNull())
    sane = F.forall("vector", lambda v: F.coalesce(F.abs(v) < within, F.lit(False)))
    whole = F.transform("vector", lambda v: F.floor(v * scale).cast("int"))
    return rows.where(sane).withColumn("vector", whole)


def _seeds(rows: DataFrame, dims: int, parts: int, entries: int) -> Codebooks:
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries)
    table = np.array([r.vector for r in first.select("vector").collect()], np.int64)
    cuts = edges(dims, parts)
    return Codebooks(dims, [table[:, a:b] for a, b in zip(cuts, cuts[1:])])


def _assign(
    rows: DataFrame, books: Codebooks, parts: int, b: int, moves: list[np.ndarray] | None
) -> DataFrame:
    """Rows with `near` and `bounds`; a last row of each task has `sums` instead.

    The sums are those of the assigned parts by part, entry and position, the counts by
    part and entry, and how often how many entries were asked for, by part. Without
    `moves`, all entries are compared.
    """
    cuts, size = edges(books.dims, parts), books.size
    ranges = list(zip(cuts, cuts[1:]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((size, e - a), np.int64) for a, e in ranges]
        counts = np.zeros((parts, size), np.int64)
        usage = np.zeros((parts, MOST + 2), np.int64)
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in ("vec_id", "label", "vector")]
            x = _integers(batch, books.dims)
            near = np.zeros((len(x), parts, b), np.uint8)
            bounds = np.zeros((len(x), parts, b + 1))
            old_near, old_bounds = _unpacked(batch, parts) if moves else (None, None)
            for p, (start, end) in enumerate(ranges):
                own = x[:, start:end]
                if moves is None:
                    near[:, p], bounds[:, p] = listed(own, books.entries[p], b)
                else:
                    near[:, p], bounds[:, p], asked = reassigned(
                        own, old_near[:, p], old_bounds[:, p], moves[p], books.entries[p], b
                    )
                    usage[p] += np.bincount(np.minimum(asked, MOST + 1), minlength=MOST + 2)
                np.add.at(sums[p], near[:, p, 0], own)
                counts[p] += np.bincount(near[:, p, 0], minlength=size)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("vec_id", "label", "vector")),
                    *_packed(near, bounds),
                    pa.nulls(len(x), pa.list_(pa.int64())),
                ],
                names=["vec_id", "label", "vector", "near", "bounds", "sums"],
            )
        if kinds is not None:
            flat = np.concatenate([*(s.ravel() for s in sums), counts.ravel(), usage.ravel()])
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.nulls(1, kind) for kind in kinds),
                    pa.nulls(1, pa.binary()),
                    pa.nulls(1, pa.binary()),
                    pa.array([flat.tolist()], pa.list_(pa.int64())),
                ],
                names=["vec_id", "label", "vector", "near", "bounds", "sums"],
            )

    kind = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return rows.mapInArrow(
        assign,
        f"vec_id {kind['vec_id']}, label {kind['label']}, vector array<int>, near binary, "
        "bounds binary, sums array<long>",
    )


def _moved(
    state: DataFrame, books: Codebooks, parts: int
) -> tuple[Codebooks, list[np.ndarray], np.ndarray]:
    """The replaced entries, how far they moved, and the usage of lists by part."""
    totals = (
        state.where(F.col("sums").isNotNull())
        .select(F.posexplode("sums"))
        .groupBy("pos")
        .agg(F.sum("col").alias("total"))
        .collect()
    )
    flat = np.zeros(books.size * (books.dims + parts) + parts * (MOST + 2), np.int64)
    for row in totals:
        flat[row.pos] = row.total
    cells = books.size * books.dims
    counts = flat[cells : cells + books.size * parts].reshape(parts, books.size)
    usage = flat[cells + books.size * parts :].reshape(parts, MOST + 2)
    entries, moves, at = [], [], 0
    for p, old in enumerate(books.entries):
        sums = flat[at : at + old.size].reshape(old.shape)
        at += old.size
        used = counts[p] > 0
        new = old.copy()
        new[used] = sums[used] // counts[p][used][:, None]
        entries.append(new)
        # Rounded up: a bound may be too wide but never too narrow.
        moves.append(np.sqrt(((new - old) ** 2).sum(axis=1)) * (1 + 1e-12))
    return Codebooks(books.dims, entries), moves, usage


def adapted(b: int, usage: np.ndarray) -> int:
    """The length of lists for the next round, from how many entries rows asked for."""
    by_ask = usage.sum(axis=0)
    total = by_ask.sum()
    if not total:
        return b
    over = total - np.cumsum(by_ask)
    enough = int(np.argmax(over <= BEYOND * total))
    if enough > b:  # more than the lists hold
        return min(2 * b, MOST)
    return min(max(enough + 1, LEAST), MOST)


def train(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None, list[int]]:
    """Codes of all vectors: (vec_id, label, code, error), the codebooks and each round's `b`.

    A component x becomes floor(scale * x). The codebooks begin as the parts of the
    `entries` rows with the smallest ids, rows without an id behind the others, equal ids
    by their vectors. Each round assigns every part to its nearest entry by squared
    distance, ties to the lower index, and replaces each entry by its parts'
    floor(sum / count); entries without parts stay. Then parts are assigned once more.

    `code` has an entry's index for each part, `error` is the sum of the squared distances.
    Vectors that are null or hold a null or non-finite component are left out, and so are
    those with a component of LARGEST / scale (65,536) or more, whose squared distances
    would not fit 64 bits. All vectors have one length, the commonest (of equally common
    ones the shortest): a vector of another length has a null code and error. Where
    `parts` doesn't divide the length, parts differ by one component. Repeated rows are
    coded each, null ids and labels are kept, other columns are not read, an empty table
    gives an empty result and no codebooks.

    What reaches the driver are the first entries and a sum for each component of the
    codebooks, whatever the size of the table. States are written to the shared folder.
    """
    if not 1 <= entries < NONE:
        raise ValueError(f"between 1 and {NONE - 1} entries, not {entries}")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = integers(vectors, id_col, vector_col, label_col, scale)
    lengths = rows.groupBy(F.size("vector").alias("dims")).count()
    common = lengths.orderBy(F.desc("count"), "dims").first()
    if common is None:
        none = rows.select("vec_id", "label", F.array().cast("array<int>").alias("code"))
        return none.withColumn("error", F.lit(0).cast("long")), None, []
    dims = common.dims
    same = rows.where(F.size("vector") == dims)
    books, b, sizes = _seeds(same, dims, parts, entries), min(FIRST, entries), []
    state, moves = same, None
    for _ in range(rounds):
        sizes.append(b)
        state = stored(_assign(state, books, parts, b, moves), "assigned")
        books, moves, usage = _moved(state, books, parts)
        if len(sizes) > 1:  # the first round compares all
            b = adapted(b, usage)
        state = state.where(F.col("sums").isNull()).drop("sums")
    sizes.append(b)
    coded = _coded(state, books, parts, b, moves)
    others = rows.where(F.size("vector") != dims).select(
        "vec_id",
        "label",
        F.lit(None).cast("array<int>").alias("code"),
        F.lit(None).cast("long").alias("error"),
    )
    return stored(coded.union(others), "codes"), books, sizes


def _coded(
    state: DataFrame, books: Codebooks, parts: int, b: int, moves: list[np.ndarray] | None
) -> DataFrame:
    cuts = edges(books.dims, parts)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch, books.dims)
            found = np.zeros((len(x), parts), np.int32)
            error = np.zeros(len(x), np.int64)
            near, bounds = _unpacked(batch, parts) if moves else (None, None)
            for p, (start, end) in enumerate(zip(cuts, cuts[1:])):
                own, entries = x[:, start:end], books.entries[p]
                if moves is None:
                    lists, _ = listed(own, entries, b)
                else:
                    lists, _, _ = reassigned(own, near[:, p], bounds[:, p], moves[p], entries, b)
                found[:, p] = lists[:, 0]
                error += ((own - entries[lists[:, 0]]) ** 2).sum(axis=1)
            ends = pa.array(np.arange(len(x) + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.ListArray.from_arrays(ends, pa.array(found.ravel())),
                    pa.array(error),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    kind = {c: state.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return state.mapInArrow(
        code, f"vec_id {kind['vec_id']}, label {kind['label']}, code array<int>, error long"
    )


def decoded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """Rows of train() with `vector`: the entries that the code names, in doubles."""
    ship_package(codes.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                None
                if c is None
                else np.concatenate([e[i] for e, i in zip(books.entries, c)]) / scale
                for c in batch.column("code").to_pylist()
            ]
            yield batch.append_column("vector", pa.array(out, pa.list_(pa.float64())))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(decode, f"{fields}, vector array<double>")


def compressed(spark: SparkSession, vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of train().

    `code` has two hex digits a part; label_error is the sum of the errors of all rows
    with the same label, rows without one together. Sums of a label are made before the
    shuffle, and joined back as one row a label.
    """
    codes, books, _ = train(vectors, **settings)
    totals = stored(
        codes.groupBy(F.col("label").alias("summed")).agg(
            F.sum("error").cast("long").alias("label_error")
        ),
        "totals",
    )
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("summed"))).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )
