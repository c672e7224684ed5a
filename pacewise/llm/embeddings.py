"""Cosine similarity join of embeddings by a pigeonhole over subspaces.

Unit vectors with cosine c or more lie within squared distance 2 - 2c. The vectors are
rotated and split into BLOCKS subspaces of few dimensions; in at least one of them two
such vectors differ by no more than that subspace's share of the squared distance. So
each subspace is joined by range: vectors are dealt to the cells of a grid, as wide as
the share allows them to differ, over the subspace's first coordinates, and a cell meets
itself and its neighbours. What is close in a subspace is a candidate, a candidate is
verified on the whole vectors, and it counts in the first subspace that finds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.components import components, forest
from pacewise.llm.store import ship_package, stored

COSINE = 0.93
BLOCKS = 8
#: Vectors in one part of a cell; two parts make a tile.
PART = 1536
#: A grid has another coordinate when its cells would hold more vectors than this.
CELL = 50_000
SEED = 5
SLACK = 1e-9


def rotation(dims: int) -> np.ndarray:
    """A fixed orthogonal matrix; it spreads what few coordinates hold over all."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def subspaces(dims: int, blocks: int = BLOCKS) -> list[slice]:
    edges = [dims * i // min(blocks, dims) for i in range(min(blocks, dims) + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def budgets(dims: int, cosine: float, blocks: int = BLOCKS) -> np.ndarray:
    """Each subspace's share of the squared distance, in proportion to its dimensions."""
    sizes = np.array([s.stop - s.start for s in subspaces(dims, blocks)])
    return (2 - 2 * cosine) * sizes / dims + SLACK


def _units(lists: pa.ListArray, dims: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(-1, dims)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str
) -> DataFrame:
    """Rows (vec_id, label, vector of doubles) that can link at all."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        vector.alias("vector"),
    )
    sane = F.forall(
        "vector",
        lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")),
    )
    return rows.where(sane & F.exists("vector", lambda v: v != 0))


def _deal(
    rows: DataFrame, dims: int, cosine: float, blocks: int, grid: int, kind: type
) -> DataFrame:
    """A row for each subspace and cell that a vector has to be in: cell, own, node, vector.

    A vector is dealt to its own cell, and as a guest to half of the neighbours: of two
    neighbouring cells one takes the guests of the other. `cell` is the host's key.
    """
    half = [o for o in product((-1, 0, 1), repeat=grid) if o > (0,) * grid]
    turn = rotation(dims)
    widths = np.sqrt(budgets(dims, cosine, blocks))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _units(batch.column("vector"), dims)
            turned = unit @ turn
            labels = batch.column("label").to_pylist()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            packed = [v.tobytes() for v in flat.astype(kind).reshape(-1, dims)]
            for b, part in enumerate(subspaces(dims, blocks)):
                at = np.floor(turned[:, part][:, :grid] / widths[b]).astype(np.int64)
                for offset in [(0,) * grid, *half]:
                    own = not any(offset)
                    cells = (at + np.array(offset)).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f"{lab}|{b}|{c}" for lab, c in zip(labels, cells)]),
                            pa.array([b] * len(labels), pa.int32()),
                            pa.array([own] * len(labels)),
                            batch.column("node"),
                            batch.column("weight"),
                            pa.array(packed, pa.binary()),
                        ],
                        names=["cell", "block", "own", "node", "weight", "packed"],
                    )

    return rows.mapInArrow(
        deal,
        "cell string, block int, own boolean, node long, weight long, packed binary",
    )


def _verify(dims: int, cosine: float, blocks: int, kind: type):
    """Verify the candidates of one tile: part `p` of the owners against part `q` of all."""
    turn, parts, limits = rotation(dims), subspaces(dims, blocks), budgets(dims, cosine, blocks)

    def near(a: np.ndarray, b: np.ndarray, block: int) -> np.ndarray:
        x, y = a[:, parts[block]], b[:, parts[block]]
        apart = (x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * (x @ y.T)
        return apart <= limits[block]

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role = table.column("role").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        block = int(table.column("block")[0].as_py())
        inside = bool(table.column("inside")[0].as_py())
        raw = np.frombuffer(b"".join(table.column("packed").to_pylist()), kind)
        raw = raw.astype(np.float64).reshape(-1, dims)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        left = np.flatnonzero(role == 0)
        right = left if inside else np.flatnonzero(role == 1)
        none = np.zeros(0, np.int64)
        out_a, out_b, out_n = [none], [none], [none]
        if len(left) and len(right):
            a, b = unit[left] @ turn, unit[right] @ turn
            found = near(a, b, block)
            if inside:
                np.fill_diagonal(found, False)
            if found.any():
                found &= unit[left] @ unit[right].T >= cosine
            for earlier in range(block if found.any() else 0):
                found &= ~near(a, b, earlier)
            if found.any():
                for rows, n in (
                    (left, found @ weight[right]),
                    (right, weight[left] @ found if not inside else np.zeros(len(right), np.int64)),
                ):
                    has = np.flatnonzero(n)
                    out_a.append(node[rows[has]])
                    out_b.append(node[rows[has]])
                    out_n.append(n[has])
                if inside:
                    links, names = found, node[left]
                else:
                    links = np.zeros((len(left) + len(right),) * 2, bool)
                    links[: len(left), len(left) :] = found
                    links |= links.T
                    names = node[np.concatenate([left, right])]
                i, j = forest(links)
                out_a.append(names[i])
                out_b.append(names[j])
                out_n.append(np.zeros(len(i), np.int64))
        return pa.table({c: np.concatenate(x) for c, x in zip("abn", (out_a, out_b, out_n))})

    return verify


def similarity_links(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    blocks: int = BLOCKS,
) -> DataFrame:
    """The links of every row: vec_id, n_links, component_id, kept.

    Rows with equal labels link if their cosine, in double precision, is `cosine` or
    more. n_links counts the other rows that a row links with, equal vectors included;
    component_id is the smallest vec_id that links reach, itself included; kept is
    vec_id = component_id. No link is missed: the subspaces' shares add up to the whole
    distance. Rows whose label or vector is null, or whose vector is empty, zero or has
    a null or non-finite component link with nothing; so do vectors of different
    lengths. Repeated rows are equal vectors, each of which is returned. Rows without an
    id take part and name a component only if it has no other row. Other columns are not
    read; an empty table gives an empty result.

    Equal vectors enter once. A cell with more than PART vectors is cut into parts, and
    every two parts are a tile of their own, so no task holds a large cell and no pairs
    are listed. The work on a dense group still grows with the square of its different
    vectors, spread over tiles.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_col, vector_col, label_col)
    named = stored(
        rows.groupBy("label", "vector").agg(
            F.min("vec_id").alias("first_id"), F.count("*").alias("weight")
        )
        # A vector goes by the number that it has in the stored table: no two share one.
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    # Vectors of floats travel as floats; each length, of which there are few, is a job.
    kind = np.float32 if vectors.schema[vector_col].dataType.elementType == T.FloatType() else np.float64
    found = spark.createDataFrame([], "a long, b long, n long")
    lengths = named.select(F.size("vector").alias("dims")).distinct().orderBy("dims")
    for (dims,) in lengths.collect():
        same = named.where(F.size("vector") == dims)
        found = found.union(_links_of(same, dims, cosine, blocks, kind))
    counts = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("others"))
    joined = components(found.where("n = 0").select("a", "b")).select(
        F.col("node").alias("joined_node"), "root"
    )
    classes = (
        named.select("node", "label", "vector", "first_id", "weight")
        .join(joined, F.col("node") == F.col("joined_node"), "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = classes.groupBy(F.col("root").alias("named_root")).agg(
        F.min("first_id").alias("component_id")
    )
    result = (
        classes.join(counts, F.col("node") == F.col("a"), "left")
        .join(names, F.col("root") == F.col("named_root"))
        .select(
            F.col("label").alias("class_label"),
            F.col("vector").alias("class_vector"),
            "component_id",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    every = vectors.select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    component = F.coalesce("component_id", "vec_id")
    return every.join(
        result,
        (F.col("label") == F.col("class_label")) & (F.col("vector") == F.col("class_vector")),
        "left",
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links_of(
    named: DataFrame, dims: int, cosine: float, blocks: int, kind: type
) -> DataFrame:
    """Links among vectors of one length: (node, node, links) and (node, node, 0) as edges."""
    shape = named.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    # Half of a subspace's vectors lie in about three cells for each coordinate.
    grid, smallest = 1, min(s.stop - s.start for s in subspaces(dims, blocks))
    while grid < smallest and shape / 4**grid > CELL:
        grid += 1
    dealt = stored(
        _deal(named.select("node", "label", "weight", "vector"), dims, cosine, blocks, grid, kind),
        "cells",
    )
    sizes = dealt.groupBy(F.col("cell").alias("sized")).agg(
        F.count_if("own").alias("owners"), F.count_if(~F.col("own")).alias("guests")
    ).where("owners > 0").select(
        "sized",
        F.ceil(F.col("owners") / PART).cast("int").alias("own_parts"),
        F.ceil(F.col("guests") / PART).cast("int").alias("guest_parts"),
    )
    placed = dealt.join(sizes, F.col("cell") == F.col("sized"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("own"), F.col("own_parts")).otherwise(
        F.col("guest_parts"))).cast("int")

    def upto(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(
            F.array().cast("array<int>")
        )

    # An owner meets the other parts of its cell, and the parts of the guests.
    owner = F.concat(
        F.transform(
            upto("own_parts"),
            lambda q: F.struct(
                F.least(F.col("part"), q).alias("p"),
                F.greatest(F.col("part"), q).alias("q"),
                F.lit(False).alias("guest"),
                (F.col("part") > q).cast("int").alias("role"),
                (F.col("part") == q).alias("inside"),
            ),
        ),
        F.transform(
            upto("guest_parts"),
            lambda q: F.struct(
                F.col("part").alias("p"),
                q.alias("q"),
                F.lit(True).alias("guest"),
                F.lit(0).alias("role"),
                F.lit(False).alias("inside"),
            ),
        ),
    )
    guest = F.transform(
        upto("own_parts"),
        lambda p: F.struct(
            p.alias("p"),
            F.col("part").alias("q"),
            F.lit(True).alias("guest"),
            F.lit(1).alias("role"),
            F.lit(False).alias("inside"),
        ),
    )
    tiles = (
        placed.withColumn("part", part)
        .withColumn("tile", F.explode(F.when(F.col("own"), owner).otherwise(guest)))
        # One name for a tile: rows that lie together by cell are dealt out anew.
        .withColumn("name", F.concat_ws("|", "cell", "tile.p", "tile.q", "tile.guest"))
        .select("name", "block", "node", "weight", "packed", "tile.role", "tile.inside")
    )
    return stored(
        tiles.groupBy("name").applyInArrow(
            _verify(dims, cosine, blocks, kind), "a long, b long, n long"
        ),
        "links",
    )
