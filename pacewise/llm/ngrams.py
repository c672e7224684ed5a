"""Similarity join of documents by their five-word shingles, by a MinHash LSH forest.

Each document has a word of MAX_DEPTH minima in each of TREES tries; a trie's nodes at a
depth are the documents with an equal prefix of that length. The join starts at full
depth: all pairs that meet there are verified exactly, and from the similarities of all
their links follows the share of such links that prefixes of any lengths would find;
prefixes are shortened, trie by trie, until that recall meets its target, and the pairs
that meet then and did not before are verified, too. Documents with equal sets of
shingles are one class and enter once. Classes that prefixes connect form a block: a small
block is one unit of work, in a large one each node of each trie is a unit of its own, or
several if it is large. Every unit verifies its pairs on the whole sets, and a pair counts
in the first trie that brings it together. No list of pairs is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.components import components, forest
from pacewise.llm.store import ship_package, stored

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
TREES, MAX_DEPTH = 24, 8
#: The share of the links at full depth, the least similar ones, that the recall is
#: measured on.
LEAST_SIMILAR = 0.1
#: Classes and shingles in one tile; larger blocks and nodes are cut into tiles.
TILE, TILE_SHINGLES = 512, 1_000_000
SLICE_BYTES = 1_000_000
SEED = 7
#: Bytes of a minimum in a word.
LETTER = 2

_ODD = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(_ODD)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def expected_recall(depths: list[int], similarities: dict[float, float]) -> float:
    """The share of links found by prefixes of these lengths, links weighted by similarity."""
    total = sum(similarities.values())
    missed = 0.0
    for s, weight in similarities.items():
        chance = 1.0
        for d in depths:
            chance *= 1 - s**d
        missed += weight * chance
    return 1 - missed / total


def shortened(
    similarities: dict[float, float],
    recall: float = RECALL,
    trees: int = TREES,
    deepest: int = MAX_DEPTH,
) -> list[int]:
    """Prefix lengths of the tries: full depth, one trie after another shortened by one
    until the recall is met or all are 1."""
    depths = [deepest] * trees
    turn = 0
    while expected_recall(depths, similarities) < recall and max(depths) > 1:
        depths[turn % trees] -= 1
        turn += 1
    return depths


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


_INVERSE = pow(_ODD, -1, 1 << 64)


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text: flat hashes and offsets.

    Words are runs of characters other than ASCII white space, lower-cased. A text of
    fewer words has one shingle of all of them, one without words has none.
    """
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    blank = _SPACES[data]
    # A word's hash is the polynomial of its bytes: a difference of sums, shifted back.
    sums = np.concatenate(
        [np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(data)))]
    )
    edge = np.diff(blank.astype(np.int8), prepend=1)
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    hashes = _mix((sums[last] - sums[first]) * _powers(_INVERSE, len(data))[first])
    owner = np.searchsorted(ends, first, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    total = np.zeros(len(hashes), np.uint64)
    for i in range(min(words, len(hashes))):
        total[: len(hashes) - i] += _mix(hashes[i:] * np.uint64(pow(_ODD, i + 1, 1 << 64)))
    total = _mix(total)
    starts = np.cumsum(counts) - counts
    flat, sizes = [], np.zeros(len(texts) + 1, np.int64)
    for t, (start, n) in enumerate(zip(starts.tolist(), counts.tolist())):
        if n >= words:
            found = np.unique(total[start : start + n - words + 1])
        elif n:
            own = hashes[start : start + n] * (np.arange(n, dtype=np.uint64) + np.uint64(3))
            found = _mix(_mix(own).sum(keepdims=True) + np.uint64(n))
        else:
            continue
        flat.append(found)
        sizes[t + 1] = len(found)
    return np.concatenate(flat) if flat else np.zeros(0, np.uint64), np.cumsum(sizes)


def set_keys(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set of shingles."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(_mix(flat + np.uint64(salt * _ODD % (1 << 64))))]
        )
        out.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def words_of_tries(flat: np.ndarray, offsets: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each set and trie its word: `depth` minima, cut to LETTER bytes; no set is empty."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((len(offsets) - 1, trees, depth), np.uint16)
    for tree in range(trees):
        for place in range(depth):
            odd, shift = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            mixed = flat * (odd * np.uint64(2) + np.uint64(1)) + shift
            out[:, tree, place] = _mix(np.minimum.reduceat(mixed >> np.uint64(24), offsets[:-1]))
    return out


def prefixes(words: np.ndarray, depths: list[int]) -> np.ndarray:
    """For each set and trie the hash of its prefix of that trie's length."""
    keys = np.zeros(words.shape[:2], np.uint64)
    for tree, depth in enumerate(depths):
        key = np.full(len(words), tree + 1, np.uint64)
        for place in range(depth):
            key = _mix(key * _MULTIPLIER + words[:, tree, place].astype(np.uint64))
        keys[:, tree] = key
    return keys.view(np.int64)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64), pa.int64())
    )


def _digests(text: Column) -> list[Column]:
    """Two 64-bit hashes that tell the texts of one id, or of rows without an id, apart."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def signatures(rows: DataFrame, words: int, trees: int, depth: int = MAX_DEPTH) -> DataFrame:
    """(doc_id, h1, h2, k1, k2, n, tries) of rows (doc_id, text, h1, h2).

    `tries` has the words of all tries, one after another. A text without words has n = 0.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts):
                flat, offsets = shingle_sets(texts[a:b], words)
                k1, k2 = set_keys(flat, offsets)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                raw = words_of_tries(flat, np.append(offsets[full], len(flat)), trees, depth).tobytes()
                width = trees * depth * LETTER
                tries: list[bytes | None] = [None] * len(sizes)
                for i, row in enumerate(full.tolist()):
                    tries[row] = raw[i * width : (i + 1) * width]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, b - a) for c in ("doc_id", "h1", "h2")),
                        pa.array(k1),
                        pa.array(k2),
                        pa.array(sizes),
                        pa.array(tries, pa.binary()),
                    ],
                    names=["doc_id", "h1", "h2", "k1", "k2", "n", "tries"],
                )

    return rows.mapInArrow(
        sign, f"doc_id {kind}, h1 long, h2 long, k1 long, k2 long, n long, tries binary"
    )


def _nodes(classes: DataFrame, depths: list[int], deepest: int = MAX_DEPTH) -> DataFrame:
    """(node, n, prefixes): the trie nodes that a class is in, one for each trie."""
    trees = len(depths)

    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("tries").to_pylist()), np.uint16)
            keys = prefixes(raw.reshape(-1, trees, deepest), depths)
            ends = np.arange(len(keys) + 1) * trees
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), _lists(keys.ravel(), ends)],
                names=["node", "n", "prefixes"],
            )

    rows = classes.select("node", "n", "tries")
    return rows.mapInArrow(cut_words, "node long, n long, prefixes array<long>")


def _shingled(rows: DataFrame, words: int, passed: dict[str, str]) -> DataFrame:
    """Rows (node, k1, k2, text, ...) with the shingles instead of the text.

    Rows whose text has another set than the class `node` are left out. Of a repeated
    row, whose copies meet in one task, the first stands for all. Columns `passed`, with
    their types, stay.
    """
    kept = ["node", *passed]

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def first(node: int) -> bool:
            new = node not in seen
            seen.add(node)
            return new

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts):
                flat, offsets = shingle_sets(texts[a:b], words)
                part = batch.slice(a, b - a)
                k1, k2 = set_keys(flat, offsets)
                own = (k1 == part.column("k1").to_numpy()) & (k2 == part.column("k2").to_numpy())
                nodes = part.column("node").to_pylist()
                mask = [bool(o) and first(n) for o, n in zip(own, nodes)]
                arrays = [*(part.column(c) for c in kept), _lists(flat, offsets)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "shingles"]).filter(
                    pa.array(mask, pa.bool_())
                )

    types = ", ".join(f"{c} {t}" for c, t in passed.items())
    return rows.mapInArrow(shingle, f"node long, {types + ', ' if types else ''}shingles array<long>")


def _overlaps(
    flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, candidates: np.ndarray
) -> np.ndarray:
    """Sizes of the intersections of sets, by a matrix product over what sets share.

    Where few pairs are candidates and the sets are long, only those are intersected.
    """
    sizes = ends - starts
    count = len(starts)
    pairs = np.argwhere(np.triu(candidates, 1))
    if len(pairs) * 40 < count * count:
        out = np.zeros((count, count), np.int64)
        for i, j in pairs.tolist():
            both = np.concatenate([flat[starts[i] : ends[i]], flat[starts[j] : ends[j]]])
            both.sort()
            out[i, j] = out[j, i] = np.count_nonzero(both[1:] == both[:-1])
        return out
    owner = np.repeat(np.arange(count), sizes)
    items = np.concatenate([flat[a:b] for a, b in zip(starts, ends)])
    _, column, times = np.unique(items, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    names, column = np.unique(column, return_inverse=True)
    out = np.zeros((count, count), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, len(names), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        table = np.zeros((count, min(4096, len(names) - first)), np.float32)
        table[owner[a:b], column[a:b] - first] = 1
        out += table @ table.T
    return np.rint(out).astype(np.int64)


def _verify(
    threshold: float, depths: list[int], before: list[int] | None = None, deepest: int = MAX_DEPTH
):
    """Verify the candidates of one unit: small blocks, or one tile of a large trie node.

    `tree` is the trie of the unit, or -1 for whole blocks; of a node's pairs only those
    count that don't meet in an earlier trie, and none that prefixes of the lengths
    `before` bring together. `alike` is -1, or the similarity in hundredths of `n` links.
    """
    trees = len(depths)

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        shingles = table.column("shingles").combine_chunks()
        if isinstance(shingles, pa.ChunkedArray):
            shingles = shingles.chunk(0)
        flat = shingles.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sizes = shingles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        node, weight, group, part, low, high, tree = (
            table.column(c).to_numpy()
            for c in ("node", "weight", "group", "part", "low", "high", "tree")
        )
        out_a, out_b, out_n, alike = [], [], [], np.zeros(101, np.int64)
        order = np.lexsort((node, high, low, tree, group))
        keys = np.stack([group, tree, low, high])[:, order]
        cuts = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
        for rows in np.split(order, cuts):
            rows = rows[np.append(True, np.diff(node[rows]) != 0)]  # a class once
            if len(rows) < 2:
                continue
            begin, end = starts[rows], ends[rows]
            offsets = np.concatenate([[0], np.cumsum(sizes[rows])])
            own = np.concatenate([flat[a:b] for a, b in zip(begin, end)])
            tries = words_of_tries(own, offsets, trees, deepest)
            keys = prefixes(tries, depths)
            unit = int(tree[rows[0]])
            met = np.zeros((len(rows), len(rows)), bool)
            for t in range(trees):
                same = keys[:, t, None] == keys[None, :, t]
                if unit < 0:
                    met |= same
                elif t < unit:
                    met |= same
                elif t == unit:
                    met = same & ~met
            if before:
                known = prefixes(tries, before)
                for t in range(trees):
                    met &= known[:, t, None] != known[None, :, t]
            # In a tile of two parts only pairs across them are new.
            if low[rows[0]] != high[rows[0]]:
                met &= part[rows][:, None] != part[rows][None, :]
            np.fill_diagonal(met, False)
            common = _overlaps(own, offsets[:-1], offsets[1:], met)
            union = sizes[rows][:, None] + sizes[rows][None, :] - common
            links = met & (common >= threshold * union)
            pairs = np.triu(links)
            alike += np.bincount(common[pairs] * 100 // union[pairs], minlength=101)
            counted = links @ weight[rows]
            has = np.flatnonzero(counted)
            out_a.append(node[rows[has]])
            out_b.append(node[rows[has]])
            out_n.append(counted[has])
            a, b = forest(links)
            out_a.append(node[rows[a]])
            out_b.append(node[rows[b]])
            out_n.append(np.zeros(len(a), np.int64))
        rows = sum(len(x) for x in out_n)
        levels = np.flatnonzero(alike)
        nothing = np.zeros(len(levels), np.int64)
        columns = {"a": [*out_a, nothing], "b": [*out_b, nothing], "n": [*out_n, alike[levels]]}
        columns["alike"] = [np.full(rows, -1), levels]
        return pa.table({c: np.concatenate(x).astype(np.int64) for c, x in columns.items()})

    return verify


def _similarities(
    found: DataFrame, threshold: float, depths: list[int]
) -> dict[float, float]:
    """The least similar of all links found by prefixes of these lengths: their weight by
    similarity.

    A link weighs the inverse of the probability that such prefixes find it. Without any
    link the threshold stands for all.
    """
    levels = found.where("alike >= 0").groupBy("alike").agg(F.sum("n").alias("n"))
    counts = [(max(r.alike / 100, threshold), r.n) for r in levels.orderBy("alike").collect()]
    weights = [(s, n / expected_recall(depths, {s: 1.0})) for s, n in counts]
    if not weights:
        return {threshold: 1.0}
    out, room = {}, LEAST_SIMILAR * sum(w for _, w in weights)
    for s, w in weights:
        out[s] = min(w, room)
        room -= out[s]
        if room <= 0:
            break
    return out


def _is_first() -> Column:
    """Whether a text is the one that stands for its class."""
    return (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("h1") == F.col("first.h1"))
        & (F.col("h2") == F.col("first.h2"))
    )


def _new_nodes(met: DataFrame, blocks: DataFrame, trees: int) -> DataFrame:
    """(block, tree, prefix, many, length) of the trie nodes of large blocks that have new pairs.

    A node whose classes are all together in an earlier trie, too, has none.
    """
    rows = met.join(blocks, F.col("node") == F.col("block_node")).select(
        "block", "n", "prefixes", F.posexplode("prefixes").alias("tree", "prefix")
    )
    earlier = [
        F.min(F.col("prefixes")[t]).eqNullSafe(F.max(F.col("prefixes")[t])).alias(f"_{t}")
        for t in range(trees)
    ]
    found = rows.groupBy("block", "tree", "prefix").agg(
        F.count("*").alias("many"), F.sum("n").alias("length"), F.array(*earlier).alias("together")
    )
    before = F.slice("together", F.lit(1), F.col("tree"))
    new = (F.col("many") > 1) & ~F.exists(before, lambda x: x)
    return found.where(new).select("block", "tree", "prefix", "many", "length")


def _parts(many: str, length: str) -> Column:
    return F.ceil(
        F.greatest(F.col(many) / TILE, F.col(length) / TILE_SHINGLES)
    ).cast("int")


def _trie_units(met: DataFrame, placed: DataFrame, trees: int) -> DataFrame | None:
    """(block, tree, prefix, node_parts) of blocks that are verified by trie node, if any.

    A large block is verified whole, every part against every part, or node by node of its
    tries, whichever moves fewer copies of its sets: a dense one is moved less as a whole,
    a chain whose ends have no node in common less by node, once for each trie at most.
    """
    large = placed.where("parts > 1").select(F.col("node").alias("block_node"), "block")
    if large.isEmpty():
        return None
    nodes = _new_nodes(met, large, trees).withColumn("node_parts", _parts("many", "length"))
    nodes = stored(nodes, "trie-nodes")
    by_trie = nodes.groupBy("block").agg(F.sum(F.col("many") * F.col("node_parts")).alias("copies"))
    blocks = placed.where("parts > 1").select(
        F.col("block").alias("of_block"), (F.col("many") * F.col("parts")).alias("whole")
    ).distinct()
    cheaper = by_trie.join(blocks, F.col("block") == F.col("of_block")).where("copies < whole")
    chosen = stored(
        nodes.join(cheaper.select(F.col("block").alias("cheap")), F.col("block") == F.col("cheap"))
        .drop("cheap"),
        "split-nodes",
    )
    return None if chosen.isEmpty() else chosen


def _tiles(rows: DataFrame, unit: Column) -> DataFrame:
    """A row for each tile that a class is in: its part of `group` against every part."""
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    return (
        rows.withColumn("part", part)
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("part", "partner"))
        .withColumn("high", F.greatest("part", "partner"))
        .withColumn("unit", unit)
        .select("unit", "group", "tree", "node", "weight", "part", "low", "high", "shingles")
    )


def _shared(spread: DataFrame) -> DataFrame:
    """(shared, hub): the prefixes of several classes, with the smallest of these."""
    return spread.groupBy("prefix").agg(
        F.min("node").alias("hub"), F.max("node").alias("other")
    ).where("hub < other").select(F.col("prefix").alias("shared"), "hub")


def _links(
    classes: DataFrame,
    sets: DataFrame,
    threshold: float,
    depths: list[int],
    before: list[int] | None = None,
) -> DataFrame:
    """(a, b, n, alike) of the links that prefixes of these lengths find, see _verify.

    `sets` (node, weight, shingles) has all classes that share a prefix with another.
    """
    spark, trees = classes.sparkSession, len(depths)
    met = stored(_nodes(classes, depths), "nodes")
    spread = met.select("node", F.explode("prefixes").alias("prefix"))
    edges = spread.join(_shared(spread), F.col("prefix") == F.col("shared")).select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    blocks = components(edges).select(
        F.col("node").alias("block_node"), F.col("root").alias("block")
    )
    placed = stored(
        classes.select("node", "n").join(blocks, F.col("node") == F.col("block_node")).drop("block_node"),
        "placed",
    )
    sizes = placed.groupBy("block").agg(F.count("*").alias("many"), F.sum("n").alias("length"))
    sizes = sizes.select(
        F.col("block").alias("sized"), "many", _parts("many", "length").alias("parts")
    )
    placed = stored(placed.join(sizes, F.col("block") == F.col("sized")).drop("sized"), "parts")
    nodes = _trie_units(met, placed, trees)
    total = placed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    together = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TILE_SHINGLES))
    unit = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("group"), F.lit(together))).otherwise(
        F.xxhash64("group", "low", "high")
    )
    by_block = placed.select(F.col("node").alias("placed_node"), "block", "parts")
    if nodes is not None:
        split = nodes.select(F.col("block").alias("split")).distinct()
        by_block = by_block.join(split, F.col("block") == F.col("split"), "left_anti")
    by_block = sets.join(by_block, F.col("node") == F.col("placed_node"))
    whole = [F.col("block").alias("group"), F.lit(-1).alias("tree"), "parts"]
    units = _tiles(by_block.select("node", "weight", "shingles", *whole), unit)
    if nodes is not None:
        # A class goes once to each of its trie nodes that has new pairs.
        several = placed.where("parts > 1").select(F.col("node").alias("of_large"))
        own = met.join(several, F.col("node") == F.col("of_large")).select(
            F.col("node").alias("member"), F.posexplode("prefixes").alias("tree", "prefix")
        )
        inside = own.join(
            nodes.select(
                F.col("tree").alias("in_tree"), F.col("prefix").alias("in_prefix"),
                F.col("node_parts"),
            ),
            (F.col("tree") == F.col("in_tree")) & (F.col("prefix") == F.col("in_prefix")),
        )
        copies = sets.join(inside, F.col("node") == F.col("member")).select(
            "node", "weight", "shingles", F.xxhash64("tree", "prefix").alias("group"), "tree",
            F.col("node_parts").alias("parts"),
        )
        units = units.union(_tiles(copies, F.xxhash64("group", "low", "high")))
    verify = _verify(threshold, depths, before)
    return stored(
        units.groupBy("unit").applyInArrow(verify, "a long, b long, n long, alike long"), "links"
    )


def _classes(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    words: int,
    threshold: float,
    recall: float,
    trees: int,
) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and for each set of shingles what it links with.

    The latter is (k1, k2, first, root, weight, others): `first` names the row with the
    smallest id by (no_id, doc_id, h1, h2), sets of one `root` are connected, `weight`
    rows have the set and `others` link with it. A set goes by the number that it has in
    the stored table of sets, so no two are taken for one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *_digests(text))
    signed = stored(signatures(texts, words, trees), "signatures")
    # One class for each set; its first row stands for it.
    classes = (
        signed.where("n > 0")
        .groupBy("k1", "k2", "n")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")).alias(
                "first"
            ),
            F.count("*").alias("weight"),
            F.first("tries").alias("tries"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    # No link is less alike than the threshold, so prefixes are never shorter than `least`:
    # texts move once, by id and digest at every size, so that costs grow in proportion, and
    # a text without an id of its own meets its own class only.
    full, least = [MAX_DEPTH] * trees, shortened({threshold: 1.0}, recall, trees)
    spread = _nodes(classes, least).select("node", F.explode("prefixes").alias("prefix"))
    near = spread.join(_shared(spread), F.col("prefix") == F.col("shared"))
    near = near.select(F.col("node").alias("near")).distinct()
    once = classes.select("first", "node", "k1", "k2", "weight").join(
        near, F.col("node") == F.col("near")
    )
    chosen = texts.join(once.hint("merge"), _is_first())
    sets = _shingled(
        chosen.select("node", "k1", "k2", "weight", "text"), words, {"weight": "long"}
    )
    sets = stored(sets, "sets")
    found = _links(classes, sets, threshold, full)
    depths = shortened(_similarities(found, threshold, full), recall, trees)
    if depths != full:
        found = found.union(_links(classes, sets, threshold, depths, full))
    found = found.where("alike < 0")
    counts = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("others"))
    joined = components(found.where("n = 0").select("a", "b"))
    named = classes.drop("tries").join(
        joined.select(F.col("node").alias("joined_node"), "root"),
        F.col("node") == F.col("joined_node"),
        "left",
    ).withColumn("root", F.coalesce("root", "node"))
    links = named.join(counts, F.col("node") == F.col("a"), "left").select(
        "k1", "k2", "first", "root", "weight", "others"
    )
    return signed, links


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    trees: int = TREES,
) -> DataFrame:
    """The links of every row: doc_id, n_links, class_id, kept.

    Rows link if the Jaccard similarity of their sets of shingles is `threshold` or
    more. n_links is how many other rows a row links with, copies included; class_id
    is the smallest doc_id that links reach, itself included; kept is true for the row
    that has this id. Every pair that is reported is verified on the whole sets. Pairs
    at the threshold are found with probability `recall`, more similar ones with more.

    Null texts and texts without words link with nothing and are kept. A text shorter
    than a shingle is one shingle. Repeated rows are copies, each of which is returned;
    rows without an id take part, but name a class only if it has no other row. Other
    columns are not read; an empty table gives an empty result.
    """
    signed, links = _classes(docs, id_col, text_col, words, threshold, recall, trees)
    names = links.groupBy(F.col("root").alias("named_root")).agg(
        F.min("first.doc_id").alias("class_id")
    )
    result = links.join(names, F.col("root") == F.col("named_root")).select(
        F.col("k1").alias("of_k1"),
        F.col("k2").alias("of_k2"),
        "class_id",
        (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    return signed.join(
        result,
        (F.col("k1") == F.col("of_k1")) & (F.col("k2") == F.col("of_k2")) & (F.col("n") > 0),
        "left",
    ).select(
        "doc_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("class_id", "doc_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each class of similarity_classes, all columns.

    It is the row with the smallest id; a class without ids keeps one of its rows, and
    of rows that share the smallest id one stays. Rows whose text is null or has no
    words are classes of their own. A repeated row comes once.
    """
    signed, links = _classes(docs, id_col, text_col, WORDS, THRESHOLD, RECALL, TREES)
    firsts = links.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    names = ["doc_id", "h1", "h2"]
    kept = firsts.select(names).union(signed.where("n = 0").select(names).distinct())
    copies = signed.groupBy(*names).count().withColumnRenamed("count", "_many")
    copies = copies.select(*(F.col(c).alias(f"_copy_{c}") for c in names), "_many")
    kept = kept.join(copies, _same_row("_copy_", F.col("doc_id"), F.col("h1"), F.col("h2")))
    kept = kept.select(*(F.col(c).alias(f"_kept_{c}") for c in names), "_many")
    joined = docs.join(kept, _same_row("_kept_", F.col(id_col), *_digests(F.col(text_col))))
    once = joined.where("_many = 1").select(docs.columns)
    # Only rows that are repeated are compared, and moved for it.
    repeated = joined.where("_many > 1").dropDuplicates([id_col, text_col])
    return once.union(repeated.select(docs.columns))


def _same_row(prefix: str, doc_id: Column, h1: Column, h2: Column) -> Column:
    return (
        doc_id.eqNullSafe(F.col(f"{prefix}doc_id"))
        & (h1 == F.col(f"{prefix}h1"))
        & (h2 == F.col(f"{prefix}h2"))
    )
