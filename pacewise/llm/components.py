"""Connected components of a graph of links, and small helpers for link matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.store import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """The smallest id reachable from each id that has an edge: node, root.

    `edges` has long columns a and b; direction, repetition and loops don't matter,
    nulls are ignored. Large-star and small-star steps alternate until nothing
    changes, a few rounds in practice and a number that grows with the logarithm of
    the longest chain. A step keeps one edge per node at most, apart from those still
    to be moved, and never lists the pairs of a component.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = stored(pairs.where("a > b").distinct(), "edges")
    before = None
    while (now := _fingerprint(stars)) != before:
        before = now
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            stars.select("b", "a")
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = stored(
            both.where("v > u")
            .join(least, F.col("u") == F.col("w"))
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct(),
            "large",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least.withColumnRenamed("a", "w"), F.col("a") == F.col("w"))
        stars = stored(
            moved.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct(),
            "stars",
        )
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(stars.select("b", "b").distinct())


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j) that connect what a square symmetric link matrix connects, one per row at most."""
    size = len(links)
    label = np.arange(size)
    while True:
        near = np.where(links, label[None, :], size).min(axis=1, initial=size)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(size))
    return moved, label[moved]
