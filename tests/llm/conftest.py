from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents with an extra column whose names the operators use themselves."""

    def make(rows, schema="doc_id long, text string, source string"):
        df = spark.createDataFrame(rows, schema)
        return df.select(
            "*",
            F.lit("x").alias("keep_id"),
            F.lit("y").alias("n"),
            F.lit("z").alias("node"),
            F.lit("v").alias("taken"),
            F.lit("w").alias("shard"),
        )

    return make


def sentence(seed: int, words: int = 60) -> str:
    """Words that differ between seeds."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 99991}" for i in range(words))
