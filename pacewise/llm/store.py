"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.session import ensure_checkpoint_dir, ship_package

__all__ = ["ascii_lower", "shared_folder", "ship_package", "stored"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under `spark.checkpoint.dir`; nothing is created yet."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write `df` as Parquet, with the writer's `options`, to the shared folder and read it.

    Like checkpoint(), but columnar and compressed, and Spark knows the size of
    what it reads, so that it can tell whether a side fits a broadcast.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty. Texts of ASCII take the fast way."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )
