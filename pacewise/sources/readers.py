"""CSV scans of the raw files and their casts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.measures import day, to_number
from pacewise.sources import schemas as S


def _scan(spark: SparkSession, path: str, table: str) -> DataFrame:
    return (
        spark.read.schema(S.raw_schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        # A quote inside quoted text is doubled; a backslash is text.
        .option("escape", '"')
        .csv(path)
    )


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_strict(
    spark: SparkSession, path: str, table: str, date_col: str | None = None
) -> DataFrame:
    """Text scan that fails on a missing path; `date_col` is parsed day-first."""
    try:
        df = _scan(spark, path, table)
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(path) from error
        raise
    return df if date_col is None else df.withColumn(date_col, day(date_col))


def read_tolerant(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Text scan; a missing path gives an empty frame of the same schema."""
    try:
        return _scan(spark, path, table)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], S.raw_schema(table))
        raise


def rejects(raw: DataFrame, date_col: str = S.DATE) -> DataFrame:
    """Rows that can't be loaded as they are, with `reason`.

    A date is accepted as day, month and year with slashes, each with or without a
    leading zero. Other date texts, such as 2024-08-01 or 01-08-2024, are rejected.
    """
    if date_col not in raw.columns:
        return raw.filter(F.lit(False)).withColumn("reason", F.lit(""))
    lost = F.col(date_col).isNotNull() & day(date_col).isNull()
    return raw.filter(lost).withColumn("reason", F.lit(f"{date_col} is no d/M/yyyy date"))


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Non-strict casts of the named columns; other columns pass through."""
    return df.withColumns(
        {c: F.col(c).cast(t) if t == "string" else to_number(c, t) for c, t in types.items()}
    )


def cast_table(df: DataFrame, table: str) -> DataFrame:
    """Non-strict casts to the table's declared types."""
    return cast_columns(df, S.RAW_TYPES[table])


def cast_all_but(df: DataFrame, keep: list[str], kind: str = "double") -> DataFrame:
    """Cast every column except `keep`."""
    return cast_columns(df, {c: kind for c in df.columns if c not in keep})
