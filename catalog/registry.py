"""Named queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sql import rounded

Build = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    builds: dict[str, Build] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(
        self,
        name: str,
        build: Build,
        sql: str | None = None,
        digits: dict[str, int] | None = None,
    ) -> None:
        """Register a query; columns in `digits` are rounded on both sides.

        Sums of floats depend on the order of addition, so they can only be
        compared after rounding.
        """
        digits = digits or {}

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            return df.withColumns({c: F.round(c, n) for c, n in digits.items()}) if digits else df

        if name in self.builds:
            raise ValueError(f"query {name} registered twice")
        self.builds[name] = run
        if sql is not None:
            self.sql[name] = rounded(sql, digits)
