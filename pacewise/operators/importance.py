"""Permutation importance: what a model loses when a feature is another row's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.operators.ranks import hash_position
from pacewise.session import cut

Score = Callable[[DataFrame, str], DataFrame]


def _positions(rows: DataFrame, salt: str, keep: list[str], out: str) -> DataFrame:
    """`keep` and the place of every row in an order of its own."""
    salted = rows.withColumn("_salt", F.lit(salt))
    placed = hash_position(salted, salted.columns)
    return placed.select(*keep, F.col("position").alias(out))


def permuted(holdout: DataFrame, features: list[str], keep: list[str], seed: int = 1) -> DataFrame:
    """Every row once as it is and once for each feature, with that feature of another row.

    `permuted` names the feature, null in the row as it is. The other row is the one whose
    place in a second order by hash is this row's in the first: a permutation of the rows,
    one for all features, from one join on the place. `keep` are further columns to pass on.
    """
    rows = holdout.select(*features, *[c for c in keep if c not in features])
    own = _positions(rows, f"own {seed}", rows.columns, "_place")
    donor = _positions(rows, f"other {seed}", features, "_from").select(
        "_from", *[F.col(f).alias(f"_of_{f}") for f in features]
    )
    paired = own.join(donor, F.col("_place") == F.col("_from"))
    names = F.array(F.lit(None).cast("string"), *[F.lit(f) for f in features])
    spread = paired.withColumn("permuted", F.explode(names))
    return spread.select(
        "permuted",
        *[c for c in rows.columns if c not in features],
        *[
            F.when(F.col("permuted").eqNullSafe(F.lit(f)), F.col(f"_of_{f}")).otherwise(F.col(f)).alias(f)
            for f in features
        ],
    )


def permutation_importances(
    score: Score, holdout: DataFrame, features: list[str], label: str, seed: int = 1
) -> DataFrame:
    """(feature, base_error, permuted_error, importance) by the mean squared error.

    `score(df, out)` adds the model's score. A feature that the model doesn't use, or that
    is the same in all rows, has importance 0; one that misleads it may have less. Rows
    without the label are left out; without any the result is empty. All copies of a row
    are made and scored where it is, and only sums are moved.
    """
    rows = cut(permuted(holdout.dropna(subset=[label]), features, [label], seed))
    scored = score(rows, "_score")
    error = (F.col(label).cast("double") - F.col("_score")) ** 2
    errors = scored.groupBy("permuted").agg(F.avg(error).alias("error"))
    base = errors.where(F.col("permuted").isNull()).select(F.col("error").alias("base_error"))
    by_feature = errors.where(F.col("permuted").isNotNull())
    # One row beside as many as there are features.
    first = base.first()
    value = F.lit(first[0] if first else None).cast("double")
    return by_feature.select(
        F.col("permuted").alias("feature"),
        value.alias("base_error"),
        F.col("error").alias("permuted_error"),
        (F.col("error") - value).alias("importance"),
    )
