"""Drift of whole distributions: a stored profile of training data, later rows against it.

The profile holds, for each column, the edges of bins of equally many training values and
how many lie in each. It is made once; a comparison is one pass over the later rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.operators.ranks import exact_quantiles_of

BINS = 10
#: A share is at least this in the stability index, so that empty bins count but not all.
FLOOR = 1e-4
#: From here on a column has drifted: stability index, distance, share of nulls.
PSI_ALERT, KS_ALERT, NULLS_ALERT = 0.2, 0.2, 0.05
PROFILE = "column_name string, edges array<double>, n bigint, nulls bigint, counts array<bigint>"


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def histograms(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Per column n, nulls and the counts of its bins; a bin ends with its edge, included.

    NaN counts as null. All columns are counted in one pass and one aggregation.
    """

    def bin_of(c: str) -> Column:
        return sum(((_number(c) > F.lit(e)).cast("int") for e in edges[c]), F.lit(0))

    stacked = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.coalesce(F.when(_number(c).isNotNull(), bin_of(c)), F.lit(-1)).alias("bin"))
            for c in edges
        ]
    )
    counts = df.select(F.inline(stacked)).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    most = max(len(e) for e in edges.values()) + 1
    by_bin = [F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)) for b in range(most)]
    found = counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("bin") >= 0, F.col("n"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("bin") < 0, F.col("n"))), F.lit(0)).alias("nulls"),
        F.array(*by_bin).alias("counts"),
    )
    # Columns of an empty frame have a row, too.
    names = df.sparkSession.createDataFrame(
        [(c, list(map(float, e))) for c, e in edges.items()], "name string, edges array<double>"
    )
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.size("edges") + 1)
    return names.join(found, F.col("name") == F.col("column_name"), "left").select(
        F.col("name").alias("column_name"),
        "edges",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.coalesce("nulls", F.lit(0)).cast("bigint").alias("nulls"),
        F.coalesce(F.slice("counts", F.lit(1), F.size("edges") + 1), zeros).alias("counts"),
    )


def profile(train: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """The profile of `columns`, a row each: edges, n, nulls, counts.

    Edges are the exact quantiles at 1/bins, 2/bins, ..., equal ones once; a column
    without values has none, and one bin.
    """
    probs = [i / bins for i in range(1, bins)]
    cuts = {
        r.column_name: sorted(set(r.quantiles or []) - {None})
        for r in exact_quantiles_of(train, columns, probs).collect()
    }
    return histograms(train, {c: cuts[c] for c in columns})


def _shares(counts: str, n: str) -> Column:
    return F.transform(counts, lambda x: x / F.nullif(F.col(n), F.lit(0)))


def _cumulative(shares: str) -> Column:
    steps = F.sequence(F.lit(1), F.size(shares))
    start = F.lit(0.0)
    return F.transform(steps, lambda i: F.aggregate(F.slice(shares, F.lit(1), i), start, lambda a, x: a + x))


def compared(
    known: DataFrame,
    latest: DataFrame,
    psi_alert: float = PSI_ALERT,
    ks_alert: float = KS_ALERT,
    nulls_alert: float = NULLS_ALERT,
    floor: float = FLOOR,
) -> DataFrame:
    """How the columns of `latest` have drifted from a profile, a row each.

    n_before, n_since: values; null_share_before, null_share_since; psi: the population
    stability index over the bins, shares of less than `floor` counted as `floor`; ks:
    the greatest distance of the cumulative shares at the edges; alert: any of them, or
    the change in the share of nulls, is at its threshold. psi and ks are null where one
    side has no values, which is an alert if the other has.
    """
    rows = known.collect()  # a row for each column
    now = histograms(latest, {r.column_name: list(r.edges) for r in rows})
    both = known.select(
        "column_name", F.col("n").alias("n_before"), F.col("nulls").alias("_nulls_before"),
        F.col("counts").alias("_before"),
    ).join(
        now.select(
            "column_name", F.col("n").alias("n_since"), F.col("nulls").alias("_nulls_since"),
            F.col("counts").alias("_since"),
        ),
        "column_name",
    )
    shares = both.withColumns(
        {"_p": _shares("_before", "n_before"), "_q": _shares("_since", "n_since")}
    )

    def stability(p: Column, q: Column) -> Column:
        p, q = F.greatest(p, F.lit(floor)), F.greatest(q, F.lit(floor))
        return (q - p) * F.log(q / p)

    zero = F.lit(0.0)
    known_both = (F.col("n_before") > 0) & (F.col("n_since") > 0)
    psi = F.aggregate(F.zip_with("_p", "_q", stability), zero, lambda a, x: a + x)
    far = F.array_max(
        F.zip_with(_cumulative("_p"), _cumulative("_q"), lambda a, b: F.abs(a - b))
    )

    def null_share(nulls: str, n: str) -> Column:
        return F.col(nulls) / F.nullif(F.col(nulls) + F.col(n), F.lit(0))

    measured = shares.select(
        "column_name",
        "n_before",
        "n_since",
        null_share("_nulls_before", "n_before").alias("null_share_before"),
        null_share("_nulls_since", "n_since").alias("null_share_since"),
        F.when(known_both, psi).alias("psi"),
        F.when(known_both, far).alias("ks"),
    )
    moved = F.abs(F.col("null_share_since") - F.col("null_share_before")) >= nulls_alert
    one_side = (F.col("n_before") > 0) != (F.col("n_since") > 0)
    alerts = [F.col("psi") >= psi_alert, F.col("ks") >= ks_alert, moved, one_side]
    return measured.withColumn("alert", F.greatest(*[F.coalesce(a, F.lit(False)) for a in alerts]))
