"""Budget reallocation between ad sets of low and high ROAS."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.operators.ranks import exact_quantiles
from pacewise.session import cut
from pacewise.sources import schemas as S


def reallocation(
    per_ad_set: DataFrame,
    shift: float = 0.1,
    elasticity: float = 0.8,
    curve: str = "power",
    neutral: bool = False,
) -> DataFrame:
    """New spend and projected revenue per ad set.

    Ad sets at or below the lower ROAS quartile give up `shift` of their spend;
    those at or above the upper one share `shift` of the *total* spend by their
    own spend. That adds spend overall; `neutral` hands over only what was given
    up. The curve is "power" (roas * new^e / old^(e-1)) or "linear"
    (roas * new * e). With equal quartiles an ad set can be in both groups and is
    then listed once for each. No rows unless there are four ad sets and spend.
    """
    if curve not in ("power", "linear"):
        raise ValueError(f"unknown curve {curve!r}")
    base = cut(per_ad_set.select(S.AD_SET, "spend", "revenue", "roas"))
    q1, q3 = exact_quantiles(base, "roas", [0.25, 0.75]).first()["quantiles"]
    low, high = F.col("roas") <= q1, F.col("roas") >= q3
    totals = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("spend"), F.lit(0.0)).alias("spend"),
        F.coalesce(F.sum(F.when(low, F.col("spend"))), F.lit(0.0)).alias("bottom_spend"),
        F.coalesce(F.sum(F.when(high, F.col("spend"))), F.lit(0.0)).alias("top_spend"),
        F.count_if(low).alias("bottom"),
        F.count_if(high).alias("top"),
    ).first()
    groups = F.array_compact(
        F.array(
            F.when(low, F.lit("bottom")),
            F.when(~low & ~high, F.lit("middle")),
            F.when(high, F.lit("top")),
        )
    )
    pot = totals["bottom_spend"] if neutral else totals["spend"]
    gain = pot * shift * (F.col("spend") / max(totals["top_spend"], 1e-9))
    spend_new = (
        F.when(F.col("quartile") == "bottom", F.col("spend") * (1 - shift))
        .when(F.col("quartile") == "top", F.col("spend") + gain)
        .otherwise(F.col("spend"))
    )
    if curve == "power":
        old = F.when(F.col("spend") == 0, F.lit(1e-9)).otherwise(F.col("spend"))
        projected = F.col("roas") * F.pow("spend_new", F.lit(elasticity)) / F.pow(
            old, F.lit(elasticity - 1)
        )
    else:
        projected = F.col("spend_new") * F.col("roas") * elasticity
    usable = totals["n"] >= 4 and totals["spend"] > 0 and totals["bottom"] and totals["top"]
    return (
        base.filter(F.lit(bool(usable)))
        .withColumn("in_both", low & high)
        .withColumn("quartile", F.explode(groups))
        .withColumn("spend_new", spend_new)
        .withColumn("revenue_proj", projected)
        .select(
            S.AD_SET,
            "quartile",
            "in_both",
            "spend",
            "spend_new",
            "roas",
            "revenue",
            "revenue_proj",
        )
    )


def reallocation_summary(plan: DataFrame) -> DataFrame:
    """Base and projected revenue, the uplift with its range, and the added spend.

    An ad set listed for both groups counts once in the base.
    """
    once = ~(F.col("in_both") & (F.col("quartile") == "top"))
    sums = plan.agg(
        F.sum(F.when(once, F.col("revenue"))).alias("base_revenue"),
        F.sum("revenue_proj").alias("projected_revenue"),
        (F.sum("spend_new") - F.sum(F.when(once, F.col("spend")))).alias("spend_delta"),
    )
    uplift = F.col("projected_revenue") - F.col("base_revenue")
    return sums.withColumns(
        {"uplift": uplift, "uplift_low": uplift * 0.8, "uplift_high": uplift * 1.2}
    )
