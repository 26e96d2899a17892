"""Annual club calculation: quarter tiers and weighted net premium pivoted per
partner, annual club with and without the crown rule, and the first-quarter pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import eq, key
from ..sources.catalog import Catalog

# Club thresholds on total weighted net premium (with the crown count
# each needs) and pass thresholds on the first quarter (half the club thresholds).
CLUBS = (("One Club", 25000000, 3), ("CBO", 15000000, 2), ("Masters", 7500000, 1))
PASSES = (("Paris Pass", 25000000 // 2), ("Armenia Pass", 15000000 // 2), ("Dubai Pass", 7500000 // 2))
QUARTER_PREFIX = {"Q1-JFM": "JFM", "Q2-AMJ": "AMJ", "Q3-JAS": "JAS", "Q4-OND": "OND"}
CROWN = "Crown"


def _ladder(arms) -> Column:
    out = None
    for cond, label in arms:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def annual_clubs(cat: Catalog, year: int, condition: Column | None = None) -> DataFrame:
    """One row per partner with a quarterly record in ``year``, sorted by total
    weighted net premium (largest first, NULL last).

    The pivot is a single hash aggregation over the partner key with conditional
    aggregates (partial aggregation before the shuffle, so a partner with many rows
    is combined map-side); no join is needed."""
    t = cat.table("partner_quarter").where(F.col("CalendarYear") == year)
    aggs = []
    crown = None
    for label, tag in QUARTER_PREFIX.items():
        in_q = eq("Quarter", label)
        # the greatest tier under the collation; of its spellings the greatest
        aggs.append(F.max(F.when(in_q, F.struct(key("Tier"), F.col("Tier"))))["Tier"].alias(f"{tag}_Club"))
        aggs.append(F.sum(F.when(in_q, F.col("WeightedNet")).otherwise(F.lit(0))).alias(f"{tag}_NWP"))
        c = F.when(in_q & eq("Tier", CROWN), F.lit(1)).otherwise(F.lit(0))
        crown = c if crown is None else crown + c
    aggs.append(F.sum(crown).alias("Crown_Count"))
    g = t.groupBy(key("PartnerCode").alias("PartnerCode")).agg(*aggs)
    total = F.col("JFM_NWP") + F.col("AMJ_NWP") + F.col("JAS_NWP") + F.col("OND_NWP")
    g = g.withColumn("Total_NWP", total)
    nwp = F.col("Total_NWP")
    out = g.select(
        "PartnerCode",
        *[F.col(f"{tag}_{k}").cast("double").alias(f"{tag}_{k}") if k == "NWP" else F.col(f"{tag}_{k}")
          for tag in QUARTER_PREFIX.values() for k in ("Club", "NWP")],
        "Crown_Count",
        nwp.cast("double").alias("Total_NWP"),
        _ladder([(nwp >= F.lit(amt), label) for label, amt, _ in CLUBS]).alias("Annual_Club"),
        _ladder([((nwp >= F.lit(amt)) & (F.col("Crown_Count") >= n), label) for label, amt, n in CLUBS])
        .alias("Annual_Club_with_Crown_Logic"),
        _ladder([(F.col("JFM_NWP") >= F.lit(amt), label) for label, amt in PASSES]).alias("JFM_Pass"),
    )
    if condition is not None:
        out = out.where(condition)
    return out.orderBy(F.col("Total_NWP").desc_nulls_last())
