"""Mixing sources to target weights (DataFrame functions only).

Tokens are counted per source, target sizes follow from the sources' weights, and each
document of a source with repetition rate ``target / size`` is taken ``floor(rate)``
times plus once more when a hash of its id and a seed falls below the fraction.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; repeated rows with one id get the same decision each; a null id is hashed as an
empty one; a source without words has target 0 and its documents are not taken; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import salted_join, stage_table, words_sql

SALTS = 32


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, size`` rows -> ``source, source_size, target``: one row per source.

    Sources in code point order (null last) take the weights in turn and share
    ``share`` times all words by weight. No target exceeds ``most`` times its source;
    the excess goes to the others by weight. With ``cap = most * size`` the targets are
    ``min(cap, level * weight)`` for the one level at which they add up: with sources in
    order of ``cap / weight``, the greatest of ``(total - caps before) / weights from
    here on``. The windows run over one row per source, after aggregation."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    by = by.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    by = by.withColumn("at", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    return by.select("source", "source_size", F.least("cap", F.max("at").over(every) * F.col("weight")).alias("target"))


def copies_sql(seed: str) -> str:
    """Copies of a document from ``rate`` and a hash of seed and id in [0, 1)."""
    unit = f"cast(conv(substr(md5(concat('{seed}:', coalesce(cast(doc_id AS STRING), ''))), 1, 13), 16, 10) AS BIGINT) / 4503599627370496D"
    return f"cast(floor(rate) AS BIGINT) + CASE WHEN {unit} < rate - floor(rate) THEN 1L ELSE 0L END"


def plan_mix(docs: DataFrame, seed: str = "mix-1", weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, text, source`` -> ``doc_id, size, source_size, target, copies, taken``."""
    sizes = stage_table(docs.selectExpr("doc_id", "source", f"cast(size({words_sql()}) AS BIGINT) AS size"), "mix-sizes")
    targets = source_targets(sizes, weights, share, most)
    return _with_copies(sizes, targets, seed).selectExpr(
        "doc_id", "size", "source_size", "target", "copies", "copies * size AS taken")


def _with_copies(sizes: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    out = salted_join(sizes, targets, "source", F.col("doc_id"), SALTS)
    out = out.withColumn("rate", F.expr("CASE WHEN source_size > 0 THEN target / source_size ELSE 0D END"))
    return out.withColumn("copies", F.expr(copies_sql(seed)))


def mix(docs: DataFrame, seed: str = "mix-1", weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed documents themselves, each row as often as it is taken, columns as given.

    A row is repeated at most ``ceil(most)`` times. The texts are joined to the targets
    in place; only sizes per source are aggregated."""
    names = docs.columns
    size = f"cast(size({words_sql()}) AS BIGINT)"
    targets = stage_table(source_targets(docs.selectExpr("source", f"{size} AS size"), weights, share, most), "mix-targets")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "doc_id", "source")
    out = _with_copies(inner, targets, seed).where("copies > 0")
    return out.select("_row", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).select("_row.*")
