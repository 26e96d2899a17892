"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table, tasks_for


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): ``m`` is the smallest of u and its neighbours. Minima are
    taken before the join, so a node with very many edges sends one row per task."""
    low = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return edges.join(low, F.expr("u = _u")).select("u", "v", F.least("u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    got = _lowest(down)
    return got.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")


def connected_components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """``a, b`` links -> ``node, component`` for every node with a link (component: its
    smallest reachable node; that node itself is not listed). Each pass is written under
    the checkpoint folder; the number of passes grows with the logarithm of a
    component's diameter, and nothing but a row count and a checksum reaches the driver. ``tasks``: of the first table, as of
    ``stage_table``; a pass makes at most two rows of one, so the later ones follow the count."""
    now = stage_table(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges", tasks)
    seen = None
    while True:
        sums = now.selectExpr("count(1) AS n", "coalesce(sum(pmod(xxhash64(u, v), 4294967296)), 0) AS h").first()
        if tuple(sums) == seen or not sums["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = tuple(sums)
        passed = _small_star(_large_star(now).distinct()).where("u <> v").distinct()
        now = stage_table(passed, "edges", tasks_for(edges.sparkSession, 2 * sums["n"]))
