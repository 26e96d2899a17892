"""Join helpers: counted lookups, dimension joins, and row copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row that are made from one array.
CHUNK = 10_000


def multiplicity(lookup: DataFrame, key: str | Column, name: str) -> DataFrame:
    """``key -> number of rows`` of a lookup used only for its existence.

    Counting is partially aggregated before the shuffle, so a key that holds a large
    share of the lookup sends one row per map task, not all its rows, to one reducer.
    """
    if isinstance(key, str):
        k = "`" + key.replace("`", "``") + "`"
        return lookup.where(f"{k} IS NOT NULL").groupBy(F.expr(f"{k} AS _k")).agg(F.expr(f"count(1) AS {name}"))
    return lookup.where(key.isNotNull()).groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias(name))


def counted_lookup(df: DataFrame, lookup: DataFrame, left_keys: list[str], right_keys: list[str], name: str,
                   only: str = "") -> DataFrame:
    """Left join to a value lookup reduced to distinct (keys, values) with a count.

    The lookup's columns besides ``right_keys`` are its values; ``name`` is the count of
    equal lookup rows (null without a match). Whatever share of the lookup one key
    holds, it reaches the join as its distinct values only, combined map-side. ``only``
    (`` AND ...``) limits the match to some rows of ``df``."""
    some = " AND ".join(f"{k} IS NOT NULL" for k in right_keys)
    one = lookup.where(some).groupBy(*lookup.columns).agg(F.count(F.lit(1)).alias(name))
    on = " AND ".join(f"{a} = {b}" for a, b in zip(left_keys, right_keys))
    return df.join(one, F.expr(on + only), "left").drop(*right_keys)


def counted_classes(lookup: DataFrame, key: str, classes: dict[str, str]) -> DataFrame:
    """One row per key (``_k``) of a lookup whose values fall into few known classes: for each
    ``column: condition`` the number of rows it holds for. Combined map-side, and by the key
    alone, so the join to the leads needs no further exchange."""
    counts = [F.expr(f"count_if({condition}) AS {name}") for name, condition in classes.items()]
    return lookup.where(f"`{key}` IS NOT NULL").groupBy(F.col(key).alias("_k")).agg(*counts)


def salt_width(df: DataFrame, asked: int | None = None) -> int:
    """Tasks over which one key of a dimension join is spread: what was asked for, else 1
    where Spark splits hot partitions itself (adaptive skew joins), else the session's shuffle partitions."""
    if asked:
        return asked
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true" and conf.get("spark.sql.adaptive.skewJoin.enabled") == "true":
        return 1
    return int(conf.get("spark.sql.shuffle.partitions"))


def join_dimension(df: DataFrame, dimension: DataFrame, on: dict[str, str], how: str, salt: str, asked: int | None = None,
                   only: str = "") -> DataFrame:
    """Join to a small table on a key of few distinct values: ``on`` maps expressions of ``df``
    to (not null) columns of the dimension, ``only`` limits the match to some rows of ``df``.

    With a salt width above 1 the dimension is repeated once per salt value and the join
    also matches a salt of the large side's column ``salt``: rows of one key then meet in that
    many tasks, whichever join Spark picks. Whether the dimension is broadcast is Spark's decision."""
    width = salt_width(df, asked)
    dimension = dimension.where(" AND ".join(f"{c} IS NOT NULL" for c in on.values()))
    if width == 1:
        return df.join(dimension, F.expr(" AND ".join(f"{a} = {b}" for a, b in on.items()) + only), how)
    many = dimension.withColumn("_dsalt", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    left = one_key(*on, f"pmod(xxhash64({salt}), {width})")
    return df.join(many, F.expr(f"{left} = {one_key(*on.values(), 'CAST(_dsalt AS BIGINT)')}{only}"), how).drop("_dsalt")


def one_key(*parts: str) -> str:
    """Several key parts as one join key. With keys of their own, Spark may deal both sides by
    a part that one side is partitioned by already, which a slice or salt must prevent. No part
    may be null on both sides (struct equality takes nulls as equal)."""
    return "named_struct(" + ", ".join(f"'k{i}', {p}" for i, p in enumerate(parts)) + ")"


def copies_sql(*counts: str) -> str:
    """BIGINT: rows that left joins with these (nullable) match counts produce."""
    return " * ".join(f"coalesce(CAST({c} AS BIGINT), 1L)" for c in counts) or "1L"


def expand(df: DataFrame, *counts: str, tasks: int | None = None) -> DataFrame:
    """Re-create the row multiplication of left joins whose matches were counted.

    A left join to a lookup with ``n`` matches yields ``n`` copies (1 when none); with
    several lookups the copies multiply. Copies are made in chunks: first one row per
    ``CHUNK`` copies, then the copies of each chunk, so no array grows with the count.
    With ``tasks`` the chunks are dealt to that many tasks first (one exchange of rows and chunks,
    not of copies), so the copies of one row leave several tasks; without it they leave one.
    """
    n = copies_sql(*counts)
    chunks = df.selectExpr("*", f"{n} AS _copies", f"explode(sequence(0L, ({n} - 1L) div {CHUNK})) AS _chunk")
    if tasks:
        chunks = chunks.repartition(tasks, *[F.col("`" + c.replace("`", "``") + "`") for c in chunks.columns])
    return chunks.selectExpr("*", f"explode(sequence(1L, least({CHUNK}L, _copies - _chunk * {CHUNK}))) AS _copy") \
        .drop("_copies", "_chunk", "_copy")
