"""Merkle dataset manifest with nested-interval labels.

Rows are leaves of one tree per group (a source); the groups' roots are leaves of one
tree above. A node is labelled with the interval of leaf ranks it covers. Three steps,
all over Spark tables:

* ``ranked``: leaves are range partitioned in order, numbered in place, and the numbers
  shifted by what the partitions before hold, so that a group of any size is ranked by
  many tasks.
* ``build``: every 3 consecutive nodes become one. ``BAND`` levels are made at a time:
  the ``WIDTH`` nodes below one node of the next band meet in one row, so a tree of n
  leaves takes log(n) / log(WIDTH) shuffles, each ``WIDTH`` times smaller than the last.
* ``attach``: a containment join per band, bucketed by the band node's interval, gives
  each member the nodes of that band whose interval holds its rank. Of a node's children,
  those whose intervals lie before the member's rank are its left siblings, those after it the
  right ones. Bands are worked through from the top: a band node's own path, the
  group's path to the root included, is passed on to its members, so a level's siblings are
  looked up once per band node, not once per leaf.

A step of a path is (left siblings, right siblings); ``fold_sql`` recomputes a root from
a leaf and its path, ``proof_sql`` digests the siblings.

Defined cases: a null field is ``-``; a null source is a group of its own, first in
order; null doc_ids come first in their group and are never tampered; rows with one doc_id are leaves
of their own in the order of their digests (equal rows are interchangeable); an empty
text is a value of 0 bytes; very long texts are hashed whole; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

ARITY = 3
BAND = 4                # levels made at a time
WIDTH = ARITY ** BAND   # members of a band node
#: Columns of a documents row that make up its leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_sql(**replaced: str) -> str:
    """Digest of a row's fields; ``replaced`` gives another expression for a field."""
    values = [f"cast({replaced.get(c, f'`{c}`')} AS STRING)" for c in FIELDS]
    parts = ", ".join(f"coalesce(concat(octet_length({v}), ':', {v}), '-')" for v in values)
    return f"sha2(concat({parts}), 256)"


def height_sql(n: str = "n") -> str:
    """Levels above ``n`` leaves: the least h with 3^h >= n."""
    return "CASE " + " ".join(f"WHEN {n} <= {ARITY ** h}L THEN {h}" for h in range(39)) + " ELSE 39 END"


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``rank`` (from 0, within ``g`` in the given order) and ``n`` (rows of ``g``)."""
    ordered = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ordered = stage_table(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    # one row per group and partition
    parts = ordered.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy("g")
    before = F.sum("c").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("c").over(whole).alias("n"))
    return ordered.join(parts, ["g", "part"]).withColumn("rank", F.expr("at - first + before")).drop("part", "first", "before", "at")


def build(leaves: DataFrame) -> list[DataFrame]:
    """``g, n, rank, leaf`` -> one staged table per band: ``g, n, height, bucket, levels``,
    where ``levels[0]`` are the digests the band starts from and the last level is one node."""
    bands: list[DataFrame] = []
    rows = leaves.selectExpr("g", "n", f"{height_sql()} AS height", "rank", "leaf AS digest")
    while True:
        b = len(bands)
        got = rows.groupBy("g", "n", "height", F.expr(f"rank div {WIDTH}").alias("bucket")).agg(
            F.expr("transform(sort_array(collect_list(struct(rank, digest))), x -> x.digest)").alias("l0"))
        for j in range(BAND):
            got = got.withColumn(f"l{j + 1}", F.expr(
                f"transform(sequence(0, (size(l{j}) - 1) div {ARITY}), i -> sha2(array_join(slice(l{j}, {ARITY} * i + 1, {ARITY}), ''), 256))"))
        levels = ", ".join(f"l{j}" for j in range(BAND + 1))
        got = got.selectExpr("g", "n", "height", "bucket", f"slice(array({levels}), 1, 1 + least({BAND}, height - {BAND * b})) AS levels")
        bands.append(stage_table(got, f"band{b}"))
        rows = bands[-1].where(f"height > {BAND * (b + 1)}").selectExpr("g", "n", "height", "bucket AS rank", "element_at(element_at(levels, -1), 1) AS digest")
        if rows.isEmpty():
            return bands


def _ends(band: DataFrame, b: int) -> DataFrame:
    """The band nodes that are the root of their group."""
    return band.where(f"height <= {BAND * (b + 1)}")


def roots(bands: list[DataFrame]) -> DataFrame:
    """``g, root`` of every group."""
    out = None
    for b, band in enumerate(bands):
        one = _ends(band, b).selectExpr("g", "element_at(element_at(levels, -1), 1) AS root")
        out = one if out is None else out.unionByName(one)
    return out


def _nodes(band: DataFrame, b: int) -> DataFrame:
    """The nodes of a band with their leaf-rank intervals: ``g, bucket, level, lo, hi, kids``."""
    unit = WIDTH ** b
    lo = f"(bucket * {WIDTH}L + i * cast(pow({ARITY}, j) AS BIGINT)) * {unit}L"
    step = f"cast(pow({ARITY}, j - 1) AS BIGINT) * {unit}L"
    kid = f"named_struct('lo', {lo} + k * {step}, 'hi', least(n, {lo} + (k + 1) * {step}), 'digest', c)"
    node = (f"named_struct('level', {BAND * b} + j, 'lo', {lo}, 'hi', least(n, {lo} + {ARITY} * {step}), "
            f"'kids', transform(slice(levels[j - 1], {ARITY} * i + 1, {ARITY}), (c, k) -> {kid}))")
    above = f"slice(sequence(0, size(levels) - 1), 2, {BAND})"
    return band.select("g", "bucket", F.expr(f"inline(flatten(transform({above}, j -> transform(levels[j], (d, i) -> {node}))))"))


_STEP = """CASE WHEN level IS NOT NULL THEN named_struct('level', level,
    'l', array_join(transform(filter(kids, x -> x.hi <= start), x -> x.digest), ''),
    'r', array_join(transform(filter(kids, x -> x.lo > start), x -> x.digest), '')) END"""


def attach(members: DataFrame, bands: list[DataFrame], top: DataFrame) -> DataFrame:
    """Members ``g, rank`` (and more columns) with ``path``: the siblings on the way to the
    root of ``g``, then the path that ``top`` (``g, path`` and more columns) gives for ``g``."""
    extra = [c for c in top.columns if c not in ("g", "path")]
    mine = [c for c in members.columns if c not in ("g", "rank", *extra)]
    given = None
    for b in reversed(range(len(bands))):
        unit = WIDTH ** b
        onward = _ends(bands[b], b).select("g", "bucket").join(top, "g").select("g", "bucket", "path", *extra)
        if given is not None:
            onward = onward.unionByName(given)
        rows = members if not b else bands[b - 1].where(f"height > {BAND * b}").selectExpr("g", "bucket AS rank")
        mine_here = mine if not b else []
        rows = rows.selectExpr("g AS _g", f"rank div {WIDTH} AS _bucket", f"rank * {unit}L AS start", "rank", *mine_here)
        held = rows.join(_nodes(bands[b], b), F.expr("_g = g AND _bucket = bucket AND lo <= start AND start < hi"), "left")
        steps = held.groupBy("_g", "_bucket", "rank", *mine_here).agg(
            F.expr(f"transform(sort_array(collect_list({_STEP})), x -> named_struct('l', x.l, 'r', x.r)) AS steps"))
        got = steps.join(onward, F.expr("_g = g AND _bucket = bucket")).withColumn("path", F.expr("concat(steps, path)"))
        if not b:
            return got.select("g", "rank", *mine, "path", *extra)
        given = stage_table(got.select("g", F.col("rank").alias("bucket"), "path", *extra), "paths")


def fold_sql(leaf: str, path: str = "path") -> str:
    """The root that a leaf and its siblings give."""
    return f"aggregate({path}, {leaf}, (h, x) -> sha2(concat(x.l, h, x.r), 256))"


def proof_sql(path: str = "path") -> str:
    """Digest of all siblings, level by level, left to right."""
    return f"sha2(array_join(transform({path}, x -> concat(x.l, x.r)), ''), 256)"


def manifest(docs: DataFrame, tampered: str | None = None, changed: str = "text") -> DataFrame:
    """Every row's place in the manifest: ``doc_id, leaf, subroot, root, path, seen``.

    ``seen`` is the leaf as a reader would find it: where the condition ``tampered``
    holds, that of the row with ``changed`` as its text; else the leaf itself."""
    leaf = leaf_sql()
    seen = leaf if tampered is None else f"CASE WHEN {tampered} THEN {leaf_sql(text=changed)} ELSE {leaf} END"
    rows = docs.selectExpr("doc_id", "coalesce(concat('s', source), '') AS g", f"{leaf} AS leaf", f"{seen} AS seen")
    # equal rows: any order is right; their running number lets them be split
    rows = stage_table(rows.withColumn("seq", F.monotonically_increasing_id()), "leaves")
    leaves = stage_table(ranked(rows, "doc_id", "leaf", "seq").drop("seq"), "ranked")
    bands = build(leaves)
    # the groups' roots are the leaves of the tree above
    subs = roots(bands).selectExpr("'' AS g", "g AS source", "root AS leaf")
    subs = stage_table(ranked(subs, "source"), "subroots")
    above = build(subs)
    top = roots(above).selectExpr("g", "cast(array() AS array<struct<l: string, r: string>>) AS path", "root")
    placed = attach(subs.select("g", "rank", "source", F.col("leaf").alias("subroot")), above, top)
    placed = stage_table(placed.select(F.col("source").alias("g"), "path", "subroot", "root"), "subroot-paths")
    return attach(leaves.select("g", "rank", "doc_id", "leaf", "seen"), bands, placed)


def verify(docs: DataFrame, tampered: str, changed: str) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: do the leaves
    as found still lead to the manifest's root?"""
    out = manifest(docs, tampered, changed).selectExpr(
        "doc_id", "leaf", "subroot", "root", f"{proof_sql()} AS proof_sha256", f"{fold_sql('seen')} AS folded_root")
    return out.withColumn("verified", F.expr("folded_root = root"))
