"""Exact top-k inner-product search by the three-phase uniform threshold method.

A vector's components are cut into ``lists`` slices; a query's score is the sum of its
partial scores over the slices, and each block of vectors holds one local score list
per slice.

1. Every block reads one of its local lists (blocks take the slices in turn), resolves
   the whole scores of the ``lead * k`` entries at its top and sends the k best; the k-th
   best over all blocks is a safe cutoff ``t``.
2. The cutoff goes back to the blocks. A vector that reaches ``t`` has a partial score of
   at least ``t / lists`` in some list. The blocks read all lists but one and collect the
   vectors that have shown such an entry, or may show one in the list that is left, and
   whose score may still come up to ``t``; norms bound what is left.
3. The list that is left is read for the collected entries only, half by half with
   the same bound between; of those that reach the cutoff, a block returns its k best,
   which are ranked over all blocks.

Queries and vectors meet block by block (``query_block`` x ``block`` rows at a time);
neither side is ever whole in one task. Products and sums are exact integers (in doubles
below 2**53, in int64 beyond).

Defined cases: vectors that are null, empty, or hold a null or non-finite component take
no part, neither do null ids; rows with one id are one vector (the smallest by
components); a shorter vector counts as padded with zeros; ties go to the smaller id; components
must be small enough for a score to fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table


@dataclass(frozen=True)
class Threshold:
    k: int = 10
    lists: int = 4
    lead: int = 8
    block: int = 8192
    query_block: int = 2048
    scale: int = 1024


def quantise(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, embedding`` -> ``vec_id, v``: floor(scale * component) as longs."""
    ok = ("embedding IS NOT NULL AND vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> "
          "x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('Infinity'))")
    rows = vectors.where(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(embedding, x -> cast(floor({scale}D * cast(x AS DOUBLE)) AS BIGINT)) AS v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _sides(queries, vectors) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as matrices of one width in a type that holds every partial sum exactly."""
    width = max((len(v) for side in (queries, vectors) for v in side), default=0)
    a, b = _matrix(queries, width), _matrix(vectors, width)
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(width, 1)
    kind = np.float64 if bound < 2**53 else np.int64
    return a.astype(kind), b.astype(kind)


def _cuts(width: int, lists: int) -> list[tuple[int, int]]:
    """The two halves of every slice, slice by slice."""
    at = np.linspace(0, width, 2 * lists + 1).astype(int)
    return list(zip(at, at[1:]))


def _norms(m: np.ndarray, cuts) -> np.ndarray:
    """Euclidean norms of the slices of every row."""
    return np.stack([np.sqrt((m[:, s:e].astype(float) ** 2).sum(1)) for s, e in cuts], 1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


#: Queries multiplied at once: bounds the products that a task holds.
QUERIES = 256


def leaders(a: np.ndarray, b: np.ndarray, own: np.ndarray, v_ids: np.ndarray, turn: int, how: Threshold):
    """Phase 1 of a block: per query the k best of the entries that lead list ``turn``,
    as (position, whole score). ``own``: the queries' ids."""
    x, cuts = turn % how.lists, _cuts(a.shape[1], how.lists)
    s, e = cuts[2 * x][0], cuts[2 * x + 1][1]
    for p in range(0, len(a), QUERIES):
        local = a[p:p + QUERIES, s:e] @ b[:, s:e].T
        for i in range(p, min(p + QUERIES, len(a))):
            at = _best(local[i - p], v_ids, how.lead * how.k + 1)
            at = at[v_ids[at] != own[i]]
            whole = b[at] @ a[i]
            best = _best(whole, v_ids[at], how.k)
            yield at[best], whole[best]


def collect(a: np.ndarray, b: np.ndarray, own: np.ndarray, v_ids: np.ndarray, cutoffs: np.ndarray, how: Threshold):
    """Phases 2 and 3 of a block: per query its k best entries of at least its cutoff (NaN:
    of all), as (position, whole score, partial products taken)."""
    lists, last = how.lists, how.lists - 1  # only the last list is spared: before it, norms tell little
    halves = _cuts(a.shape[1], lists)
    ends = [(halves[2 * x][0], halves[2 * x + 1][1]) for x in range(lists)]
    parts = [np.ascontiguousarray(b[:, s:e]) for s, e in halves[2 * last:]]
    qn, vn = _norms(a, halves[2 * last:]), _norms(b, halves[2 * last:])
    # of the whole last list, then of its second half; the factor is for their rounding
    q_rest, v_rest = (np.stack([np.hypot(n[:, 0], n[:, 1]), n[:, 1]]) * (1 + 1e-9) for n in (qn, vn))
    for p in range(0, len(a), QUERIES):
        head = [a[p:p + QUERIES, s:e] @ b[:, s:e].T for s, e in ends[:last]]
        for i in range(p, min(p + QUERIES, len(a))):
            cutoff = cutoffs[i] - abs(cutoffs[i]) * 2.0 ** -50  # longs beyond 2**53 are rounded
            need = cutoff / lists - abs(cutoff) * 2.0 ** -50
            read = [h[i - p] for h in head]
            at, total = np.arange(len(b)), sum(read, np.zeros(len(b), a.dtype))
            taken = len(b) * ends[last][0]
            for half in (0, 1):
                if not np.isnan(cutoff):
                    may = q_rest[half, i] * v_rest[half, at] + 1
                    go = total + may >= cutoff
                    if half == 0:  # such an entry, in a list read or still to be read
                        go &= np.any([r >= need for r in read] + [may >= need], axis=0)
                    at = at[go]
                    total = total[go]
                s, e = halves[2 * last + half]
                total = total + parts[half][at] @ a[i, s:e]
                taken += len(at) * (e - s)
            ok = v_ids[at] != own[i]
            if not np.isnan(cutoff):
                ok &= total >= cutoff
            at, total = at[ok], total[ok]
            best = _best(total, v_ids[at], how.k)
            yield at[best], total[best], taken


def _phase(how: Threshold, final: bool):
    """Per (vector block, query block): leaders of a local list, or the entries that the
    cutoff calls for."""
    import pandas as pd

    def run(key, q, v):
        out = []
        if len(q) and len(v):
            own, v_ids = q["query_id"].to_numpy(), v["vec_id"].to_numpy()
            a, b = _sides(q["v"].to_list(), v["v"].to_list())
            found = collect(a, b, own, v_ids, q["cutoff"].to_numpy(), how) if final else leaders(a, b, own, v_ids, int(key[0]), how)
            for query, (at, score, *_) in zip(own, found):
                out.append(pd.DataFrame({"query_id": np.full(len(at), query), "vec_id": v_ids[at], "score": score.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return run


def search(vectors: DataFrame, queries: str = "vec_id % 100 = 0", how: Threshold = Threshold()) -> DataFrame:
    """The k best vectors for each query row (``queries``: SQL condition on ``vec_id``):
    ``query_id, rank, vec_id, score``. Candidates are all rows but the query's own."""
    rows = stage_table(quantise(vectors, how.scale), "vectors")
    asked = rows.where(queries).withColumnsRenamed({"vec_id": "query_id"})
    n, n_asked = rows.count(), asked.count()
    n_blocks, n_parts = max(1, -(-n // how.block)), max(1, -(-n_asked // how.query_block))

    def meet(asked: DataFrame, final: bool) -> DataFrame:
        q = asked.withColumn("part", F.expr(f"pmod(xxhash64(query_id), {n_parts})"))
        q = q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        v = rows.withColumn("block", F.expr(f"pmod(xxhash64(vec_id), {n_blocks})"))
        v = v.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))
        return q.groupBy("block", "part").cogroup(v.groupBy("block", "part")).applyInPandas(
            _phase(how, final), "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    leading = meet(asked, False).withColumn("rank", F.row_number().over(order))
    cutoffs = leading.where(f"rank = {how.k}").select(F.col("query_id").alias("_q"), F.col("score").alias("cutoff"))
    # fewer than k leaders: no cutoff, everything is collected
    asked = stage_table(asked.join(cutoffs, F.expr("query_id = _q"), "left").drop("_q"), "cutoffs")
    ranked = meet(asked, True).withColumn("rank", F.row_number().over(order))
    return ranked.where(f"rank <= {how.k}").select("query_id", "rank", "vec_id", "score")
