"""Exact substring dedup by prefix-free parsing.

Every byte that a string of ``length`` bytes covers is removed when that string also
starts anywhere else in the corpus.

A rolling hash triggers the phrases: the trigger of a start is the place of the smallest
k-byte hash within its ``length`` bytes, and neighbouring starts with one trigger form a
phrase. Equal strings have their trigger at the same offset, so only starts with equal
trigger context can match, whatever stands around them. That is the dictionary: phrase
pieces with equal bytes are one entry, however often they occur, and corpus order is
needed only as far as it decides equality of ``length`` bytes:

* a piece of up to 128 starts whose whole reach (its starts and ``length`` bytes from
  the last) occurs twice is repeated with all its starts, without looking inside;
* pieces that share only their core (the bytes that all its starts cover) may agree in
  part: one occurrence of each entry is cut into pieces of 16 starts, then of one, where
  reach and core are the string itself.

The sorted suffixes of dictionary and parse are thus compared by hashes of their first
``length`` bytes, grouped and counted over all tasks; counts are combined before each
shuffle, so a passage in a third of all documents is one row per task. Hashes are
64 bits over random byte tables; entries are joined on pairs of them.

Defined cases: a null text is empty; a text shorter than ``length`` keeps everything;
matches never cross documents; equal rows are copies of each other and both lose what
they share; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage_table
from .hashing import SpanHash, text_buffers

U = np.uint64
CHUNK = 1 << 19  # starts handled at once
NULL_ID = -(2**63)  # stands for a null id inside
PLACE = 20       # low bits of a packed hash: place within a chunk


@dataclass(frozen=True)
class Repeats:
    length: int = 400
    gram: int = 32
    steps: tuple[int, ...] = (128, 16, 1)


_HASH = SpanHash(5)


def triggers(h: np.ndarray, n: int, how: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a buffer with prefix hash ``h``: trigger place, first and last start."""
    grams = n - how.gram + 1
    at = np.arange(grams)
    packed = (_HASH.spans(h, at, at + how.gram) >> U(PLACE) << U(PLACE)) | at.astype(np.uint64)
    width = how.length - how.gram + 1
    # minimum of every `width` neighbours from running minima of blocks of that width
    padded = np.concatenate([packed, np.full(-grams % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - how.length + 1
    place = (np.minimum(back[:starts], ahead[width - 1:width - 1 + starts]) & U((1 << PLACE) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    return place[first], first, last


def pieces(h: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int, how: Repeats):
    """Cut phrases (trigger ``p``, offsets ``lo..hi`` of the trigger from the start) at
    multiples of ``step``. Returns: index of the phrase, offsets, reach and core hash."""
    k = lo // step
    count = hi // step - k + 1
    of = np.repeat(np.arange(len(p)), count)
    k = np.repeat(k - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(of))
    a, b, p = np.maximum(lo[of], k * step), np.minimum(hi[of], k * step + step - 1), p[of]
    reach = _HASH.spans(h, p - b, p - a + how.length)
    core = reach if step == 1 else _HASH.spans(h, p - k * step, p - k * step - step + 1 + how.length)
    return of, a, b, reach, core


_PIECES = "doc_id long, mark int, p long, lo int, hi int, reach long, core long, m long"


def _rows(of, p, a, b, reach, core, doc, mark, m):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(mark), pa.array(p), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
         pa.array(reach.view(np.int64)), pa.array(core.view(np.int64)), pa.array(m)],
        names=["doc_id", "mark", "p", "lo", "hi", "reach", "core", "m"])


def _parse(batches, how: Repeats):
    """All pieces of all texts at the first step."""
    for batch in batches:
        at, raw = text_buffers(batch["_text"])
        ids, marks = batch["doc_id"].to_numpy(zero_copy_only=False), batch["mark"].to_numpy(zero_copy_only=False)
        got = []
        size = 0
        for i in range(len(at) - 1):
            for c in range(int(at[i]), int(at[i + 1]) - how.length + 1, CHUNK):
                buf = raw[c:min(c + CHUNK + how.length - 1, at[i + 1])]
                h = _HASH.prefix(buf)
                p, first, last = triggers(h, len(buf), how)
                of, a, b, reach, core = pieces(h, p, p - last, p - first, how.steps[0], how)
                k = len(of)
                got.append((of, p[of] + (c - at[i]), a, b, reach, core, np.full(k, ids[i]), np.full(k, marks[i], np.int32), np.ones(k, np.int64)))
                size += k
                if size > 1 << 17:
                    yield _rows(*map(np.concatenate, zip(*got)))
                    got, size = [], 0
        if got:
            yield _rows(*map(np.concatenate, zip(*got)))


def _cut(batches, step: int, how: Repeats):
    """Pieces of given strings (``ctx``: the reach of a piece) at the next step."""
    for batch in batches:
        at, raw = text_buffers(_as_text(batch["ctx"]))
        cols = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "mark", "p", "lo", "hi", "m")}
        got = []
        for i in range(len(at) - 1):
            h = _HASH.prefix(raw[at[i]:at[i + 1]])
            lo, hi = np.array([cols["lo"][i]], np.int64), np.array([cols["hi"][i]], np.int64)
            of, a, b, reach, core = pieces(h, hi, lo, hi, step, how)
            k = len(of)
            got.append((of, np.full(k, cols["p"][i]), a, b, reach, core, np.full(k, cols["doc_id"][i]),
                        np.full(k, cols["mark"][i], np.int32), np.full(k, cols["m"][i], np.int64)))
        if got:
            yield _rows(*map(np.concatenate, zip(*got)))


def _as_text(column):
    """A binary column as one of strings of the same bytes (only its buffers are read)."""
    import pyarrow as pa

    return pa.Array.from_buffers(pa.large_string(), len(column), column.cast(pa.large_binary()).buffers(), offset=0)


def _repeated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of staged piece rows: (rows whose reach occurs twice, one occurrence of each entry
    that shares its core with another entry while one of them is still alone)."""
    entries = stage_table(rows.groupBy("core", "reach").agg(
        F.sum("m").alias("m"), *[F.first(c).alias(c) for c in ("doc_id", "mark", "p", "lo", "hi")]), "entries")
    twice = entries.where("m > 1").select(F.col("core").alias("_c"), F.col("reach").alias("_r"))
    whole = rows.join(twice, F.expr("reach = _r AND core = _c"), "left_semi")
    shared = entries.groupBy(F.col("core").alias("_c")).agg(F.count(F.lit(1)).alias("k"), F.min("m").alias("least"))
    open_ = entries.join(shared.where("k > 1 AND least = 1"), F.expr("core = _c"), "left_semi")
    return whole, open_.select("doc_id", "mark", "p", "lo", "hi", "m")


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """``doc_id`` (null as ``NULL_ID``), ``mark, spans``: per text with repeats, the (first
    start, last start) ranges of its repeated strings. ``mark`` (a hash of the text) tells rows of one id apart."""
    keyed = _keyed(docs)
    rows = stage_table(map_arrow(keyed, lambda it: _parse(it, how), _PIECES), "pieces")
    whole, open_ = _repeated(rows)
    found = [whole]
    # the strings of the open entries, read once from their texts
    wanted = open_.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("p", "lo", "hi", "m")).alias("want"))
    wanted = wanted.withColumnsRenamed({"doc_id": "_d", "mark": "_m"})

    def fetch(batches):
        import pyarrow as pa

        for batch in batches:
            at, raw = text_buffers(batch["_text"])
            out = {c: [] for c in ("doc_id", "mark", "p", "lo", "hi", "m", "ctx")}
            for i, want in enumerate(batch["want"].to_pylist()):
                for w in want:
                    s = int(at[i]) + w["p"] - w["hi"]
                    out["ctx"].append(raw[s:s + w["hi"] - w["lo"] + how.length].tobytes())
                    out["doc_id"].append(batch["doc_id"][i].as_py()), out["mark"].append(batch["mark"][i].as_py())
                    for c in ("p", "lo", "hi", "m"):
                        out[c].append(w[c])
            kinds = {"doc_id": pa.int64(), "p": pa.int64(), "m": pa.int64(), "ctx": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int32())) for c, v in out.items()], names=list(out))

    joined = keyed.join(wanted, F.expr("doc_id = _d AND mark = _m")).select("doc_id", "mark", "_text", "want")
    kind = "doc_id long, mark int, p long, lo int, hi int, m long, ctx binary"
    strings = stage_table(map_arrow(joined, fetch, kind).dropDuplicates(["doc_id", "mark", "p", "lo"]), "strings")
    for i, step in enumerate(how.steps[1:]):
        rows = stage_table(map_arrow(strings, lambda it, step=step: _cut(it, step, how), _PIECES), "pieces")
        whole, open_ = _repeated(rows)
        found.append(whole)
        if step > 1:
            inner = open_.select(*[F.col(c).alias(f"_{c}") for c in open_.columns])
            near = strings.join(inner, F.expr("doc_id = _doc_id AND mark = _mark AND p = _p AND lo <= _lo AND _hi <= hi"))
            # the part of the longer string that the piece reaches
            strings = stage_table(near.select(
                "doc_id", "mark", "p", F.expr(f"substring(ctx, hi - _hi + 1, _hi - _lo + {how.length}) AS ctx"),
                F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_m").alias("m")), "strings")
    spans = None
    for rows in found:
        part = rows.select("doc_id", "mark", F.struct(
            (F.col("p") - F.col("hi")).alias("first"), (F.col("p") - F.col("lo")).alias("last")).alias("span"))
        spans = part if spans is None else spans.unionByName(part)
    return spans.groupBy("doc_id", "mark").agg(F.collect_list("span").alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.expr("hash(coalesce(text, '')) AS mark"),
                       F.expr("coalesce(text, '') AS _text"))


def remove_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """``doc_id, n_bytes, kept`` (remaining bytes) and ``removed``: maximal removed runs
    as (start, end) byte offsets, for every row of ``doc_id, text``."""
    spans = repeated_spans(docs, how).withColumnsRenamed({"doc_id": "_d", "mark": "_m"})

    def cut(batches):
        import pyarrow as pa

        run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            at, raw = text_buffers(batch["_text"])
            size, kept, removed = [], [], []
            for i, got in enumerate(batch["spans"].to_pylist()):
                text = raw[at[i]:at[i + 1]].tobytes()
                size.append(len(text))
                runs: list[list[int]] = []
                for s, e in sorted((x["first"], x["last"] + how.length) for x in got or ()):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                edges = [0, *(x for r in runs for x in r), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append([{"start": s, "end": e} for s, e in runs])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(size, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(run))],
                names=["doc_id", "n_bytes", "kept", "removed"])

    rows = _keyed(docs).join(spans, F.expr("doc_id = _d AND mark = _m"), "left").select("doc_id", "_text", "spans")
    out = map_arrow(rows, cut, "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,end:long>>")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(NULL_ID), F.col("doc_id")))
