"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

Documents are dealt to tasks as they lie in their files. A task turns up to ``SHARD``
documents at a time into one list per query term, sorted by impact (the term's share of
a document's score, greatest first). For each item the lists of its terms are read in
step, ``DEPTH`` entries each and then four times as far every time. What has been read of
a document is its lower bound; the lists it was not seen in add at most their next
unread impact, which gives its upper bound. Reading goes on until

* no unseen document can reach the ``k``-th best lower bound (membership; a document
  that could equal it may win by its id, so equal is not enough), and
* every document whose upper bound reaches it has both bounds equal (ties and final
  scores are then exact).

The ``k``-th best score of a task's earlier shards is a bound for its later ones. Tasks
return their ``k`` best documents per item, and two ranked windows (first within a part
of the documents, then over all) leave the ``k`` best of the table.

Items come in blocks of at most ``BLOCK_BYTES`` of terms (or one item that is longer);
the block's items, its vocabulary and the terms' weights are what is broadcast. Each block reads
the documents once; what it keeps of them (lengths and counts of query terms) is staged.

Defined cases: a null or empty text has no terms, and such a document counts neither
in N nor anywhere else; items without terms have no rows; rows of one item id (null
included) are one item with the terms of all; every row of documents is a document, also with a
repeated id; a null doc_id comes after all others of its score; very long texts are
read whole; other columns of either table are not read; empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stage_table

SHARD = 16_384           # documents whose lists are held at once
DEPTH = 64               # entries read of each list in the first step
BLOCK_BYTES = 8 << 20    # of terms per block of items
SALTS = 64               # parts of the documents ranked on their own first
LAST = 2**63 - 1         # stands for a null doc_id

# Term characters are 0-9, A-Z, a-z and everything from U+0080: on UTF-8 bytes, a table
# that blanks the others and lower-cases A-Z.
_TABLE = bytes(
    (c | 0x20 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, text`` -> one row per item: ``item_id, terms`` (distinct, sorted)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            got = [sorted(set(terms(t))) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(got, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("_text"))
    rows = map_arrow(rows, run, "item_id long, terms array<binary>")
    return rows.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(
        F.sort_array(F.collect_set("term")).alias("terms"))


def blocks(items: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items in blocks of at most ``most`` bytes of terms; the driver holds one partition of
    the staged item table and one block."""
    now, held = [], 0
    for row in stage_table(item_terms(items), "items").toLocalIterator():
        mine = [bytes(t) for t in row["terms"]]
        size = sum(map(len, mine)) + 8 * len(mine)
        if now and held + size > most:
            yield now
            now, held = [], 0
        now.append((row["item_id"], mine))
        held += size
    if now:
        yield now


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document: id, number of terms, and the vocabulary's terms in it with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import pyarrow as pa

        number = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            n, ids, counts, ends = [], [], [], [0]
            for text in batch["_text"]:
                found = terms(text.as_py())
                n.append(len(found))
                tf = Counter(map(number.get, found))
                tf.pop(None, None)
                ids.extend(tf.keys())
                counts.extend(tf.values())
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids, counts)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "ids", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_text"))
    return map_arrow(rows, run, "doc_id long, n long, ids array<int>, tf array<int>").where("n > 0")


def weights(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each of the block's terms."""
    total = counted.selectExpr("count(1) AS n", "coalesce(sum(n), 0) AS l").first()
    df = np.zeros(size, np.int64)
    for r in counted.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["id"]] = r["df"]  # at most one row per term of the block
    return total["n"], total["l"], np.floor(1000 * np.log((2.0 * total["n"] + 2) / (2.0 * df + 1))).astype(np.int64)


class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, ids, tf, lengths, n, total: int, words: int, weight: np.ndarray):
        doc = np.repeat(np.arange(len(n)), lengths)
        m = 50 + (50 * n * total) // words
        x = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        order = np.lexsort((-x, ids))
        self.docs, self.doc = len(n), doc[order]
        self.impact = x[order] * weight[ids[order]]
        self.start = np.searchsorted(ids[order], np.arange(len(weight) + 1))

    def best(self, mine: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among an item's ``k`` best, with exact scores; ``least`` is a score
        that ``k`` other documents have."""
        lo, hi = self.start[mine], self.start[mine + 1]
        lo, hi = lo[hi > lo], hi[hi > lo]
        at, depth = lo.copy(), DEPTH
        lower = np.zeros(self.docs, np.int64)
        while len(lo):
            to = np.minimum(at + depth, hi)
            read = np.concatenate([np.arange(a, b) for a, b in zip(at, to)])
            # bincount sums doubles; sums stay far below 2^53
            lower += np.bincount(self.doc[read], self.impact[read], self.docs).astype(np.int64)
            at, depth = to, depth * 4
            open_ = at < hi
            following = np.where(open_, self.impact[np.minimum(at, len(self.impact) - 1)], 0)
            unseen = int(following.sum())
            kth = max(least, int(np.partition(lower, -k)[-k]) if self.docs >= k else 0)
            if not unseen:
                break
            if kth > unseen:
                # lists a document was seen in add nothing more
                seen = np.concatenate([np.arange(a, b) for a, b in zip(lo[open_], at[open_])])
                gone = np.bincount(self.doc[seen], np.repeat(following[open_], (at - lo)[open_]), self.docs).astype(np.int64)
                upper = lower + unseen - gone
                if not ((upper >= kth) & (upper > lower)).any():
                    break
        else:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.flatnonzero((lower >= kth) & (lower > 0))
        return found, lower[found]


def _ranked(items, n_docs: int, n_words: int, weight: np.ndarray, k: int, batches):
    """The ``k`` best documents per item among a task's documents."""
    import pyarrow as pa

    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]  # scores, ids

    def work(parts):
        part = pa.Table.from_batches(parts).combine_chunks()
        ids, tf = part["ids"].chunk(0), part["tf"].chunk(0)
        name = part["doc_id"].fill_null(LAST).to_numpy()
        shard = Shard(ids.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64), ids.value_lengths().to_numpy(),
                      part["n"].to_numpy(), n_docs, n_words, weight)
        for i, (_, mine) in enumerate(items):
            scores, names = kept[i]
            found, score = shard.best(mine, k, int(scores[k - 1]) if len(scores) >= k else 0)
            if len(found):
                scores, names = np.concatenate([scores, score]), np.concatenate([names, name[found]])
                top = np.lexsort((names, -scores))[:k]
                kept[i] = scores[top], names[top]

    parts, held = [], 0
    for batch in batches:
        if len(batch):
            parts.append(batch)
            held += len(batch)
        if held >= SHARD:
            work(parts)
            parts, held = [], 0
    if parts:
        work(parts)
    for (item, _), (scores, names) in zip(items, kept):
        if len(scores):
            ids = pa.array(names, pa.int64(), mask=names == LAST)
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(names), pa.int64()), ids, pa.array(scores)], names=["item_id", "doc_id", "score"])


def search_block(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of one block of items."""
    vocabulary = sorted({t for _, mine in block for t in mine})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = stage_table(count_terms(docs, vocabulary), "terms")
    n_docs, n_words, weight = weights(counted, len(vocabulary))
    # a term of weight 0 adds nothing to any score
    items = [(item, np.array([i for i in map(number.get, mine) if weight[i] > 0], np.int64)) for item, mine in block]
    shared = docs.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches):
        return _ranked(shared.value[0], n_docs, n_words, shared.value[1], k, batches)

    found = map_arrow(counted, run, "item_id long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = found.withColumn("_r", F.row_number().over(Window.partitionBy("item_id", part).orderBy(*order))).where(f"_r <= {int(k)}")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return first.withColumn("rank", rank).where(f"rank <= {int(k)}").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score``."""
    out = None
    for block in blocks(items):
        found = stage_table(search_block(docs, block, k), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
