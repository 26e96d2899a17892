"""MinHash near-duplicates with an LSH forest.

Every text is its set of word shingles. Texts with one set form a class; one signature
per class goes on. ``TREES`` trees order the classes by ``DEPTH`` min-hash values each;
in a sorted order, candidates of a class are the neighbours before it that share the
longest prefixes (``PREFIX`` values at least). In a sparse region these are all that
share so short a prefix; in a crowded region the nearest neighbours share long ones, so
the depth follows the region.

The orders are worked through in rounds. In each round the candidates are confirmed
on full sets (in the first by joins, later inside the scanning tasks, see ``_links``) and components are formed; the next round passes over neighbours that are
in one component already and looks further back, so a large group of near copies costs
a few candidates per member, never all pairs, and links that the first round missed are
still looked for. Estimates only drop pairs far from the limit.

No region is left half seen: a scan reports the regions (rows of one order that share
``PREFIX`` values) that reach further back than it looked. As long as such a region
holds more than one component, it is scanned again, ``FURTHER`` times as far back.

Orders are range partitioned on the whole key (a crowded region spans several tasks);
rows near a partition's ends meet in a second, small scan.

Defined cases: A-Z are read as a-z; a text with fewer words than a shingle is one
shingle of all its words; a text without words is linked with nothing; rows with one id
(null included, as the smallest id) are one document; a class of exact copies is
never expanded into pairs; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, salted_join, stage_table, tasks_for
from .components import connected_components
from .hashing import mix, text_buffers, word_hashes

U = np.uint64
TREES, DEPTH, PREFIX, SKETCH = 32, 8, 4, 128
LABEL = 2 * DEPTH  # bytes
FURTHER = 8
FLUSH = 1 << 20    # candidate pairs held at once
INLINE = 4096      # shingles of a set that scans carry along
PIECE = 8 << 20    # bytes of rows that a scan looks at together, besides those that it looks back at
_RNG = np.random.Generator(np.random.PCG64(8))
_ODD = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * U(2) + U(1)
_XOR = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_TURN = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
NULL_ID = -(2**63)


@dataclass(frozen=True)
class Forest:
    """``similar``: least Jaccard similarity in percent; ``rounds``: (first tree, last
    tree, neighbours looked at) of each round."""

    words: int = 5
    similar: int = 85
    rounds: tuple[tuple[int, int, int], ...] = ((0, 8, 2), (8, 20, 16), (20, 32, 64))
    slack: float = 0.25  # estimates of SKETCH values drop a pair at the limit with probability below 1e-10


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a word hash sequence."""
    if not len(words):
        return words
    if len(words) < k:
        total = U(len(words))
        for i, w in enumerate(words):
            total = mix(np.atleast_1d(total * _TURN[32] + w * _TURN[i % 32]))[0]
        return np.array([total], np.uint64)
    total = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        total += words[i:len(words) - k + 1 + i] * _TURN[i % 32]
    return np.unique(mix(total))


def signature(s: np.ndarray) -> np.ndarray:
    low = np.full(TREES * DEPTH, 2**64 - 1, np.uint64)
    for p in range(0, len(s), 512):
        np.minimum(low, ((s[None, p:p + 512] ^ _XOR[:, None]) * _ODD[:, None]).min(1), out=low)
    return mix(low)


def _sets(column, how: Forest):
    at, raw = text_buffers(column)
    for i in range(len(at) - 1):
        with np.errstate(over="ignore"):
            yield shingles(word_hashes(raw[at[i]:at[i + 1]]), how.words)


def sketches(docs: DataFrame, how: Forest) -> DataFrame:
    """Per row: id, set size, 128-bit id of the set, labels of all trees, a short sketch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, ids, labels, short = [], [], [], []
            for s in _sets(batch["_text"], how):
                n.append(len(s))
                if len(s):
                    sig = signature(s)
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    labels.append((sig & U(0xFFFF)).astype(np.uint16).tobytes())
                    short.append(((sig[:SKETCH] >> U(16)) & U(0xFF)).astype(np.uint8).tobytes())
                else:
                    ids.append(None), labels.append(None), short.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (ids, labels, short)]],
                names=["id", "n", "set_id", "labels", "sketch"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("text").alias("_text"))
    return map_arrow(rows, run, "id long, n long, set_id binary, labels binary, sketch binary")


#: Kinds of rows that a scan returns.
PAIR, END, REGION, OPEN, LINK = range(5)


class _Sets:
    """The sets of a batch's rows by dense shingle numbers, to compare one row with many at once."""

    def __init__(self, column):
        raw = [x or b"" for x in column.to_pylist()]
        self.at = np.concatenate([[0], np.cumsum([len(x) // 8 for x in raw])]).astype(np.int64)
        _, ids = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
        self.ids = ids.astype(np.int32)
        self.mine = np.zeros(int(self.ids.max(initial=-1)) + 1, bool)

    def shared(self, i: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles that row ``i`` shares with each of ``rows``, and those that either has."""
        own = self.ids[self.at[i]:self.at[i + 1]]
        self.mine[own] = True
        lo, hi = int(rows.min()), int(rows.max()) + 1
        base = self.at[lo]
        total = np.concatenate([[0], np.cumsum(self.mine[self.ids[base:self.at[hi]]])])
        self.mine[own] = False
        both = total[self.at[rows + 1] - base] - total[self.at[rows] - base]
        return both, len(own) + self.at[rows + 1] - self.at[rows] - both


def _root(up: dict, x: int) -> int:
    while x in up:
        x = up[x]
    return x


def _pieces(batches, look: int):
    """The rows in batches of ``PIECE`` bytes, or of ``look`` rows where those take more: rows
    with sets are up to 8 * ``INLINE`` bytes each."""
    for batch in batches:
        step = max(look, len(batch) * PIECE // max(batch.nbytes, 1), 1)
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)


def _scan(batches, look: int, how: Forest, ends: bool, mode: str):
    """Candidates among rows in sorted order: rows of one region, at most ``look`` apart, of
    different components, fitting sizes and (with sketches) near enough by estimate.

    ``pairs`` returns them as they are; ``open`` returns each row that has any, once, with its sketch; ``links``
    compares them by their full sets (``s``) and returns those that are similar, passing
    over pairs that links of this task connect already (pairs without sets come as ``PAIR``). With ``ends`` the
    rows that may have neighbours in the partitions before and after come as ``END``; regions
    that reach back further than ``look`` as ``REGION``."""
    import pyarrow as pa

    names = ["kind", "a", "b", "t", "label", "component", "n", "sketch", "s"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def columns(table):
        n = len(table)
        label = np.frombuffer(b"".join(table["label"].to_pylist()), np.uint16).reshape(n, DEPTH)
        region = np.ascontiguousarray(label[:, :PREFIX]).view(np.uint64)[:, 0]
        have = table["sketch"].null_count == 0 and n > 0
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(n, SKETCH) if have else None
        return [table[c].to_numpy(zero_copy_only=False) for c in ("t", "node", "component", "n")], region, sketch

    def out(kind, k, **given):
        return pa.RecordBatch.from_arrays([pa.array([kind] * k, pa.int32()), *[given.get(c, pa.nulls(k, t)) for c, t in zip(names[1:], types[1:])]], names=names)

    def row_rows(kind, rows, whole):
        more = {"sketch": rows["sketch"]} | ({"s": rows["s"]} if whole else {})
        return out(kind, len(rows), a=rows["node"], t=rows["t"], label=rows["label"], component=rows["component"], n=rows["n"], **more)

    def pair_rows(kind, pairs):
        got = np.unique(np.array(pairs, np.int64).reshape(-1, 2), axis=0)
        return out(kind, len(got), a=pa.array(got[:, 0]), b=pa.array(got[:, 1]))

    carry, seen, marked, up = None, 0, None, {}
    was_open: set[tuple[int, int]] = set()  # (order, node) of the carried rows that were returned
    for batch in _pieces(batches, look):
        if ends and seen < look:
            yield row_rows(END, batch.slice(0, look - seen), True)
        seen += len(batch)
        old = 0 if carry is None else len(carry)
        if old:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        (t, node, component, n), region, sketch = columns(batch)
        pairs, links, met, lag = [], [], [], 0
        is_open = np.zeros(len(batch), bool)
        here = np.arange(old, len(batch))  # rows whose region reaches back that far
        while lag < look and len(here):
            lag += 1
            here = here[here >= lag]
            here = here[(t[here] == t[here - lag]) & (region[here] == region[here - lag])]
            i, j = here, here - lag
            ok = (component[i] != component[j]) & (node[i] != node[j])
            ok &= 100 * np.minimum(n[i], n[j]) >= how.similar * np.maximum(n[i], n[j])
            if mode == "open":
                ok &= ~(is_open[i] & is_open[j])
            i, j = i[ok], j[ok]
            if sketch is not None and len(i):
                near = (sketch[i] == sketch[j]).mean(1) >= how.similar / 100 - how.slack
                i, j = i[near], j[near]
            if mode == "open":
                is_open[i] = is_open[j] = True
            elif mode == "pairs":
                pairs.extend(zip(np.minimum(node[i], node[j]).tolist(), np.maximum(node[i], node[j]).tolist()))
            elif len(i):
                met.append(np.stack([i, j]).astype(np.int32))
            if len(pairs) >= FLUSH:
                yield pair_rows(PAIR, pairs)
                pairs = []
        if met:
            i, j = np.concatenate(met, 1)
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            sets, none = _Sets(batch["s"]), batch["s"].is_null().to_numpy(zero_copy_only=False)
            for at in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
                x, others = int(i[at[0]]), j[at]
                both, either = sets.shared(x, others)
                unknown = none[others] | none[x]
                some = unknown | (100 * both >= how.similar * either)
                for y, sure in zip(others[some].tolist(), (~unknown[some]).tolist()):
                    p, q = _root(up, int(component[x])), _root(up, int(component[y]))
                    if p != q:
                        pair = (min(int(node[x]), int(node[y])), max(int(node[x]), int(node[y])))
                        if sure:
                            links.append(pair)
                            up[max(p, q)] = min(p, q)
                        else:
                            pairs.append(pair)
        for kind, got in ((PAIR, pairs), (LINK, links)):
            if got:
                yield pair_rows(kind, got)
        if mode == "open":
            new = [k for k in np.flatnonzero(is_open).tolist() if k >= old or (int(t[k]), int(node[k])) not in was_open]
            if new:
                yield row_rows(OPEN, batch.take(pa.array(new)), False)
            last = range(max(0, len(batch) - look), len(batch))
            was_open = {x for k in last if (x := (int(t[k]), int(node[k]))) in was_open or is_open[k]}
        if len(here):  # at the end of the look, one row for each region that goes on
            first = [int(i) for k, i in enumerate(here) if not k or (t[i], region[i]) != (t[here[k - 1]], region[here[k - 1]])]
            if (t[first[0]], region[first[0]]) == marked:
                del first[0]
            marked = (t[here[-1]], region[here[-1]])
            if first:
                rows = batch.take(pa.array(first))
                yield out(REGION, len(rows), t=rows["t"], label=rows["label"])
        carry = batch.slice(max(0, len(batch) - look))
    if ends and carry is not None:
        done = min(look, seen) - (seen - len(carry))  # rows of the end that were sent as rows of the start
        yield row_rows(END, carry.slice(max(0, done)), True)


_SCANNED = "kind int, a long, b long, t int, label binary, component long, n long, sketch binary, s binary"
_REGION = f"substring(label, 1, {2 * PREFIX})"
#: A region as one column: order number, then prefix.
REGION_SQL = f"concat(cast(cast(t AS STRING) AS BINARY), {_REGION})"


def _neighbours(rows: DataFrame, look: int, how: Forest, mode: str = "pairs", tasks: int | None = None) -> DataFrame:
    """What ``_scan`` finds among ``t, label, node, component, n, sketch, s`` rows, neighbours in other
    partitions included. With ``tasks`` a task scans several partitions, one after the other, into one file."""
    ordered = rows.repartitionByRange("t", "label", "node").sortWithinPartitions("t", "label", "node")
    got = stage_table(map_arrow(ordered, lambda it: _scan(it, look, how, True, mode), _SCANNED), "candidates", tasks)
    ends = got.where(f"kind = {END}").withColumnRenamed("a", "node").drop("b", "kind")
    ends = ends.repartition("t", F.expr(_REGION)).sortWithinPartitions("t", "label", "node")
    more = stage_table(map_arrow(ends, lambda it: _scan(it, look, how, False, mode), _SCANNED).drop("s"), "candidates", tasks)
    return got.where(f"kind <> {END}").drop("s").unionByName(more)


def _pairs(found: DataFrame, kind: int = PAIR) -> DataFrame:
    return found.where(f"kind = {kind}").select("a", "b").distinct()


def _regions(found: DataFrame) -> DataFrame:
    return found.where(f"kind = {REGION}").select(F.expr(REGION_SQL).alias("region")).distinct()


def _links(rows: DataFrame, look: int, sets: DataFrame, how: Forest, tasks: int) -> tuple[DataFrame | None, DataFrame]:
    """Links among the rows (None if there are none), and the regions that reach back further than ``look``.

    A first scan only returns the rows that have candidates. Those rows alone meet their sets,
    and a second scan compares them where they lie, so a crowd of texts that share much but are not
    similar is refuted inside the tasks: the tables hold rows and links, never all pairs. Sets above
    ``INLINE`` shingles aren't carried along; their pairs are compared by joins."""
    first = _neighbours(rows, look, how, "open", tasks)
    opened = first.where(f"kind = {OPEN}").select("t", "label", F.col("a").alias("node"), "component", "n", "sketch").distinct()
    short = sets.where(f"size(s) <= {INLINE}").select(F.col("node").alias("_s"), "raw")
    opened = opened.join(short, F.expr("node = _s"), "left")
    opened = stage_table(opened.select("t", "label", "node", "component", "n", "sketch", F.col("raw").alias("s")), "open", tasks)
    second = _neighbours(opened, look, how, "links", tasks).where(f"kind IN ({PAIR}, {LINK})")
    kinds = {r["kind"] for r in second.select("kind").distinct().collect()}  # two at most
    if not kinds:
        return None, _regions(first)
    links = _pairs(second, LINK)
    return links.unionByName(_confirm(_pairs(second), sets, how)) if PAIR in kinds else links, _regions(first)


def _trees(classes: DataFrame, first: int, last: int) -> DataFrame:
    rows = classes.withColumn("t", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
    return rows.selectExpr("t", f"substring(labels, t * {LABEL} + 1, {LABEL}) AS label", "node", "component", "n", "sketch",
                           "cast(NULL AS BINARY) AS s")


def _confirm(pairs: DataFrame, sets: DataFrame, how: Forest) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = (sets.select(F.col("node").alias(f"_{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    both = pairs.join(a, F.expr("a = _a")).join(b, F.expr("b = _b")).selectExpr(
        "a", "b", "size(sa) + size(sb) AS total", "size(array_intersect(sa, sb)) AS i")
    return both.where(f"100L * i >= {how.similar}L * (total - i)").select("a", "b")


def _placed(crowd: DataFrame, known: DataFrame | None) -> DataFrame:
    """The classes with their components so far."""
    if known is None:
        return crowd.withColumn("component", F.col("node"))
    now = crowd.join(known.select(F.col("node").alias("_n"), "component"), F.expr("node = _n"), "left").drop("_n")
    return now.withColumn("component", F.coalesce("component", "node"))


def _grown(found: DataFrame, known: DataFrame | None, tasks: int) -> DataFrame:
    """Components after more links."""
    if known is not None:
        found = found.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return connected_components(found, tasks)


def _unseen(now: DataFrame, regions: DataFrame, tasks: int) -> DataFrame:
    """The rows, in all orders, of those ``regions`` that hold more than one component."""
    bare = _trees(now.withColumn("sketch", F.lit(None).cast("binary")), 0, TREES).drop("sketch", "s").withColumn("region", F.expr(REGION_SQL))
    rows = stage_table(salted_join(bare, regions, "region", F.col("node"), 8, "left_semi"), "unseen", tasks)
    several = rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("region")
    rows = salted_join(rows, several, "region", F.col("node"), 8, "left_semi").drop("region")
    sketch = now.select(F.col("node").alias("_n"), "sketch")
    return stage_table(rows.join(sketch, F.expr("node = _n")).selectExpr(
        "t", "label", "node", "component", "n", "sketch", "cast(NULL AS BINARY) AS s"), "unseen", tasks)


def link(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """One row per row of ``doc_id, text``: ``doc_id, n_shingles, component_id, kept``."""
    rows = stage_table(sketches(docs, how), "sketches")
    per_tree = rows.count()  # at most, of each order
    tasks, few = tasks_for(docs.sparkSession, TREES * per_tree), tasks_for(docs.sparkSession, per_tree)
    per_set = stage_table(rows.where("n > 0").groupBy("set_id").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("c")), "classes", few)
    classes = rows.join(per_set.selectExpr("set_id AS _s", "node"), F.expr("set_id = _s AND id = node")).select(
        "node", "labels", "sketch", "n", F.col("node").alias("component")).distinct()
    bare = classes.withColumn("sketch", F.lit(None).cast("binary"))

    # classes that share a region with any other, of whatever size: a fitting one may lie
    # further back; only their sets are made
    shared = _neighbours(_trees(bare, 0, TREES), 1, replace(how, similar=0), "open", tasks)
    near = stage_table(shared.where(f"kind = {OPEN}").select(F.col("a").alias("_near")).distinct(), "near", few)
    crowd = stage_table(classes.join(near, F.expr("node = _near"), "left_semi").drop("component"), "crowd", few)
    tasks = tasks_for(docs.sparkSession, TREES * crowd.count())
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("node"), F.col("text").alias("_text"))
    texts = texts.join(near, F.expr("node = _near"), "left_semi").dropDuplicates(["node", "_text"])

    def make(batches):
        import pyarrow as pa

        for batch in batches:
            for p in range(0, len(batch), 200):
                part = batch.slice(p, 200)
                got = list(_sets(part["_text"], how))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in got])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *got]).view(np.int64)
                raw = pa.array([s.tobytes() for s in got], pa.binary())
                yield pa.RecordBatch.from_arrays([part["node"], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), raw], names=["node", "s", "raw"])

    sets = stage_table(map_arrow(texts, make, "node long, s array<long>, raw binary"), "sets", tasks)
    known, regions, look = None, None, 0
    for first, last, look in how.rounds:
        rows_now = _trees(_placed(crowd, known), first, last)
        if known is None:  # the nearest neighbours: few candidates for each row
            scanned = _neighbours(rows_now, look, how, tasks=tasks)
            links, further = _confirm(_pairs(scanned), sets, how), _regions(scanned)
        else:
            links, further = _links(rows_now, look, sets, how, tasks)
        known = known if links is None else _grown(links, known, tasks)
        regions = further if regions is None else regions.unionByName(further)
    # regions that the rounds have not seen through: further back, until none is left
    while True:
        unseen = _unseen(_placed(crowd, known), stage_table(regions.distinct(), "regions", tasks), tasks)
        if unseen.isEmpty():
            break
        look *= FURTHER
        links, regions = _links(unseen, look, sets, how, tasks)
        known = known if links is None else _grown(links, known, tasks)
    # only classes of several rows or with a link need a join; the rest stand alone
    named = per_set.join(known.select(F.col("node").alias("_n"), "component"), F.expr("node = _n"), "left")
    named = named.where("c > 1 OR component IS NOT NULL").select("set_id", F.coalesce("component", "node").alias("component"))
    out = salted_join(rows.select("id", "n", "set_id"), named, "set_id", F.col("id"), 32)
    out = out.withColumn("component", F.coalesce("component", "id"))
    named_id = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c))
    return out.select(named_id("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      named_id("component").alias("component_id"), F.expr("id = component AS kept"))


def keep_one(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """The given columns of one document of each group: the row of its smallest id; of rows with
    one id the first by its columns, so that reruns agree. Rows are carried as one
    column, so no name can clash."""
    kept = link(docs.select("doc_id", "text"), how).where("kept").select(F.struct("doc_id").alias("_kept")).distinct()
    # structs of null are equal, and one key for the join and the window moves the texts once
    own = docs.select(F.struct("doc_id").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = own.join(kept, F.expr("_id = _kept"), "left_semi")
    first = F.row_number().over(Window.partitionBy("_id").orderBy("row"))
    return own.withColumn("place", first).where("place = 1").select("row.*")
