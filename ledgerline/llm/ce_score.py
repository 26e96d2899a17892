"""LM scoring: cross-entropy difference of two matched n-gram models.

The target model is counted over all documents labelled good, the background model over
all documents. Both are interpolated word bigram models over the same words, matched in
their smoothing: it adds the same share to both, whatever their sizes, so a word that
neither has seen makes no difference. Every document is scored by the mean difference of its tokens' losses, target
minus background: below 0 it is closer to the target than to the corpus. A document's own
tokens are left out of the models that score it, or good ones would look nearer to the
target than others like them.

Every word and every pair of words has a count of its own, so the models grow with the
corpus and no task, driver or broadcast holds one. Documents are staged in blocks of
bounded size. A block asks for its distinct words and pairs, with its own counts of them;
the keys are dealt out by ranges of their hash to as many owners as the corpus needs. An
owner adds up what the blocks have sent and answers each with the sums in the order of
the question, so answers carry no keys. A frequent word is one key of each block. The
block is scored from the answers alone.

Words are known by 63 bits of their hash and pairs by 63 bits of theirs: among n keys
about n * n / 2**64 pairs of keys meet (none to be expected below 4 billion keys).

Defined cases: words are separated by ASCII white space, A-Z read as a-z; a null or blank
text has 0 tokens and null scores; the first word is scored by the unigram part alone;
repeated rows count and are scored one by one (a row leaves out its own counts, not those
of its copies); without target documents the target
model is uniform; the vocabulary of both is the number of distinct words in the corpus.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, salted_join, stage_table, wider
from .hashing import mix, text_buffers, word_bounds, word_hashes

U = np.uint64
SALTS = 8
BLOCK = 8 << 20        # bytes of text in a block, at least one document
BLOCK_ROWS = 100_000   # documents in a block
SHARE = 600_000        # tokens of the corpus to each owner
PART = 1 << 17         # tokens of a block that are scored together, at least one document


@dataclass(frozen=True)
class Bigrams:
    weight: float = 0.6       # of the bigram part
    smoothing: float = 0.1


@dataclass(frozen=True)
class Totals:
    tokens: int       # of all documents
    target: int       # of the good ones
    vocabulary: int   # distinct words


def token_ids(words: np.ndarray, how: Bigrams) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words (negative), and of pairs of each word with the one before it (0 or more)."""
    one = (words | U(1 << 63)).view(np.int64)
    two = (mix(words[:-1] * U(0x9E3779B97F4A7C15) + words[1:]) % U(1 << 63)).astype(np.int64)
    return one, two


def _keys(ids: np.ndarray) -> np.ndarray:
    """Ids turned by one bit: words and pairs are mixed in one order."""
    x = ids.view(U)
    return (x << U(1)) | (x >> U(63))


def _ids(keys: np.ndarray) -> np.ndarray:
    return ((keys >> U(1)) | (keys << U(63))).view(np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, compressed byte by byte of their places."""
    import pyarrow as pa

    x = np.concatenate([c.astype(U) for c in columns])
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, columns: int, n: int) -> np.ndarray:
    import pyarrow as pa

    raw = np.frombuffer(pa.decompress(blob, 8 * columns * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(U).reshape(columns, n)


def _dealt(keys: np.ndarray, owners: int):
    """(owner, first, last) of sorted keys."""
    of = ((keys >> U(32)) * U(owners)) >> U(32)
    at = np.flatnonzero(np.diff(of, prepend=U(owners)))
    return zip(of[at].tolist(), at.tolist(), [*at[1:].tolist(), len(keys)])


def _make_blocks(batches):
    import pyarrow as pa

    held, size, rows = [], 0, 0

    def block():
        length = np.concatenate([h[1] for h in held])
        text = b"".join(h[2].tobytes() for h in held)
        columns = [pa.concat_arrays([h[0] for h in held]), pa.array(length), pa.array(np.concatenate([h[3] for h in held]))]
        ends = pa.array([0, len(length)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), *[pa.ListArray.from_arrays(ends, c) for c in columns],
             pa.array([pa.compress(text, codec="zstd", asbytes=True)], pa.binary())],
            names=["block", "ids", "n_bytes", "n_tokens", "text"])

    for batch in batches:
        at, raw = text_buffers(batch["_text"])
        n = np.array([len(word_bounds(raw[at[i]:at[i + 1]])[0]) for i in range(len(batch))], np.int64)
        p = 0
        for i in range(len(batch)):
            size, rows = size + int(at[i + 1] - at[i]), rows + 1
            full = size >= BLOCK or rows >= BLOCK_ROWS
            if full or i + 1 == len(batch):
                held.append((batch["doc_id"].slice(p, i + 1 - p), np.diff(at[p:i + 2]), raw[at[p]:at[i + 1]], n[p:i + 1]))
                p = i + 1
            if full:
                yield block()
                held, size, rows = [], 0, 0
    if held:
        yield block()


def _block_words(n_bytes: list[int], text: bytes) -> list[np.ndarray]:
    """Word hashes of each document of a block."""
    import pyarrow as pa

    at = np.concatenate([[0], np.cumsum(n_bytes)]).astype(np.int64)
    raw = np.frombuffer(pa.decompress(text, int(at[-1]), codec="zstd", asbytes=True), np.uint8)
    return [word_hashes(raw[at[i]:at[i + 1]]) for i in range(len(n_bytes))]


def _block_keys(words: list[np.ndarray], how: Bigrams) -> np.ndarray:
    """Keys of all words, then of all pairs."""
    none = np.zeros(0, np.int64)
    got = [token_ids(w, how) for w in words if len(w)]
    return _keys(np.concatenate([none, *[one for one, _ in got], *[two for _, two in got]]))


def _own_words(batches, owners: int, how: Bigrams):
    import pyarrow as pa

    for batch in batches:
        for n_bytes, text in zip(batch["n_bytes"], batch["text"]):
            words = [w for w in _block_words(n_bytes.as_py(), text.as_py()) if len(w)]
            keys = np.unique(_keys(np.concatenate([np.zeros(0, np.int64), *[token_ids(w, how)[0] for w in words]])))
            parts = list(_dealt(keys, owners))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o for o, _, _ in parts], pa.int64()), pa.array([b - a for _, a, b in parts], pa.int64()),
                 pa.array([_pack(np.diff(keys[a:b], prepend=U(0))) for _, a, b in parts], pa.binary())],
                names=["owner", "n", "keys"])


def _distinct(table):
    import pyarrow as pa

    keys = [np.cumsum(_unpack(k, 1, n)[0], dtype=U) for n, k in zip(table["n"].to_pylist(), table["keys"].to_pylist())]
    return pa.table({"n": pa.array([len(np.unique(np.concatenate(keys)))], pa.int64())})


def _ask(block, good, owners: int, how: Bigrams):
    """Of one block: its distinct keys with its own counts, in parts by owner."""
    import pyarrow as pa

    names = ["block", "owner", "n", "keys"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
    if not len(block):
        return pa.table([pa.array([], k) for k in kinds], names=names)
    words = _block_words(block["n_bytes"][0].as_py(), block["text"][0].as_py())
    keys, n = np.unique(_block_keys(words, how), return_counts=True)
    chosen = [words[i] for part in good["good"].to_pylist() for i in part]
    target, m = np.unique(_block_keys(chosen, how), return_counts=True)
    n_target = np.zeros(len(keys), np.int64)
    n_target[np.searchsorted(keys, target)] = m
    parts = list(_dealt(keys, owners))
    blobs = [_pack(np.diff(keys[a:b], prepend=U(0)), n[a:b], n_target[a:b]) for _, a, b in parts]
    columns = [[block["block"][0].as_py()] * len(parts), [o for o, _, _ in parts], [b - a for _, a, b in parts], blobs]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _added(table):
    """Of one owner: its keys, both sums, and the place of every key that was asked for."""
    got = [_unpack(k, 3, n) for n, k in zip(table["n"].to_pylist(), table["keys"].to_pylist())]
    keys, at = np.unique(np.concatenate([np.cumsum(g[0], dtype=U) for g in got]), return_inverse=True)
    sums = np.zeros((2, len(keys)), U)
    for k in (0, 1):
        np.add.at(sums[k], at, np.concatenate([g[k + 1] for g in got]))
    return keys, sums, at


def _answer(table):
    import pyarrow as pa

    _, sums, at = _added(table)
    ends = np.cumsum(table["n"].to_numpy())
    blobs = [_pack(sums[0, at[b - n:b]], sums[1, at[b - n:b]]) for n, b in zip(table["n"].to_pylist(), ends.tolist())]
    return pa.table({"block": table["block"], "owner": table["owner"], "n": table["n"], "sums": pa.array(blobs, pa.binary())})


def _listed(table):
    import pyarrow as pa

    keys, sums, _ = _added(table)
    return pa.table({"bucket": _ids(keys), "n": sums[0].astype(np.int64), "n_target": sums[1].astype(np.int64)})


def _losses(single: np.ndarray, pair: np.ndarray, first: np.ndarray, total: np.ndarray, background: np.ndarray, vocabulary: int, how: Bigrams) -> np.ndarray:
    """Loss of every token under one model (natural logarithms): counts of the tokens and,
    where a word is not the ``first`` of its document, of the pair that it ends; ``total``:
    per token the tokens that its model counts, ``background``: that the background counts.
    A model of no tokens is uniform."""
    each = np.where(total > 0, how.smoothing * total / np.maximum(background, 1), 1.0)
    p = (single + each) / (total + each * vocabulary)
    later = np.flatnonzero(~first)
    seen = single[later - 1].astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(seen > 0, pair / seen, p[later])
    p[later] = how.weight * ratio + (1 - how.weight) * p[later]
    return -np.log(p)


def _own(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every place the number of equal places within its document; ``ends`` of documents."""
    out = np.zeros(len(at), np.int64)
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        _, back, n = np.unique(at[a:b], return_inverse=True, return_counts=True)
        out[a:b] = n[back]
    return out


def _score(block, answers, totals: Totals, how: Bigrams):
    """Scores of one block's documents from the sums that its keys have, and the row that
    names its good documents."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n_tokens, target, back = [], [], []
    ids = block["ids"].combine_chunks().flatten()
    if len(block):
        words = _block_words(block["n_bytes"][0].as_py(), block["text"][0].as_py())
        n_tokens = [len(w) for w in words]
        keys, at = np.unique(_block_keys(words, how), return_inverse=True)
        good = [i for part in answers["good"].to_pylist() for i in part or ()]
        answers = answers.filter(pc.is_valid(answers["sums"])).sort_by("owner")
        got = [_unpack(s, 2, n) for n, s in zip(answers["n"].to_pylist(), answers["sums"].to_pylist())]
        sums = np.concatenate([np.zeros((2, 0), U), *got], axis=1)
        if sums.shape[1] != len(keys):
            raise ValueError(f"{sums.shape[1]} answers to {len(keys)} keys")
        del words, keys, answers, got
        at = at.astype(np.int32)
        lengths = np.array(n_tokens, np.int64)
        counted = np.ones((2, len(lengths)), np.int64)  # whether a document is in the model itself
        counted[1] = 0
        counted[1, good] = 1
        ends, pairs = np.cumsum(lengths), int(lengths.sum()) + np.cumsum(np.maximum(lengths - 1, 0))
        # a few documents at a time: what each token takes here is many times what it takes above
        for d in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(ends // PART)) + 1):
            a, b = d[0], d[-1] + 1
            n = lengths[a:b]
            later = np.maximum(n - 1, 0)
            single, pair = at[ends[a] - n[0]:ends[b - 1]], at[pairs[a] - later[0]:pairs[b - 1]]
            stop = np.cumsum(n)
            first = np.zeros(len(single), bool)
            first[(stop - n)[n > 0]] = True
            own_single, own_pair = _own(single, stop), _own(pair, np.cumsum(later))
            others = totals.tokens - np.repeat(n, n)
            for k, total, out in ((0, totals.tokens, back), (1, totals.target, target)):
                mine = np.repeat(counted[k, a:b], n)
                loss = _losses(sums[k, single].astype(np.int64) - own_single * mine, sums[k, pair].astype(np.int64) - own_pair * mine[~first],
                               first, total - np.repeat(counted[k, a:b] * n, n), others, totals.vocabulary, how)
                out += [float(loss[q - m:q].mean()) if m else None for m, q in zip(n.tolist(), stop.tolist())]
    diff = [None if a is None else a - b for a, b in zip(target, back)]
    return pa.table(
        [ids, pa.array(n_tokens, pa.int64()), *[pa.array(x, pa.float64()) for x in (target, back, diff)]],
        names=["doc_id", "n_tokens", "ce_target", "ce_background", "score"])


def _asked(docs: DataFrame, target: DataFrame, how: Bigrams) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """The staged blocks, their good documents, what the blocks ask for, the number of tokens and of owners."""
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block string, ids array<{kind}>, n_bytes array<bigint>, n_tokens array<bigint>, text binary"
    blocks = stage_table(map_arrow(rows, _make_blocks, schema), "blocks")
    tokens = blocks.agg(F.sum(F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)"))).first()[0] or 0
    owners = 1 + tokens // SHARE
    wanted = target.where("doc_id IS NOT NULL").select("doc_id").distinct()
    # ids grow with the corpus, so they are merged, never broadcast: one plan at every size
    each = blocks.select("block", "n_tokens", F.posexplode("ids").alias("at", "doc_id")).selectExpr("block", "at", "doc_id", "n_tokens[at] AS n")
    good = salted_join(each, wanted.hint("merge"), "doc_id", F.struct("block", "at"), SALTS, "inner")
    good = stage_table(good.groupBy("block").agg(F.collect_list("at").alias("good"), F.sum("n").alias("n")), "good")
    asked = blocks.groupBy("block").cogroup(good.groupBy("block")).applyInArrow(
        lambda block, good: _ask(block, good, owners, how), "block string, owner long, n long, keys binary")
    return blocks, good, asked, tokens, owners


def count(docs: DataFrame, target: DataFrame, how: Bigrams = Bigrams()) -> DataFrame:
    """Both models as a table: ``bucket, n, n_target`` of every word and pair (their ids)
    of all documents; ``target``: ids of good documents."""
    return _asked(docs, target, how)[2].groupBy("owner").applyInArrow(_listed, "bucket long, n long, n_target long")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, how: Bigrams = Bigrams()) -> DataFrame:
    """``doc_id, n_tokens, ce_target, ce_background, score`` per row; ``target``: ids of good documents."""
    blocks, good, asked, tokens, owners = _asked(docs, target, how)
    words = map_arrow(blocks.select("n_bytes", "text"), lambda it: _own_words(it, owners, how), "owner long, n long, keys binary")
    words = words.groupBy("owner").applyInArrow(_distinct, "n long").agg(F.sum("n")).first()[0] or 0
    totals = Totals(tokens, good.agg(F.sum("n")).first()[0] or 0, words)
    answers = asked.groupBy("owner").applyInArrow(_answer, "block string, owner long, n long, sums binary")
    # a block's good documents travel with its answers
    answers = answers.withColumn("good", F.lit(None).cast(good.schema["good"].dataType)).unionByName(good.select("block", "good"), allowMissingColumns=True)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda block, answers: _score(block, answers, totals, how),
        wider(docs.select("doc_id"), "n_tokens long, ce_target double, ce_background double, score double"))
