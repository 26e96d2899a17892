"""Packing token pieces into sequences by the sum-of-squares rule.

Texts are tokenized and cut (``pieces``), then the pieces' lengths are packed
(``pack``). A piece goes to the open sequence where the sum, over all residual gaps, of
the squared number of open sequences with that gap becomes smallest; among equals the
smallest gap wins. Only where no open sequence has room a new one is opened (the rule's plain
form would also open one when that gives the smaller sum, which costs sequences). Long pieces
go first, so that short ones close the gaps.

Pieces are dealt by hash to blocks of about ``BLOCK``, each packed by one task. The
emptiest sequences of a block are dissolved and their pieces, ``BLOCK / FAN`` at most,
are packed again together with those of ``FAN - 1`` other blocks, and so on until one block is left: every round
has a sixteenth of the rows at most. Pieces that fill a sequence need no packing.

Tokens come from the tokenizer library. For texts of the characters below U+0250 (without
those whose classes differ) its normalizer and splitting pattern are a lower-casing and a standard
library pattern, so words are looked up among those seen before and only new ones go
through the tokenizer's model; any other text, and any tokenizer that is built otherwise, is encoded whole.

Defined cases: a null or empty text is the end token alone; rows with one id are packed
one by one; very long texts are cut into full pieces and a rest; clashing columns are
only read if asked for; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage_table, wider

ROOM = 4096
BLOCK = 16_384     # pieces packed by one task
FAN = 16           # blocks whose emptiest sequences meet
CACHED = 300_000   # words of a worker's younger cache; the older one holds as many
ROWS = 200         # texts handled at once

# The parts of the public tokenizer file that the fast path stands for.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same splits for the plain characters.
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
NOT_PLAIN = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ]")


# The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
# the others, in order, from U+0100 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTE_CHARS = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Words(dict):
    """Words, and runs of words without white space -> their token ids as little-endian unsigned
    32-bit bytes; ``encode`` takes whole texts.

    At ``CACHED`` words this becomes the older cache, from which words still in use come back."""

    def __init__(self, raw: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.own = Tokenizer.from_str(raw)
        self.model = self.own.model
        spec = json.loads(raw)
        normalizers = (spec.get("normalizer") or {}).get("normalizers")
        splitters = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.plain = (normalizers == NORMALIZERS and len(splitters) == 2 and splitters[0].get("pattern") == {"Regex": SPLIT}
                      and splitters[1].get("type") == "ByteLevel" and not splitters[1].get("use_regex") and not splitters[1].get("add_prefix_space"))
        # strings that the tokenizer takes as one token of their own, whatever stands around them
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None and len(parts := PLAIN_SPLIT.findall(word)) > 1:
            ids = b"".join(map(self.__getitem__, parts))
        elif ids is None:
            shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTE_CHARS)
            ids = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.plain or NOT_PLAIN.search(text) or any(s in text for s in self.special):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) > CACHED:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.lower().split()))


@lru_cache(maxsize=1)
def _words(raw: str) -> Words:
    """A Python worker keeps the tokenizer and its words from task to task."""
    return Words(raw)


def pieces(docs: DataFrame, path: str, end: int = 1, room: int = ROOM, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``piece, start, length, ids`` (little-endian unsigned 32-bit) of every
    piece. The tokenizer file is read once by the driver (its size is fixed) and broadcast."""
    with open(path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import pyarrow as pa

        words, tail, width = _words(shared.value), np.array([end], "<u4").tobytes(), 4 * room
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                row, piece, start, ids = [], [], [], []
                for i, text in enumerate(part.column(len(keep)).to_pylist()):
                    raw = words.encode(text or "") + tail
                    for k, p in enumerate(range(0, len(raw), width)):
                        row.append(i), piece.append(k), start.append(p // 4), ids.append(raw[p:p + width])
                mine = part.take(pa.array(row, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*mine.columns[:len(keep)], pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[*keep, "piece", "start", "length", "ids"])

    # the text comes last and is taken by its place, so that any name can be kept
    return map_arrow(docs.select(*keep, "text"), run, wider(docs.select(*keep), "piece int, start long, length long, ids binary"))


def place(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, longest first -> the sequence and offset of each, and the sequences' gaps."""
    count = np.zeros(room + 1, np.int64)  # open sequences by gap
    having: list[list[int]] = [[] for _ in range(room + 1)]
    seq, off, gaps = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for i, s in enumerate(sizes.tolist()):
        have = count[s:]
        # change of the sum of squares, less 2: the gap g loses a sequence, the gap g - s
        # gains one (but for a filled sequence, which is no longer open)
        change = 2 * (count[:room + 1 - s] - have)
        change[0] = -2 * have[0] - 1
        g = int(np.where(have > 0, change, 1 << 40).argmin()) + s
        if count[g]:
            to = having[g].pop()
            count[g] -= 1
        else:
            g, to = room, len(gaps)
            gaps.append(room)
        seq[i], off[i] = to, room - g
        gaps[to] = g - s
        if g > s:
            count[g - s] += 1
            having[g - s].append(to)
    return seq, off, np.array(gaps, np.int64)


def _packer(room: int, number: int, last: bool):
    """Packs one block: ``sequence_id, offset`` of each piece; both null for pieces to be packed again."""
    return lambda table: _pack_block(table, room, number, last)


def _pack_block(table, room: int, number: int, last: bool):
    import pyarrow as pa

    size, row = table["length"].to_numpy(), table["_seq"].to_numpy()
    order = np.lexsort((row, -size))
    seq, off, gaps = place(size[order], room)
    block = table["_block"][0].as_py()
    again = np.zeros(len(gaps), bool)
    if not last:
        # the emptiest sequences, as many as have BLOCK / FAN pieces together
        inside = np.bincount(seq, minlength=len(gaps))
        by = np.argsort(-gaps, kind="stable")
        again[by] = (np.cumsum(inside[by]) <= BLOCK // FAN) & (gaps[by] >= room // 64)
    ids = np.zeros(len(size), np.int64)
    offsets, free = np.zeros(len(size), np.int64), np.zeros(len(size), bool)
    ids[order] = (number << 56) | (block << 24) | seq
    offsets[order], free[order] = off, again[seq]
    out = table.drop_columns(["sequence_id", "offset"])
    return out.append_column("sequence_id", pa.array(ids, mask=free)).append_column("offset", pa.array(offsets, mask=free))


def pack(rows: DataFrame, room: int = ROOM) -> DataFrame:
    """Rows with a ``length`` of at most ``room`` -> the same with ``sequence_id, offset``."""
    names = rows.columns
    rows = stage_table(rows.withColumn("_seq", F.monotonically_increasing_id()), "lengths")
    out = rows.where(f"length = {int(room)}").withColumns({"sequence_id": F.expr("-1L - _seq"), "offset": F.lit(0).cast("long")})
    left = rows.where(f"length < {int(room)}")
    n = left.count()
    if n:
        n_blocks, number = -(-n // BLOCK), 0
        left = left.withColumn("_block", F.pmod(F.xxhash64("_seq"), F.lit(n_blocks)).cast("long"))
        left = left.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
        while True:
            last = n_blocks == 1
            packed = stage_table(left.groupBy("_block").applyInArrow(_packer(room, number, last), left.schema), "packed")
            out = out.unionByName(packed.where("sequence_id IS NOT NULL").drop("_block"))
            if last:
                break
            n_blocks, number = -(-n_blocks // FAN), number + 1
            left = packed.where("sequence_id IS NULL").withColumn("_block", F.expr(f"_block div {FAN}"))
    return out.select(*names, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_pieces, ids``: the sequences themselves (of at most ``room`` tokens each), from packed
    rows that kept their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = packed.groupBy("sequence_id").agg(parts.alias("_parts"))
    return out.selectExpr("sequence_id", "size(_parts) AS n_pieces", "aggregate(_parts, cast('' AS BINARY), (a, x) -> concat(a, x.ids)) AS ids")
