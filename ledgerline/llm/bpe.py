"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into the matches of the tokenizer's pattern; tokens never cross matches,
so their encodings are simply concatenated. A match is encoded by halves: each half on
its own, then the two token lists are joined by encoding a window of tokens around the
boundary anew. The window grows until the tokens next to it stay as they are.

Why that is exact: merging always takes the lowest rank, leftmost first, so if every
two neighbours of a token list come out unchanged when their bytes are encoded
together, no merge ever crosses a boundary of the list, and the list is the encoding of
all its bytes. Inside each half and inside the window the neighbours satisfy this
already; only the two at the window's ends are checked.

Decoding concatenates the tokens' bytes.

Defined cases: a null or empty text has no tokens; bytes that no token covers cannot
occur in a byte-level vocabulary; ids that the vocabulary lacks raise an error;
repeated rows are encoded one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, wider

LEAF = 12            # bytes that are merged directly
CACHED = 400_000     # distinct matches remembered per worker
ROWS = 200           # texts handled at once
NONE = 1 << 40       # rank of a pair that is no token

# Fixed value: the pattern of the public rank files. For texts of the characters below U+0250
# but for superscripts, fractions and the separators 1C-1F, the standard library's classes
# mean the same, and its matcher takes half the time.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
NOT_LATIN = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        self.pattern = regex.compile(pattern)
        self.latin = pattern == PATTERN
        self.steady: dict[tuple[int, int], bool] = {}
        self.matches = _Matches(self)

    def merge(self, b: bytes) -> list[int]:
        """Plain merging: lowest rank first, leftmost of equals."""
        ranks, n = self.ranks, len(b)
        if n > 64:
            return self._merge_long(b)
        get = ranks.get
        parts = [b[i:i + 1] for i in range(n)]
        pair = [get(b[i:i + 2], NONE) for i in range(n - 1)]  # rank of each part joined with the next
        while pair:
            best = min(pair)
            if best == NONE:
                break
            i = pair.index(best)
            parts[i] += parts.pop(i + 1)
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], NONE)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, b: bytes) -> list[int]:
        """The same with a heap and linked neighbours, for long windows."""
        ranks, n = self.ranks, len(b)
        end = list(range(1, n + 1))       # end[i]: end of the part that starts at i, 0 once merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(b[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two parts has changed
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(b[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            p = before[i]
            if p >= 0 and (r := ranks.get(b[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[b[i:end[i]]])
            i = end[i]
        return out

    def stays(self, x: int, y: int) -> bool:
        """Do two tokens come out unchanged when encoded together?"""
        known = self.steady.get((x, y))
        if known is None:
            if len(self.steady) >= CACHED:
                self.steady.clear()
            known = self.steady[x, y] = self.merge(self.tokens[x] + self.tokens[y]) == [x, y]
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Token lists of two neighbouring byte strings -> that of both together."""
        if not a or not b or self.stays(a[-1], b[0]):
            return a + b
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self.merge(b"".join(map(self.tokens.__getitem__, a[i:] + b[:j])))
            if (i == 0 or self.stays(a[i - 1], window[0])) and (j == len(b) or self.stays(window[-1], b[j])):
                return a[:i] + window + b[j:]
            k *= 2

    def tree(self, b: bytes) -> list[int]:
        if len(b) <= LEAF:
            return self.merge(b)
        half = len(b) // 2
        return self.join(self.tree(b[:half]), self.tree(b[half:]))

    def encode_match(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        return [whole] if whole is not None else self.tree(b)

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        pattern = LATIN_PATTERN if self.latin and not NOT_LATIN.search(text) else self.pattern
        return np.frombuffer(b"".join(map(self.matches.__getitem__, pattern.findall(text))), np.int32)

    def forget(self) -> None:
        """Drops what is remembered: a worker goes on to other operators' tasks."""
        self.matches.clear()
        self.steady.clear()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Matches(dict):
    """match -> its ids as int32 bytes; long matches are not kept."""

    def __init__(self, bpe: TreeBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, match: str) -> bytes:
        ids = np.array(self.bpe.encode_match(match.encode("utf-8", "surrogatepass")), np.int32).tobytes()
        if len(match) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[match] = ids
        return ids


_OPEN: dict[tuple[int, str], TreeBPE] = {}


def _worker(shared, pattern: str | None) -> TreeBPE:
    """A Python worker keeps one vocabulary; without a pattern (decoding) any of the same ranks serves."""
    ranks = hash(shared.value)
    for (have, with_pattern), own in _OPEN.items():
        if have == ranks and pattern in (None, with_pattern):
            return own
    _OPEN.clear()
    own = _OPEN[ranks, pattern or r"\X"] = TreeBPE(read_ranks(shared.value), pattern or r"\X")
    return own


def _vocabulary(df: DataFrame, path: str):
    """The vocabulary file, read once by the driver (its size is fixed) and broadcast."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the token ids of every text."""
    shared = _vocabulary(docs, path)

    def run(batches):
        import pyarrow as pa

        bpe = _worker(shared, pattern)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                got = [bpe.encode(t) if t else np.zeros(0, np.int32) for t in part["_text"].to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *got])))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in keep], lists], names=[*keep, ids])
        bpe.forget()

    rows = docs.select(*keep, F.col(text).alias("_text"))
    return map_arrow(rows, run, wider(rows.drop("_text"), f"{ids} array<int>"))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns plus the decoded bytes (null ids: no bytes)."""
    shared = _vocabulary(rows, path)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        bpe = _worker(shared, None)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                flat = part[ids].flatten().to_numpy()
                ends = np.cumsum(pc.fill_null(pc.list_value_length(part[ids]), 0).to_numpy()).tolist()
                got = [bpe.decode(flat[s:e].tolist()) for s, e in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.binary())], names=[*part.schema.names, out])

    return map_arrow(rows, run, wider(rows, f"{out} binary"))

