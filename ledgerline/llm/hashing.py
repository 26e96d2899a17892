"""Vectorised hashing of byte buffers with numpy.

A buffer's prefix hash is ``H[i] = sum(T[b_j] * B**j for j < i)`` modulo 2**64 with a
random table ``T`` and an odd ``B``; the hash of any span is then
``(H[end] - H[start]) * B**-start``, finished by a 64-bit mixer. One pass gives the
hash of every word or window of a buffer without a Python loop over them.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class SpanHash:
    """Prefix hashes of byte buffers; the powers grow with the longest buffer seen."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 2**64, size=256, dtype=np.uint64)
        self.base = U(int(rng.integers(0, 2**62, dtype=np.uint64)) * 4 + 3)
        self.inverse = U(pow(int(self.base), -1, 2**64))
        self.pow = self.inv = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.pow) <= n:
            for name, b in (("pow", self.base), ("inv", self.inverse)):
                have = getattr(self, name)
                setattr(self, name, np.concatenate([have, have * U(pow(int(b), len(have), 2**64))]))

    def prefix(self, buf: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        self.grow(len(buf) + 1)
        h = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((self.table if table is None else table)[buf] * self.pow[: len(buf)], out=h[1:])
        return h

    def spans(self, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((h[end] - h[start]) * self.inv[start])


#: Separator bytes (space, tab to carriage return) and A-Z to a-z on bytes.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte buffer."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_WORDS = SpanHash(20260)
_LOWER_TABLE = _WORDS.table[LOWER]
CHUNK = 1 << 20


def word_hashes(buf: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 buffer, A-Z read as a-z, in order.

    Works through the buffer in pieces of about 1 MiB cut between words, so memory does
    not grow with the text (a single word longer than that is one piece)."""
    out, pos, n = [], 0, len(buf)
    while pos < n:
        end = min(n, pos + CHUNK)
        if end < n:
            gaps = np.flatnonzero(IS_SPACE[buf[pos:end]])
            if len(gaps):
                end = pos + int(gaps[-1]) + 1
            else:
                while end < n and not IS_SPACE[buf[end]]:
                    end += 1
        part = buf[pos:end]
        s, e = word_bounds(part)
        if len(s):
            out.append(_WORDS.spans(_WORDS.prefix(part, _LOWER_TABLE), s, e))
        pos = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def text_buffers(column):
    """(offsets, bytes) of an Arrow string column: int64 offsets into one uint8 array.
    Null texts have length 0."""
    import pyarrow as pa

    column = column.fill_null("") if column.null_count else column
    large = column.cast(pa.large_string())
    _, offsets, data = large.buffers()
    at = np.frombuffer(offsets, np.int64, len(large) + 1, large.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at, raw
