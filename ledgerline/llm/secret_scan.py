"""Secret scan: fixed patterns plus a randomness test battery.

Base spans follow fixed patterns (``assign``, ``access``, ``hex``). Besides them, every
run of 20 or more characters of ``[A-Za-z0-9+/_-]`` outside a base span is a candidate
(kind ``random``). Its encoding (hex, base32, letters, base36, base62, base64) is
inferred from its characters, and three tests ask whether it can be a uniform draw from that alphabet:
chi-squared uniformity, runs above and below the median, lag-1 serial correlation. A
candidate that passes gets the probability that ordinary writing of its length looks
like it: writing that stays within the hex alphabet throughout, or, for the larger alphabets,
writing that repeats characters as rarely (index of coincidence, whose spread shrinks
with length) and that turns as often from one kind of character to another (lower case,
capital, digit, mark; a capital before a lower-case letter is no turn, so that names in
mixed case turn once a word). Fisher's method combines the two.
Over the whole corpus these probabilities go through
Benjamini-Hochberg false-discovery control, one family per length class.

Only a histogram (length classes x probability bins, a fixed number of cells) leaves
the first scan; the second scan applies the thresholds. Texts are never shuffled.

Defined cases: a null text is empty and has no span; offsets count code points, ends are
exclusive; equal rows get equal spans; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, wider
from .hashing import LOWER, text_buffers

# The base patterns.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
IN_RUN = np.zeros(256, bool)
IN_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("letters", "abcdefghijklmnopqrstuvwxyz"), ("LETTERS", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"), ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
ALPHABETS = [(name, frozenset(a), {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS]


@dataclass(frozen=True)
class Battery:
    """``alpha``: level at which a uniformity test rejects; ``fdr``: share of false
    discoveries allowed per length class; ``coincidence`` and ``cubes``: sums of squared
    and cubed character frequencies of ordinary writing; ``in_hex``: its share of characters
    within a hex alphabet; ``turns``: the share of places where names, paths and numbers
    turn to another kind of character; ``classes``: lower ends of the length classes; ``bins`` per factor of ten of the probability, down to 1e-``digits``."""

    alpha: float = 0.001
    fdr: float = 0.01
    coincidence: float = 0.065
    cubes: float = 0.0056
    in_hex: float = 0.3
    turns: float = 0.2
    classes: tuple[int, ...] = (20, 28, 40, 64, 128)
    bins: int = 20
    digits: int = 16


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(codes: np.ndarray, k: int) -> float:
    """Smallest p-value of the three tests, times three."""
    n = len(codes)
    counts = np.bincount(codes, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    # Wilson-Hilferty: the cube root of a chi-squared value is nearly normal
    spread = 2 / (9 * (k - 1))
    p_chi = _tail(((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    side = codes >= k / 2
    up = int(side.sum())
    down = n - up
    if up and down:
        runs = 1 + int((side[1:] != side[:-1]).sum())
        mean = 2 * up * down / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    x = codes - codes.mean()
    power = float((x * x).sum())
    p_serial = 2 * _tail(abs(float((x[1:] * x[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return min(1.0, 3 * min(p_chi, p_runs, p_serial))


def chance_as_text(codes: np.ndarray, k: int, how: Battery) -> float:
    """Probability that ordinary writing of this length repeats characters this rarely."""
    n = len(codes)
    counts = np.bincount(codes, minlength=k).astype(float)
    pairs = n * (n - 1)
    seen = float((counts * (counts - 1)).sum()) / pairs
    kappa = how.coincidence
    var = 2 * kappa * (1 - kappa) / pairs + 4 * (n - 2) / pairs * (how.cubes - kappa * kappa)
    return _tail((kappa - seen) / math.sqrt(var))


def at_least(x: int, n: int, share: float) -> float:
    """Probability of x or more hits in n draws (binomial)."""
    return min(1.0, sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share)
                                 + (n - i) * math.log1p(-share)) for i in range(x, n + 1)))


def turns(run: str) -> int:
    """Places where the kind of character changes, but from a capital to a lower-case letter."""
    kinds = ["a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-" for c in run]
    return sum(x != y and (x, y) != ("A", "a") for x, y in zip(kinds, kinds[1:]))


def combined(p: float, q: float) -> float:
    """Fisher's method for two probabilities."""
    both = max(p * q, 1e-300)
    return both * (1 - math.log(both))


def probability(run: str, how: Battery) -> float | None:
    """The candidate's probability as text; None when it isn't a uniform draw either."""
    have = set(run)
    for name, chars, place in ALPHABETS:
        if have <= chars:
            codes = np.array([place[c] for c in run])
            break
    k = len(place)
    if uniformity(codes, k) < how.alpha:
        return None
    if name in ("hex", "HEX"):
        return how.in_hex ** len(run)
    p = chance_as_text(codes, k, how)
    if name in ("letters", "LETTERS"):
        return p
    return combined(p, at_least(turns(run), len(run) - 1, how.turns))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; of a failing match nothing remains."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: Sequence[tuple[int, int, int]], how: Battery) -> list[tuple[int, int, float]]:
    """(start, end, probability) of runs that overlap no base span and pass the battery.
    ``base`` is in order of start."""
    out, at, reach = [], 0, 0  # reach: where the base spans that start before a run's end come to
    for m in RUN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            p = probability(m[0], how)
            if p is not None:
                out.append((m.start(), m.end(), p))
    return out


def cell(length: int, p: float, how: Battery) -> tuple[int, int]:
    """Length class and probability bin (bin b: p <= 10 ** -(b / bins))."""
    level = how.bins * how.digits if p <= 10.0 ** -how.digits else int(-math.log10(p) * how.bins)
    return sum(length >= x for x in how.classes) - 1, level


def needs_look(column) -> np.ndarray:
    """Rows of an Arrow text column that hold a long run or a keyword of ``assign``."""
    at, raw = text_buffers(column)
    lo, hi = int(at[0]), int(at[-1])
    raw, at = raw[lo:hi], at - lo
    look = np.zeros(len(at) - 1, bool)
    step = 1 << 22  # bytes at once
    edge = np.zeros(0, np.int64)
    for p in range(0, len(raw), step):
        # runs of 20: a byte whose 19 followers are in the class too
        part = IN_RUN[raw[p:p + step + 19]]
        total = np.concatenate([[0], np.cumsum(part, dtype=np.int32)])
        edge = np.flatnonzero(total[20:] - total[:-20] == 20) + p if len(part) >= 20 else edge[:0]
        rows = np.searchsorted(at, edge, side="right") - 1
        look[rows] = True  # a run over a boundary of texts only marks a row too many
    low = LOWER[raw]
    for i in np.flatnonzero(~look):
        t = low[at[i]:at[i + 1]].tobytes()
        look[i] = any(k in t for k in KEYWORDS)
    return look


def _cells(batches, how: Battery):
    import pyarrow as pa

    seen: dict[tuple[int, int], int] = {}
    for batch in batches:
        col = batch["text"]
        for i in np.flatnonzero(needs_look(col)):
            text = col[int(i)].as_py() or ""
            for s, e, p in candidates(text, base_spans(text), how):
                c = cell(e - s, p, how)
                seen[c] = seen.get(c, 0) + 1
    keys = sorted(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
        names=["class", "bin", "n"])


def thresholds(docs: DataFrame, how: Battery = Battery()) -> dict[int, int]:
    """Per length class, the least probability bin that false-discovery control accepts."""
    cells = map_arrow(docs.select("text"), lambda it: _cells(it, how), "class int, bin int, n long")
    rows = cells.groupBy("class", "bin").agg(F.sum("n").alias("n")).collect()  # a fixed number of cells
    out = {}
    for c in {r["class"] for r in rows}:
        own = sorted(((r["bin"], r["n"]) for r in rows if r["class"] == c), reverse=True)
        total, rank = sum(n for _, n in own), 0
        for b, n in own:
            rank += n
            if 10.0 ** -(b / how.bins) <= how.fdr * rank / total:
                out[c] = b
    return out


def find(text: str, least: dict[int, int], how: Battery) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    more = []
    for s, e, p in candidates(text, base, how):
        c, b = cell(e - s, p, how)
        if c in least and b >= least[c]:
            more.append((s, 3, e))
    return sorted(base + more)


def scan(docs: DataFrame, how: Battery = Battery(), least: dict[int, int] | None = None) -> DataFrame:
    """``doc_id, spans``: array of (start, kind, end) in order of start, then kind."""
    least = thresholds(docs, how) if least is None else least

    def run(batches):
        import pyarrow as pa

        span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
        for batch in batches:
            col, out = batch["_text"], [[]] * len(batch)
            for i in np.flatnonzero(needs_look(col)):
                out[i] = [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in find(col[int(i)].as_py() or "", least, how)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.list_(span))], names=["doc_id", "spans"])

    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return map_arrow(rows, run, wider(rows.drop("_text"), "spans array<struct<start:int,kind:string,end:int>>"))


def redact(docs: DataFrame, mark: str = "[SECRET]", how: Battery = Battery()) -> DataFrame:
    """The given rows and columns, every secret in ``text`` replaced by ``mark``
    (overlapping spans by one mark). A null text stays null."""
    least = thresholds(docs, how)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            col = batch["text"]
            changed = {}
            for i in np.flatnonzero(needs_look(col)):
                text = col[int(i)].as_py() or ""
                out, at = [], 0
                for s, _, e in find(text, least, how):
                    if s >= at:
                        out += [text[at:s], mark]
                    at = max(at, e)
                if out:
                    changed[int(i)] = "".join(out) + text[at:]
            if changed:
                texts = col.to_pylist()
                for i, t in changed.items():
                    texts[i] = t
                batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, col.type))
            yield batch

    return map_arrow(docs, run, docs.schema)
