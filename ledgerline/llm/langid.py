"""Language ID: multinomial naive Bayes over hashed character n-grams.

Bigrams and trigrams of the lower-cased text are hashed into ``buckets``; every task
sums the counts per language with numpy before anything is shuffled. The smoothed
log-probability matrix (languages x buckets, at most ``max_matrix_mb``) is broadcast and
whole texts are scored batch by batch.

Training reads at most about ``max_train_rows`` labelled rows, chosen by a hash of the id; prediction reads
the text alone.

The score is a probability among the learned languages, and over a whole text it is near
1 for one of them whatever the text is. ``fit`` says whether the text looks like its language at
all: the mean log-probability of its n-grams of letters, as the number of standard deviations
of a single n-gram by which it lies from the mean of the training texts (each of their n-grams
left out of its own estimate). Where fewer than a tenth of the n-grams are letters, all count.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text when nothing was learned; ties go to the language first in code point order;
repeated rows are predicted one by one; an empty table gives an empty result; the fit of a
text without n-grams (a single letter) is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, wider
from .hashing import mix

LETTER = re.compile(r"[^\W\d_]")
PIECE = 1 << 18  # characters handled at once


@dataclass(frozen=True)
class NaiveBayes:
    buckets: int = 1 << 15
    smoothing: float = 0.5
    max_train_rows: int = 200_000
    max_matrix_mb: int = 256
    seed: int = 3


def grams(text: str, how: NaiveBayes) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's n-grams, in pieces of bounded size."""
    for at in range(0, len(text), PIECE):
        # two more characters, so grams across the cut are counted once
        c = np.frombuffer(text[at:at + PIECE + 2].lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        two = (c[:-1] << np.uint64(21)) | c[1:]
        if at + PIECE < len(text):
            yield (mix(two[:PIECE]) % np.uint64(how.buckets)).astype(np.int64)
        else:
            yield (mix(two) % np.uint64(how.buckets)).astype(np.int64)
        if len(c) > 2:
            three = (two[:-1] << np.uint64(21)) | c[2:] | np.uint64(1 << 63)
            yield (mix(three) % np.uint64(how.buckets)).astype(np.int64)


@cache
def _kinds() -> np.ndarray:
    """By code point: 2 letter, 1 white space, 0 other."""
    return np.array([2 * chr(c).isalpha() + chr(c).isspace() for c in range(0x110000)], np.uint8)


def spelled(text: str) -> Iterator[np.ndarray]:
    """For each piece of ``grams``: whether an n-gram is of letters (and blanks) alone."""
    for at in range(0, len(text), PIECE):
        kind = _kinds()[np.frombuffer(text[at:at + PIECE + 2].lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        least, most = np.minimum(kind[:-1], kind[1:]), np.maximum(kind[:-1], kind[1:])
        two = (least > 0) & (most > 1)
        yield two[:PIECE] if at + PIECE < len(text) else two
        if len(kind) > 2:
            yield (np.minimum(least[:-1], kind[2:]) > 0) & (np.maximum(most[:-1], kind[2:]) > 1)


def _count(batches, how: NaiveBayes):
    import pyarrow as pa

    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
            if text and LETTER.search(text):
                if lang not in totals:
                    totals[lang], docs[lang] = np.zeros(how.buckets, np.int64), 0
                docs[lang] += 1
                for g in grams(text, how):
                    totals[lang] += np.bincount(g, minlength=how.buckets)
    for lang, n in totals.items():
        # bucket -1: number of documents
        at = np.flatnonzero(n)
        bucket = np.concatenate([[-1], at]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), pa.array(np.concatenate([[docs[lang]], n[at]]))],
            names=["lang", "bucket", "n"])


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # languages
    logp: np.ndarray   # buckets x languages
    mean: np.ndarray   # log-probability of an n-gram of the training texts, by language
    spread: np.ndarray


def train(rows: DataFrame, how: NaiveBayes = NaiveBayes()) -> Model:
    """``doc_id, text, lang`` rows -> model."""
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    n = rows.count()
    if n > how.max_train_rows:
        share = int(how.max_train_rows / n * (1 << 30))
        rows = rows.where(F.expr(f"pmod(xxhash64(doc_id, {how.seed}), {1 << 30}) < {share}"))
    # the number of languages bounds what the driver gets, so it is known before anything is collected
    most = (how.max_matrix_mb << 20) // (how.buckets * 4)
    if rows.select("lang").distinct().limit(most + 1).count() > most:
        raise ValueError(f"more than {most} languages: the matrix would exceed {how.max_matrix_mb} MB")
    counted = map_arrow(rows.select("text", "lang"), lambda it: _count(it, how), "lang string, bucket int, n long")
    counted = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    langs = sorted(set(got["lang"].to_pylist()), key=lambda s: s.encode())
    counts, docs = np.zeros((how.buckets, len(langs))), np.zeros(len(langs))
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        of = np.array([place[x] for x in got["lang"].to_pylist()])
        bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
        real = bucket >= 0
        counts[bucket[real], of[real]] = n[real]
        docs[of[~real]] = n[~real]
    logp = np.log(counts + how.smoothing) - np.log(counts.sum(0) + how.smoothing * how.buckets)
    # each n-gram of the training texts under the counts without itself
    total = np.maximum(counts.sum(0), 1)
    own = np.log(np.maximum(counts - 1, 0) + how.smoothing) - np.log(total - 1 + how.smoothing * how.buckets)
    mean = (counts * own).sum(0) / total
    spread = np.sqrt((counts * (own - mean) ** 2).sum(0) / total)
    return Model(langs, np.log(docs / max(docs.sum(), 1)) if langs else docs, logp.astype(np.float32), mean, np.maximum(spread, 1.0))


def predict_text(text: str | None, model: Model, how: NaiveBayes) -> tuple[str, float]:
    if not text or not model.langs or not LETTER.search(text):
        return "und", 0.0
    total = model.prior.copy()
    for g in grams(text, how):
        total += model.logp[g].sum(0, dtype=np.float64)
    best = int(total.argmax())
    return model.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit_text(text: str | None, lang: str, model: Model, how: NaiveBayes) -> float | None:
    """How well a text fits the language predicted for it, in standard deviations of an n-gram."""
    if lang not in model.langs:
        return None
    k = model.langs.index(lang)
    logp = model.logp[:, k]
    n, sums = np.zeros(2), np.zeros(2)  # all n-grams, those of letters
    for g, letters in zip(grams(text, how), spelled(text)):
        each = logp[g]
        n += len(each), letters.sum()
        sums += each.sum(dtype=np.float64), each[letters].sum(dtype=np.float64)
    used = int(10 * n[1] >= n[0])
    return float((sums[used] / n[used] - model.mean[k]) / model.spread[k]) if n[0] else 0.0


def predict(docs: DataFrame, model: Model, how: NaiveBayes = NaiveBayes(), keep: tuple[str, ...] = ("doc_id",), fit: bool = False) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` of every row, and its ``fit`` if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch["_text"].to_pylist()
            got = [predict_text(t, shared.value, how) for t in texts]
            columns = [batch[c] for c in keep] + [pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())]
            if fit:
                columns.append(pa.array([fit_text(t, x, shared.value, how) for t, (x, _) in zip(texts, got)], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score", "fit"][:len(columns)])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    return map_arrow(rows, run, wider(rows.drop("_text"), "lang_pred string, score double" + ", fit double" * fit))


def held_out() -> Column:
    """Rows kept from training: crc32 of the id's text is divisible by 5 (null id: yes)."""
    return F.expr("coalesce(crc32(cast(doc_id AS STRING)), 0) % 5 = 0")


def identify(docs: DataFrame, how: NaiveBayes = NaiveBayes(), keep: tuple[str, ...] = ("doc_id",), fit: bool = False) -> DataFrame:
    """Train on the rows that are not held out, then predict every row."""
    return predict(docs, train(docs.where(~held_out()), how), how, keep, fit)
