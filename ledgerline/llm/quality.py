"""Quality rules by weak supervision (DataFrame functions only).

Every rule looks at a document's counts and votes good (1), bad (-1) or abstains (0). The
rules see length, repetition, symbols, capitals, and how far a text consists of words, of
little but letters, and of lines that end like sentences. Most of them vote good on most
texts of either kind; which votes tell the kinds apart is not given but estimated:
expectation-maximisation over the table of vote patterns estimates, for each rule, how
often its votes are right on good and on bad documents, and the share of good
documents; a document is kept when its posterior probability of being good reaches
``keep_from`` and it does not fail the base limits.

Patterns are counted before the estimation, so its input has at most ``3 ** rules`` rows
at any corpus size; each step is one aggregation of that table into one row.

Defined cases: a null or empty text has no words and fails the base limits; lines are
compared as they stand; repeated rows are judged one by one; an empty table gives an
empty result. Very long texts are counted whole, within their row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stage_table, words_sql

_SPACE = SPACE.replace("\\", "\\\\")
# a word of letters with a little punctuation around it; a line that ends like a sentence
_PLAIN = r"^\\p{P}?[\\p{L}\\p{M}][\\p{L}\\p{M}\\p{N}\'’-]*\\p{P}{0,2}$"
_ENDED = r"[.!?…。！？][\"\'”’»)\\]]*[" + _SPACE + "]*$"

#: Rules over the counts: (name, SQL for a good vote, SQL for a bad vote).
RULES = (
    ("length", "n_words >= 80", "n_words < 50"),
    ("word_length", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    ("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("dup_lines", "n_dup_lines = 0", "4 * n_dup_lines > n_lines"),
    ("repeats", "10 * n_repeat_words <= 2 * n_words", "10 * n_repeat_words > 4 * n_words"),
    ("capitals", "5 * n_upper <= word_chars", "2 * n_upper > word_chars"),
    ("exclaim", "50 * n_exclaim <= n_words", "3 * n_exclaim > n_words"),
    ("lettered", "10 * n_lettered >= 9 * n_words", "10 * n_lettered < 8 * n_words"),
    ("plain", "10 * n_plain >= 9 * n_words", "10 * n_plain < 7 * n_words"),
    ("marks", "20 * n_marks <= word_chars", "10 * n_marks > word_chars"),
    ("endings", "10 * n_ended >= 9 * n_lines", "2 * n_ended < n_lines"),
)


@dataclass(frozen=True)
class WeakSupervision:
    """``steps`` of EM from ``start`` (accuracy of every rule) and ``prior`` (share of
    good documents). Accuracies stay within ``[1 - high, high]``, so no single vote decides
    alone, and a rule's two accuracies add up to 1 at least: a rule that votes alike on good and
    bad documents then says nothing, and none turns into its opposite."""

    steps: int = 15
    start: float = 0.75
    prior: float = 0.8
    high: float = 0.98
    keep_from: float = 0.5


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> counts per row.

    ``n_repeat_words``: words covered by a 3-word window that occurs twice or more in the
    text. Windows are hashed and sorted with their positions inside the row (hash bits
    above, position bits below); equal hashes only nominate positions, whose windows are
    then compared as text. No row leaves its task."""
    space = f"'[^{_SPACE}]'"
    got = docs.selectExpr(
        "doc_id", f"{words_sql()} AS w",
        f"filter(split(coalesce(text, ''), '\\n'), x -> x rlike {space}) AS lines",
        "length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '')) AS n_symbols",
        r"length(regexp_replace(coalesce(text, ''), '[^\\p{Lu}]+', '')) AS n_upper",
        "length(regexp_replace(coalesce(text, ''), '[^!]+', '')) AS n_exclaim",
        rf"length(regexp_replace(coalesce(text, ''), '[\\p{{L}}\\p{{M}}\\p{{N}}{_SPACE}]+', '')) AS n_marks",
    )
    got = got.selectExpr(
        "doc_id", "w", "size(w) AS n", "length(bin(size(w))) AS bits", "size(lines) AS n_lines",
        "size(lines) - size(array_distinct(lines)) AS n_dup_lines", "n_symbols", "n_upper", "n_exclaim", "n_marks",
        r"size(filter(w, x -> x rlike '\\p{L}')) AS n_lettered", f"size(filter(w, x -> x rlike '{_PLAIN}')) AS n_plain",
        f"size(filter(lines, x -> x rlike '{_ENDED}')) AS n_ended", "length(array_join(w, '')) AS word_chars")
    keep = ["doc_id", "n", "n_lines", "n_dup_lines", "n_symbols", "n_upper", "n_exclaim", "n_marks", "n_lettered", "n_plain",
            "n_ended", "word_chars"]
    got = got.selectExpr(
        *keep, "w", "bits",
        "CASE WHEN n >= 3 THEN sort_array(transform(sequence(0, n - 3), i -> "
        "shiftleft(shiftright(xxhash64(w[i], w[i + 1], w[i + 2]), bits), bits) | cast(i AS BIGINT))) END AS s")
    got = got.selectExpr(
        *keep, "w", "transform(filter(s, (x, i) -> shiftright(x, bits) <=> shiftright(get(s, i - 1), bits) "
        "OR shiftright(x, bits) <=> shiftright(get(s, i + 1), bits)), "
        "x -> cast(x & (shiftleft(1L, bits) - 1) AS INT)) AS p")
    got = got.selectExpr(
        *keep, "CASE WHEN size(p) > 0 THEN sort_array(transform(p, i -> "
        "named_struct('t', concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'p', i))) END AS t")
    got = got.selectExpr(
        *keep, "sort_array(transform(filter(t, (x, i) -> x.t <=> get(t, i - 1).t OR x.t <=> get(t, i + 1).t), x -> x.p)) AS p")
    return got.selectExpr(
        "doc_id", *[f"cast({c} AS BIGINT) AS {c}" for c in keep[2:]], "cast(n AS BIGINT) AS n_words",
        "coalesce(aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1) - x, 3))), 0L, (a, x) -> a + x), 0L) AS n_repeat_words")


def votes(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[
        F.expr(f"CASE WHEN n_words = 0 THEN -1 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").alias(f"v_{name}")
        for name, good, bad in RULES])


def posterior_sql(prior: float, right: dict[str, tuple[float, float]]) -> str:
    """SQL: probability of a good document given its votes. ``right[rule]`` holds the
    rule's accuracy on good and on bad documents; abstentions say nothing."""
    odds = [f"{prior!r}D", f"{1 - prior!r}D"]
    good, bad = [odds[0]], [odds[1]]
    for name, (g, b) in right.items():
        good.append(f"(CASE v_{name} WHEN 1 THEN {g!r}D WHEN -1 THEN {1 - g!r}D ELSE 1D END)")
        bad.append(f"(CASE v_{name} WHEN 1 THEN {1 - b!r}D WHEN -1 THEN {b!r}D ELSE 1D END)")
    g, b = " * ".join(good), " * ".join(bad)
    return f"({g}) / (({g}) + ({b}))"


def estimate(voted: DataFrame, how: WeakSupervision = WeakSupervision()) -> tuple[float, dict[str, tuple[float, float]]]:
    """EM over the counted vote patterns: share of good documents, accuracies per rule."""
    names = [n for n, _, _ in RULES]
    patterns = stage_table(voted.groupBy(*[f"v_{n}" for n in names]).agg(F.count(F.lit(1)).alias("c")).coalesce(1), "vote-patterns")
    prior, right = how.prior, {n: (how.start, how.start) for n in names}
    within = lambda x: float(min(max(x, 1 - how.high), how.high))
    for _ in range(how.steps):
        scored = patterns.withColumn("q", F.expr(posterior_sql(prior, right)))
        row = scored.selectExpr(
            "sum(c) AS n", "sum(c * q) AS good",
            *[f"sum(CASE WHEN v_{n} = 1 THEN c * q ELSE 0D END) AS gg_{n}" for n in names],
            *[f"sum(CASE WHEN v_{n} <> 0 THEN c * q ELSE 0D END) AS g_{n}" for n in names],
            *[f"sum(CASE WHEN v_{n} = -1 THEN c * (1 - q) ELSE 0D END) AS bb_{n}" for n in names],
            *[f"sum(CASE WHEN v_{n} <> 0 THEN c * (1 - q) ELSE 0D END) AS b_{n}" for n in names]).first()
        if not row["n"]:
            break
        prior = float(min(max(row["good"] / row["n"], 0.02), 0.98))
        # two votes of the starting accuracy steady a rule that hardly votes
        right = {n: (within((row[f"gg_{n}"] + 2 * how.start) / (row[f"g_{n}"] + 2)),
                     within((row[f"bb_{n}"] + 2 * how.start) / (row[f"b_{n}"] + 2))) for n in names}
        right = {n: (g, max(b, 1 - g)) for n, (g, b) in right.items()}
    return prior, right


def judge_quality(docs: DataFrame, how: WeakSupervision = WeakSupervision()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``quality`` (posterior) and ``kept`` per row."""
    voted = stage_table(votes(text_counts(docs)), "quality-votes")
    prior, right = estimate(voted, how)
    out = voted.withColumn("quality", F.expr(posterior_sql(prior, right)))
    out = out.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    return out.withColumn("kept", F.expr(f"NOT base_failed AND quality >= {how.keep_from!r}D"))
