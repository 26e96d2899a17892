"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, ce_score, langid, merkle, mixing, near_dup, nra, pfp_dedup, quality, secret_scan, ss_packing, topk,
               url_reputation)
from .common import table

URL_RULES = [url_reputation.Rule(*r) for r in (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]
SHOWN_DOCUMENT = "^[^:]*://[^/?#]*/[^/?#]*/([0-9]+)"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document it shows, whose number is in the url's path
    (``host/language/number``); a page without such a number has none."""
    pages = table(spark, sf_dir, "pages")
    shown = pages.selectExpr("page_id", f"try_cast(regexp_extract(url, '{SHOWN_DOCUMENT}', 1) AS BIGINT) AS doc_id").distinct()
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "cast(quality = 1 AND toxic = 0 AS INT) AS good")
    outcomes = shown.join(labels, "doc_id").select("page_id", "good")
    out = url_reputation.filter_urls(pages, outcomes, URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "n_labelled", F.round("good_rate", 6).alias("good_rate"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    return langid.identify(docs, keep=("doc_id", "held_out"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pfp_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.selectExpr(
        "doc_id", "n_bytes", "n_bytes - length(kept) AS n_removed", "cast(size(removed) AS BIGINT) AS n_spans",
        "sha2(kept, 256) AS kept_sha256")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    n = "cast(size(filter(spans, x -> x.kind = '{0}')) AS BIGINT) AS n_{0}"
    return secret_scan.scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", n.format("assign"), n.format("access"), n.format("hex"),
        f"sha2({joined.format('filter(spans, x -> x.kind <> ' + repr('random') + ')')}, 256) AS base_sha256",
        f"{joined.format('spans')} AS spans")


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path(VOCABULARY)
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, P.PATTERN)
    return bpe.decode(ids, path).selectExpr(
        "doc_id", "cast(size(ids) AS BIGINT) AS n_tokens", "sha2(array_join(ids, ','), 256) AS ids_sha256",
        "sha2(decoded, 256) AS decoded_sha256")


def op10_ce_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return ce_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering deletes the line breaks of every document whose id has an even checksum."""
    return merkle.verify(table(spark, sf_dir, "documents"), "crc32(cast(doc_id AS STRING)) % 2 = 0", r"replace(text, '\n', '')")


def op13_ss_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    cut = ss_packing.pieces(table(spark, sf_dir, "documents"), P.path(WORD_VOCABULARY))
    return ss_packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_url_reputation, op2_topk_search, op3_langid, op4_mix_sources, op5_substring_dedup, op6_quality_rules,
        op7_secret_scan, op8_near_dup, op9_bpe, op10_ce_difference, op11_nra_search, op12_merkle_manifest,
        op13_ss_packing, pipeline)}
