"""Corpus pipeline: language ID, near-dup, secret redaction, source mixing, tokenizing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and
returns a frame, which ``run`` writes as parquet in the shared checkpoint folder and
rereads as the next stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, langid, mixing, near_dup, secret_scan
from ledgerline.llm.common import stage_table, table
from ledgerline.llm.registry import VOCABULARY

#: A document goes when no language reaches this probability.
LEAST_LANGUAGE_SCORE = 0.5
#: Or when its n-grams are this far (in standard deviations) from what its language has.
LEAST_LANGUAGE_FIT = -2.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that look like a known language; trained on the stage's own labelled rows."""
    # whole rows are carried along as one column, so no name can clash
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    named = langid.identify(rows, keep=("_row",), fit=True)
    known = f"lang_pred <> 'und' AND score >= {LEAST_LANGUAGE_SCORE} AND fit >= {LEAST_LANGUAGE_FIT}"
    return named.where(F.expr(known)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similarity 0.8 or more."""
    return near_dup.keep_one(docs, near_dup.Forest(similar=80))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; the length column follows the text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents until the sources have their target sizes."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; only rows whose ids decode to the very text pass."""
    import public_tokenizers as P

    path = P.path(VOCABULARY)
    rows = bpe.encode(docs, path, P.PATTERN, keep=("doc_id", "lang", "source", "text"))
    rows = bpe.decode(rows, path).where(F.expr("decoded = cast(coalesce(text, '') AS BINARY)"))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix),
    ("tokens", tokens),
]

#: The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage_table(docs, name.replace(" ", "-").lower())
    return docs
