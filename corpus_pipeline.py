"""Documents to packed sequences: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``n_chars``, where it is present, follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harbormill.llm import language, lines, packing, secrets, simhash
from harbormill.llm.common import checkpoint
from harbormill.session import prepare

TOKENIZER = "word_bpe_49k.json"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text (null or empty) or without a letter go.

    Repeated rows are judged alike, nulls elsewhere do not matter, and an empty table gives no rows.
    """
    prepare(spark)
    model = language.learn(docs.select("doc_id", "lang", "text"))
    prefix = "_own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    judged = language.with_language(docs, model, prefix)
    return judged.where(F.col(f"{prefix}lang_pred") != language.UNKNOWN).select(*[f"`{c}`" for c in docs.columns])


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand elsewhere already; every document stays, if need be without text.

    Null texts stay null, repeated rows lose the same lines, and an empty table gives no rows.
    """
    prepare(spark)
    return _counted(lines.without_repeated_lines(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates; texts without a word, null too, are one group.

    Of repeated rows one stays; an empty table gives no rows.
    """
    prepare(spark)
    return simhash.keep_one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked; every document stays, null texts and repeated rows too. An empty table gives no rows."""
    prepare(spark)
    return _counted(secrets.redact_secrets(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents laid out in sequences, with their ids.

    Null and empty texts give the ending id alone, repeated rows are documents of their own, and an empty table gives no rows.
    """
    prepare(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", known_language),
    ("line_dedup", unrepeated_lines),
    ("simhash_dedup", one_of_each_group),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Tokenizers, hashes of shingles and a fitted model are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written to the shared folder and read by the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = checkpoint(docs)
    return docs
