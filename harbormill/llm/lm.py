"""Stupid-backoff scores of documents from n-gram count tables of the same corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harbormill.llm.common import checkpoint, shuffle_partitions, worker_state
from harbormill.llm.packing import WordCoder

# Fixed value: the weight of a step down to the shorter n-gram.
BACKOFF = 0.4
# A bigram must occur so often in the corpus to be in its table: what occurs once was seen in the scored text alone.
LEAST_COUNT = 2


def vocabulary_size(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    if (size + 1) ** 2 > 1 << 32:
        raise ValueError("a pair of ids must fit 32 bits")
    return size


def bigrams(docs: DataFrame, tokenizer: str, vocabulary: int, labels: list[int]) -> DataFrame:
    """(bucket, doc_ids, grams, times): a batch of documents' bigrams that hash to a bucket, in arrays of equal length.

    A document is read as boundary, its ids, boundary; the boundary's id is ``vocabulary``. A gram is first id times
    (vocabulary + 1) plus second id, as a 32-bit pattern: exact, without collisions. Repeats in a document are folded.
    Arrays instead of rows keep what is shuffled to a few bytes a bigram. Buckets bear the given labels.
    """
    base = vocabulary + 1
    named = np.array(labels, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("words")
        if tokenizer not in state:
            state[tokenizer] = WordCoder(tokenizer)
        coder = state[tokenizer]
        border = np.array([vocabulary], dtype=np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            parts, owner = [], []
            for n, text in enumerate(batch.column("text").to_pylist()):
                word = np.concatenate([border, np.frombuffer(coder.encode(text or ""), dtype="<u4").astype(np.int64), border])
                gram, times = np.unique(word[:-1] * base + word[1:], return_counts=True)
                parts.append(np.stack([gram, times]))
                owner.append(np.full(len(gram), n))
            if not parts:
                continue
            (gram, times), owner = np.concatenate(parts, axis=1), np.concatenate(owner)
            mixed = (gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            bucket = (mixed % np.uint64(len(named))).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            offsets = pa.array(np.append(first, len(order)).astype(np.int32))
            arrays = (ids.take(pa.array(owner[order])), pa.array(gram[order].astype(np.uint32).view(np.int32)), pa.array(times[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(named[found]), *[pa.ListArray.from_arrays(offsets, a) for a in arrays]], ["bucket", "doc_ids", "grams", "times"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"bucket int, doc_ids array<{id_type}>, grams array<int>, times array<int>")


def bucket_labels(spark: SparkSession, partitions: int) -> list[int]:
    """A number for each partition that hash partitioning sends there, so that every partition gets one bucket."""
    numbers = spark.range(64 * partitions).select(F.col("id").cast("int").alias("label"))
    place = F.pmod(F.hash("label"), F.lit(partitions))
    return [r["label"] for r in numbers.groupBy(place.alias("place")).agg(F.min("label").alias("label")).collect()]


def backoff_scores(docs: DataFrame, tokenizer: str, least_count: int = LEAST_COUNT, backoff: float = BACKOFF) -> DataFrame:
    """One row per doc_id: n_tokens, n_backoff, log_score, mean_log_score.

    Counts are taken over all documents, in the ids of ``tokenizer``, with a boundary before and after each document.
    With c(a b) and c(a) the counts and N the number of all tokens, b after a scores c(a b) / c(a) if the bigram
    is in the table, which takes ``least_count`` occurrences, else ``backoff`` * c(b) / N. log_score is the sum of
    the natural logarithms over the tokens of the document and its closing boundary (n_tokens), n_backoff the number that
    backed off.

    The exploded bigrams are dealt by hash once. Count table and bigrams then meet in the same partition, and every partition
    sends one partial sum per document. The unigram table follows from the bigram table; it has a row per id of the
    tokenizer, 65,536 at most, and is broadcast under that bound.

    Null and empty texts are two boundaries. Rows that repeat a doc_id, null too, are scored as one document. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    vocabulary = vocabulary_size(tokenizer)
    base = vocabulary + 1
    dealt = bigrams(docs, tokenizer, vocabulary, bucket_labels(spark, partitions)).repartition(partitions, "bucket")
    # not to be pushed down and true of every row: all uses below then need the same columns, so the exchange is made once
    dealt = dealt.where(F.monotonically_increasing_id() + F.size("doc_ids") + F.size("grams") + F.size("times") >= 0)
    entries = dealt.select("bucket", "doc_ids", "times", F.posexplode("grams").alias("at", "gram")).select(
        "bucket", "gram", F.get("doc_ids", F.col("at")).alias("doc_id"), F.get("times", F.col("at")).alias("n")
    )
    counts = entries.groupBy("bucket", "gram").agg(F.sum("n").alias("both"))
    gram = F.col("gram").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    first, second = F.floor(gram / base), F.pmod(gram, F.lit(base))
    unigrams = counts.groupBy(first.alias("id")).agg(F.sum("both").alias("c"))
    total = unigrams.agg(F.sum("c")).scalar()
    before, after = F.broadcast(unigrams.alias("before")), F.broadcast(unigrams.alias("after"))
    known = F.col("both") >= least_count
    table = (
        counts.withColumns({"first": first, "second": second})
        .join(before, F.col("first") == F.col("before.id"))
        .join(after, F.col("second") == F.col("after.id"))
        .select(
            "bucket",
            "gram",
            known.alias("known"),
            F.when(known, F.ln(F.col("both") / F.col("before.c"))).otherwise(F.ln("after.c") + math.log(backoff)).alias("score"),
        )
    )
    sums = (
        entries.join(table.hint("shuffle_hash"), ["bucket", "gram"])
        .groupBy("doc_id")
        .agg(
            F.sum("n").alias("n_tokens"),
            F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).cast("long").alias("n_backoff"),
            F.sum(F.col("n") * F.col("score")).alias("part"),
        )
    )
    # both sides of the join are dealt by bucket already, which is one of its two keys; the session gets its setting back
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        sums = checkpoint(sums.withColumn("total", total))
    finally:
        spark.conf.set(setting, before)
    score = F.col("part") - F.col("n_backoff") * F.ln("total")
    return sums.select("doc_id", "n_tokens", "n_backoff", score.alias("log_score"), (score / F.col("n_tokens")).alias("mean_log_score"))
