"""Importance resampling of documents towards the n-grams of a target distribution.

Texts become bags of hashed word n-grams. A bucket's gain is the logarithm of how much
likelier it is in the target than in all documents; a document's weight is the sum of the
gains of its n-grams, and adding Gumbel noise to it and taking the highest draws without
replacement in proportion to the exponential of the weights.

Texts are read twice: once to count buckets, once to gather gains. Each time a task
interns the n-grams of some texts in a table (see ``ngram_table``), so a bucket is
computed once per distinct n-gram, and an occurrence only gathers by its slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only, ranked
from roadpulse.llm.ngram_table import tables
from roadpulse.storage import materialise

BUCKETS = 10_000
SCALE = 1000
SEED = 42
SHARE_PERCENT, LEAST_WORDS = 5, 20
# Text bytes a task interns at a time.
_BATCH_BYTES = 1 << 22


def _together(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Arrow batches joined until their texts fill a table."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.column(column).nbytes
        if size >= _BATCH_BYTES:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name).chunks
    return chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks) if chunks else pa.array([], pa.string())


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often the n-grams of all ``text`` fall into each bucket that has any.

    A task sends one row per bucket, whatever it has read.
    """
    for_python(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in _together(batches, "text"):
            for block in tables(_column(table, "text"), buckets)[1]:
                # Sums of whole numbers below 2 ** 53 are exact.
                total += np.bincount(block.buckets, block.counts, buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counts = only(texts, text="text").mapInArrow(run, "bucket int, n bigint")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` of every bucket, from two tables of bucket counts; one count is added to each."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s = source.select("bucket", F.col("n").alias("s"))
    t = target.select("bucket", F.col("n").alias("t"))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1.0) * (F.col("all_s") + float(buckets)) / ((F.col("s") + 1.0) * (F.col("all_t") + float(buckets)))
    return both.crossJoin(F.broadcast(sums)).select("bucket", F.floor(SCALE * F.log(ratio)).cast("bigint").alias("gain"))


def weighted(documents: DataFrame, gains: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row; a null or empty text has 0 of all three.

    ``gains`` has one row per bucket, so what is sent to the tasks is bounded by ``buckets``.
    """
    spark = documents.sparkSession
    for_python(spark)
    table_of = np.zeros(buckets, np.int64)
    for row in gains.collect():
        table_of[row["bucket"]] = row["gain"]
    shared = spark.sparkContext.broadcast(table_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for table in _together(batches, "text"):
            n = table.num_rows
            words, blocks = tables(_column(table, "text"), buckets)
            features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for block in blocks:
                features += np.bincount(block.texts, minlength=n)
                gathered = gain[block.buckets][block.slots]
                weight += np.bincount(block.texts, gathered, n).astype(np.int64)
            columns = [_column(table, "doc_id"), *(pa.array(x.astype(np.int64)) for x in (words, features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    rows = only(documents, doc_id=documents["doc_id"].cast("bigint"), text="text")
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of a document, in thousandths: it depends on its id and the seed alone; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-float(SCALE) * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("bigint")


def resampled(
    documents: DataFrame,
    target: DataFrame,
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``, one row per row of ``documents``.

    Of the N documents with ``least_words`` words or more, ``share_percent`` of N (rounded
    down) with the highest scores are drawn and ranked from 1, ties to the smaller
    ``doc_id``, null last, then to the smaller ``n_features``; the others have no rank.
    Whole texts count. Null and empty texts have no features and weight 0; repeated rows
    are documents of their own; empty tables give an empty result, and an empty target
    gives gains against it alone. Other columns are not looked at.

    Ranks come from a range partitioning of five numbers per document, over all tasks.
    """
    gains = bucket_gains(bucket_counts(documents, buckets), bucket_counts(target, buckets), buckets)
    scored = weighted(documents, gains, buckets).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = materialise(scored, "resampling-scores")
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    placed = ranked(scored.where(enough), order, "resampling-order")
    drawn = F.expr(f"{int(share_percent)} * {scored.where(enough).count()} div 100")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~enough).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank.cast("bigint").alias("rank")).unionByName(rest)
