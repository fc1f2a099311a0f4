"""Quality of documents: logistic regression over hashed word n-grams, by follow the regularised leader.

A text's n-grams are runs of one and two of its words in lower case, and runs of one to
three of its words' shapes (``Word,`` is ``Aa,``), which say the same in every language, and pairs of equal words.
Their hashes name the slots of a sparse vector of unit length, each with the root of its
count.

The labelled sample is dealt into shards. In each round every shard takes one pass of
FTRL-proximal updates from the state all share, and the states are averaged, so no task
learns from more than its shard. A score is the sparse dot product of a text's vector
with the weights, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only
from roadpulse.llm.words import grams, joined_bytes, mix, words
from roadpulse.storage import fresh_path, materialise

SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS
BIAS, AGAIN = 0, 1  # the slot every text has, that of a word twice in a row
# The model learns from at most about so many labelled documents, whole.
TRAIN_ROWS = 20_000
SHARDS, ROUNDS = 8, 8
# FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.01
THRESHOLD = 0.3
HELD_OUT, FOLDS = 0, 5
# Text bytes whose n-grams a task holds at a time, unless one text has more; some 60 times that in memory.
_BATCH_BYTES = 1 << 20

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def fold(doc_id: Column) -> Column:
    """The fold of a document, by the CRC-32 of its id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def shapes(texts: pa.Array) -> pa.Array:
    """Texts with letters as ``a`` or ``A``, digits as ``0``, and each run of one sign in a word as one."""
    data, starts = joined_bytes(texts)
    data = _SHAPE[data]
    kept = _SPACE[data]
    kept[:1] = True
    kept[1:] |= data[1:] != data[:-1]
    # Each text ends with a line feed, which is kept, so places before it move by what is gone.
    places = np.concatenate(([0], np.cumsum(kept)))[starts]
    whole, edges = memoryview(data[kept]), places.tolist()
    return pa.array([bytes(whole[a : b - 1]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary())


def vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all texts' sparse vectors, and where each text's start; every text has the bias."""
    n = len(texts)
    owners, slots = [np.arange(n)], [np.full(n, BIAS)]
    for kind, (found, longest) in enumerate(((words(texts, lower=True), 2), (words(shapes(texts)), 3))):
        owner = found.text_of_words()
        for size in range(1, longest + 1):
            if len(owner) < size:
                continue
            inside = owner[size - 1 :] == owner[: len(owner) - size + 1]
            salt = np.uint64(0x9E3779B97F4A7C15 * (8 * kind + size) % 2**64)
            hashes = mix(grams(found.hashes, size)[inside] ^ salt)
            owners.append(owner[: len(owner) - size + 1][inside])
            slots.append(2 + (hashes % np.uint64(SLOTS - 2)).astype(np.int64))
        if not kind and len(owner) > 1:
            # A pair of equal words says the same whatever the word.
            again = np.flatnonzero((owner[1:] == owner[:-1]) & (found.hashes[1:] == found.hashes[:-1]))
            owners.append(owner[again])
            slots.append(np.full(len(again), AGAIN))
    pairs, counts = np.unique((np.concatenate(owners) << SLOT_BITS) | np.concatenate(slots), return_counts=True)
    owner, slot = pairs >> SLOT_BITS, pairs & (SLOTS - 1)
    values = np.sqrt(counts.astype(np.float64))
    bounds = np.searchsorted(owner, np.arange(n + 1))
    biased = slot == BIAS
    values[biased] = 0.0
    length = np.sqrt(np.add.reduceat(values * values, bounds[:-1])) if n else np.zeros(0)
    values /= np.repeat(np.maximum(length, 1e-9), np.diff(bounds))
    values[biased] = 1.0
    return slot, values, bounds


class Learner:
    """The state of FTRL-proximal: adjusted gradient sums and squared gradient sums, by slot."""

    def __init__(self, z: np.ndarray, n: np.ndarray) -> None:
        self.z, self.n = z, n

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        weights = self.weights(slots)
        gradient = (probability(weights @ values) - label) * values
        before = self.n[slots]
        after = before + gradient * gradient
        self.z[slots] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * weights
        self.n[slots] = after


def probability(total):
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, label, text`` of at most about ``rows`` labelled documents, one row per id.

    Ids with both labels are left out; of several texts of an id the first in order counts.
    """
    known = only(labels, doc_id=labels["doc_id"].cast("bigint"), label=labels["quality"].cast("int"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    part = min(1.0, rows / max(known.count(), 1))
    some = materialise(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20))), "quality-labels")
    texts = only(documents, doc_id=documents["doc_id"].cast("bigint"), text=F.coalesce(documents["text"], F.lit("")))
    # The sample is bounded by its parameter, so it may be sent to every task.
    return texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _one_pass(shared: Broadcast, shard: int, turn: int):
    """One pass over a shard from the shared state, in an order of its own for each round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "label"))
            lists = [batch.column(c) for c in ("slots", "values")]
            edges = lists[0].offsets.to_numpy()
            slots, values = (x.values.to_numpy() for x in lists)
            places = mix(ids.view(np.uint64) + np.uint64(turn)).tolist()
            rows += [
                (place, slots[lo:hi], values[lo:hi], label)
                for place, lo, hi, label in zip(places, edges, edges[1:], labels.tolist(), strict=False)
            ]
        z, n = shared.value
        learner = Learner(z.copy(), n.copy())
        for _, slots, values, label in sorted(rows, key=lambda row: row[0]):
            learner.learn(slots, values.astype(np.float64), label)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "z": [learner.z.astype("<f4").tobytes()], "n": [learner.n.astype("<f4").tobytes()]})

    return run


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights by slot, learned from ``labels`` (``doc_id``, ``quality`` 0 or 1) of ``documents``.

    Rows without an id or with another label are not looked at; without any, the
    weights are 0 and every score is one half. What the driver gets in a round is two
    numbers of four bytes per slot and shard, whatever the input.
    """
    spark = documents.sparkSession
    for_python(spark)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _pieces(whole)):
            slots, values, bounds = vectors(batch.column("text"))
            offsets = pa.array(bounds.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (slots.astype(np.int32), values.astype(np.float32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *lists], names=["doc_id", "label", "slots", "values"]
            )

    schema = "doc_id bigint, label int, slots array<int>, values array<float>"
    sample = _sample(documents, labels, rows).mapInArrow(featurise, schema)
    path = fresh_path(spark, "quality-sample")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).cast("int")
    sample.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
    # A shard is one task, which reads it where it was written: no round shuffles the sample.
    stored = spark.read.schema(f"{schema}, shard int").parquet(path)
    shards = [stored.where(F.col("shard") == k).drop("shard").coalesce(1) for k in range(SHARDS)]
    state = Learner(np.zeros(SLOTS), np.zeros(SLOTS))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((state.z, state.n))
        passes = [part.mapInArrow(_one_pass(shared, k, turn), "shard int, z binary, n binary") for k, part in enumerate(shards)]
        found = sorted(reduce(DataFrame.unionAll, passes).collect(), key=lambda row: row["shard"])
        if not found:
            break
        state = Learner(*(np.mean([np.frombuffer(row[name], "<f4") for row in found], axis=0, dtype=np.float64) for name in ("z", "n")))
        shared.destroy()
    return state.weights()


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where its texts would be too many bytes."""
    sizes = [0 if t is None else len(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
    start, total = 0, 0
    for at, size in enumerate(sizes):
        if at > start and total + size > _BATCH_BYTES:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def scored(documents: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of each row of ``documents``, from whole texts alone.

    A null or empty text has the score of the bias. Repeated rows and null ids are
    scored as any other; an empty table gives an empty result; other columns are not
    looked at.
    """
    spark = documents.sparkSession
    for_python(spark)
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _pieces(whole)):
            slots, values, bounds = vectors(batch.column("text"))
            score = probability(np.add.reduceat(shared.value[slots] * values, bounds[:-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    rows = only(documents, doc_id=documents["doc_id"].cast("bigint"), text="text")
    found = rows.mapInArrow(run, "doc_id bigint, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learned from the labels outside the held-out fold.

    A null id is in no fold: its label is not used, and ``held_out`` is false.
    """
    train_rows = labels.where(labels["doc_id"].isNotNull() & (fold(labels["doc_id"]) != HELD_OUT))
    found = scored(documents, train(documents, train_rows))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
