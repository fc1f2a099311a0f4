"""Near-duplicate documents by MinHash bands and odd sketches.

1. Each document becomes its set of word shingles, as 64-bit hashes; documents with
   equal sets form a class, which one row stands for from here on.
2. Minimal hashes under ``BANDS * ROWS`` permutations are cut into bands, whose
   buckets bring candidates together.
3. A bottom MinHash sample (all hashes below a power of two, so that ``SAMPLE`` at most
   are expected; the whole set, if it is small) is folded into an odd sketch: every
   sample flips one bit, so what two documents share cancels in the XOR, and its
   population count tells how much differs. It never exceeds the number of samples
   that differ, so for small sets it turns away no true pair.
4. Every class is compared with one other of each of its buckets, drawn anew for each
   bucket. Where a bucket still has several components, the classes outside its main
   one are compared with all of it. So no pair of a bucket is left both unconnected and
   uncompared. A bucket of similar members emits few pairs; one of many members that are
   mostly not similar, as documents with one long template, emits nearly all of its
   pairs, before the sketches turn them away.
5. Pairs that the sketches pass are confirmed on their full shingle sets, unless they
   are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.components import components
from roadpulse.llm.frames import folded, for_python, only
from roadpulse.llm.words import mix, shingle_sets
from roadpulse.storage import materialise

SHINGLE = 5
PERCENT = 80
# At a similarity of 0.85 (0.8) a pair meets in no band once in 1e8 (5e5) times.
BANDS, ROWS = 25, 4
SAMPLE = 1024
SKETCH_WORDS = 16
# The sketch of a set's own level of sampling, and that of the next, for comparison
# with a set just large enough to be sampled at half the rate.
_OWN = [f"own{i}" for i in range(SKETCH_WORDS)]
_NEXT = [f"next{i}" for i in range(SKETCH_WORDS)]
_SKETCH = ["n_shingles", "level", *_OWN, *_NEXT]
FEATURES = ", ".join(
    ["doc_id bigint", "n_shingles bigint", "sum1 bigint", "sum2 bigint", "level int"]
    + [f"{c} bigint" for c in (*_OWN, *_NEXT)]
    + ["bands array<bigint>"]
)

_SAMPLES = BANDS * ROWS
_draws = np.random.default_rng(20240607)
_FACTORS = (_draws.integers(0, 2**32, _SAMPLES, dtype=np.uint64) | 1).astype(np.uint32)
_SALTS = _draws.integers(0, 2**32, _SAMPLES, dtype=np.uint64).astype(np.uint32)
_ORDINAL = np.arange(_SAMPLES, dtype=np.uint64)


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest hash of each set under each permutation; sets follow each other, none empty."""
    hashes = hashes.astype(np.uint32)
    out = np.empty((len(starts), _SAMPLES), np.uint32)
    for i in range(_SAMPLES):
        out[:, i] = np.minimum.reduceat((hashes ^ _SALTS[i]) * _FACTORS[i], starts)
    return out


def levels(sizes: np.ndarray) -> np.ndarray:
    """How often a set of that size is halved to be expected within ``SAMPLE``."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / SAMPLE))).astype(np.int64)


def odd_sketches(hashes: np.ndarray, owner: np.ndarray, n: int, level: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples of ``n`` sets, ``SKETCH_WORDS`` numbers of 64 bits each.

    A hash is in the sample of level ``k`` if its first ``k`` bits are zero.
    """
    bits = 64 * SKETCH_WORDS
    shift = (64 - np.minimum(level, 63)[owner]).astype(np.uint64)
    sampled = (level[owner] == 0) | (hashes >> np.minimum(shift, np.uint64(63)) == 0)
    spot = owner[sampled] * bits + (hashes[sampled] % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(spot, minlength=n * bits).reshape(n, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def _features(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text"), shingle)
            n = len(sets)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            every = np.concatenate([np.zeros(0, np.uint64), *sets])
            owner = np.repeat(np.arange(n), sizes)
            level = levels(sizes)
            own = odd_sketches(every, owner, n, level)
            following = odd_sketches(every, owner, n, level + 1)
            # Sums over the distinct hashes name a set, whatever its order.
            sums = np.zeros((n, 2), np.uint64)
            band = np.zeros((n, BANDS), np.uint64)
            if len(full):
                starts = (np.cumsum(sizes) - sizes)[full]
                sums[full, 0] = np.add.reduceat(mix(every), starts)
                sums[full, 1] = np.add.reduceat(mix(every ^ np.uint64(0xA5A5A5A55A5A5A5A)), starts)
                samples = minima(every, starts)
                key = np.repeat(_ORDINAL[None, :BANDS], len(full), 0)
                for r in range(ROWS):
                    key = mix((key << np.uint64(8)) ^ mix(key) ^ samples[:, r::ROWS].astype(np.uint64))
                band[full] = key
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band.view(np.int64).ravel()), BANDS)
            numbers = [np.ascontiguousarray(x).view(np.int64) for x in (*sums.T, *own.T, *following.T)]
            flat = [pa.array(x) for x in numbers]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes), *flat[:2], pa.array(level.astype(np.int32)),
                    *flat[2:], bands.cast(pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "sum1", "sum2", "level", *_OWN, *_NEXT, "bands"],
            )

    return run


def _confirm(shingle: int, percent: int):
    """Keeps pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts = shingle_sets(batch.column("text_a"), shingle)
            rights = shingle_sets(batch.column("text_b"), shingle)
            keep = []
            for left, right in zip(lefts, rights, strict=True):
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _as(frame: DataFrame, suffix: str) -> DataFrame:
    """The sketch columns of ``frame`` under names of their own."""
    names = {"doc_id": suffix, **{c: f"{c}_{suffix}" for c in _SKETCH}}
    return frame.select(*[F.col(c).alias(names.get(c, c)) for c in frame.columns])


def _differing() -> Column:
    """Bits in which the sketches of a and b differ, at the coarser of their levels."""

    def count(left: list[str], right: list[str]) -> Column:
        total = F.lit(0)
        for x, y in zip(left, right, strict=True):
            total = total + F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{y}_b")))
        return total

    a, b = F.col("level_a"), F.col("level_b")
    return F.when(a == b, count(_OWN, _OWN)).when(a == b + 1, count(_OWN, _NEXT)).when(a + 1 == b, count(_NEXT, _OWN))


def _close(percent: int) -> Column:
    """Whether sizes and sketches of a and b leave the similarity possible.

    A pair of at least that similarity differs in ``allowed`` shingles at most. Of a
    sample, a share of them is expected, and six deviations more are let pass.
    """
    a, b = F.col("n_shingles_a"), F.col("n_shingles_b")
    sizes = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    allowed = (a + b) * (100 - percent) / (100 + percent)
    level = F.greatest("level_a", "level_b")
    expected = allowed / F.pow(F.lit(2.0), level)
    most = F.when(level == 0, allowed).otherwise(expected + 6 * F.sqrt(expected) + 6)
    return sizes & F.coalesce(_differing() <= most, F.lit(False))


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return materialise(full.mapInArrow(_confirm(shingle, percent), "a bigint, b bigint"), "near-links")


def _with_component(rows: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """``rows`` with the component of ``node``, itself if it has no link yet."""
    known = found.select(F.col("node").alias(node), F.col("component").alias(f"of_{node}"))
    return rows.join(known, node, "left").withColumn(f"of_{node}", F.coalesce(f"of_{node}", node))


def _with_links(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components once the links ``more`` (a, b) join those ``found``."""
    old = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(old.unionByName(more), "a", "b")


def _connected(
    pairs: DataFrame, links: DataFrame, texts: DataFrame, n: int, shingle: int, percent: int
) -> DataFrame:
    """Components of ``links`` and ``pairs`` (a, b, differing) of ``n`` classes, after confirming what matters.

    First each class's most similar partner is confirmed, then whatever is still in
    two components.
    """
    texts = _texts_of(pairs, texts, n)
    best = pairs.groupBy("a").agg(F.min_by("b", "differing").alias("b"))
    best = materialise(folded(best, n), "near-best")
    found = components(links.unionByName(_confirmed(best, texts, shingle, percent)), "a", "b")
    left = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    apart = _with_component(_with_component(left, found, "a"), found, "b").filter("of_a != of_b")
    more = _confirmed(materialise(apart.select("a", "b"), "near-apart"), texts, shingle, percent)
    return found if more.isEmpty() else _with_links(found, more)


def _texts_of(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = materialise(folded(wanted, n), "near-wanted")
    return materialise(texts.join(wanted, "doc_id", "left_semi"), "near-texts")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``documents``.

    Two documents are linked if their sets of ``shingle`` lower-cased words have a
    Jaccard similarity of at least ``percent`` hundredths; ``component_id`` is the
    smallest ``doc_id`` reachable over links and ``kept`` marks it. With fewer words
    the whole sequence is the one shingle. A text that is null, empty or all white
    space has no shingle and no link. Rows that repeat a ``doc_id`` are one document
    with several texts: linked with each other and through each of them. Rows
    without ``doc_id`` take no part: their ``component_id`` and ``kept`` are null.
    An empty table gives an empty result; other columns are not looked at.

    Any number of equal or similar documents may exist: classes and buckets are
    found by aggregates that combine before the shuffle, and their members join
    them as a table that Spark splits where a key is hot.
    """
    for_python(documents.sparkSession)
    texts = only(documents, doc_id=documents["doc_id"].cast("bigint"), text="text")
    features = materialise(texts.mapInArrow(_features(shingle), FEATURES), "near-features")
    n = features.count()

    whole = features.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "sum1", "sum2"]
    classes = whole.groupBy(*key).agg(F.min("doc_id").alias("class"))
    classes = materialise(folded(classes, n), "near-classes")
    members = materialise(features.select("doc_id", *key).join(classes, key, "left"), "near-members")
    reps = classes.select(F.col("class").alias("doc_id"), *key)
    one = whole.join(reps, ["doc_id", *key]).dropDuplicates(["doc_id", *key])
    one = materialise(folded(one, n), "near-reps")
    sketches = one.select("doc_id", *_SKETCH)

    # Every class against one of each of its buckets, the first by a hash of its own.
    banded = one.select("doc_id", F.explode("bands").alias("bucket"))
    draw = F.xxhash64("doc_id", "bucket")
    drawn = banded.groupBy("bucket").agg(
        F.min(draw).alias("draw"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    drawn = materialise(folded(drawn.filter("first < last").select("bucket", "draw"), BANDS * n), "near-drawn")
    shared = materialise(banded.withColumn("own", draw).join(drawn, "bucket"), "near-buckets")
    hubs = materialise(shared.filter("own = draw").select("bucket", F.col("doc_id").alias("hub")), "near-hubs")
    spokes = shared.join(hubs, "bucket").filter("doc_id != hub")
    spokes = spokes.select(F.greatest("doc_id", "hub").alias("a"), F.least("doc_id", "hub").alias("b")).distinct()
    spokes = materialise(folded(spokes, BANDS * n), "near-spokes")
    likely = spokes.join(_as(sketches, "a"), "a").join(_as(sketches, "b"), "b").filter(_close(percent))
    likely = materialise(likely.select("a", "b", _differing().alias("differing")), "near-likely")
    same_id = members.filter("doc_id is not null and class is not null").groupBy("doc_id")
    same_id = same_id.agg(F.min("class").alias("b"), F.max("class").alias("a")).filter("a > b").select("a", "b")
    found = _connected(likely, same_id, texts, n, shingle, percent)

    # Then who is not in the main component of a bucket against all of the bucket.
    known = materialise(_with_component(shared.select("bucket", "doc_id"), found, "doc_id"), "near-known")
    several = known.groupBy("bucket").agg(F.min("of_doc_id").alias("x"), F.max("of_doc_id").alias("y"))
    several = materialise(folded(several.filter("x < y").select("bucket"), BANDS * n), "near-several")
    known = known.join(several, "bucket")
    known = materialise(known, "near-open")
    sizes = known.groupBy("bucket", "of_doc_id").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("bucket").agg(F.max_by("of_doc_id", "n").alias("main"))
    mains = materialise(folded(mains, BANDS * n), "near-mains")
    outside = known.join(mains, "bucket").filter("of_doc_id != main").drop("main")
    outside = materialise(_as(outside.join(sketches, "doc_id"), "a").withColumnRenamed("of_doc_id", "of_a"), "near-out")
    inside = materialise(_as(known.join(sketches, "doc_id"), "b").withColumnRenamed("of_doc_id", "of_b"), "near-in")
    across = outside.join(inside, "bucket").filter((F.col("of_a") != F.col("of_b")) & _close(percent))
    across = across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    across = materialise(across.join(likely, ["a", "b"], "left_anti"), "near-across")
    more = _confirmed(across.select("a", "b"), _texts_of(across, texts, n), shingle, percent)
    if not more.isEmpty():
        found = _with_links(found, more)

    found = found.select(F.col("node").alias("class"), "component")
    joined = members.join(found, "class", "left")
    component = F.coalesce("component", "class", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept")
    )


def deduplicated(documents: DataFrame, **settings) -> DataFrame:
    """``documents`` with one document of each group; rows without ``doc_id`` stay.

    Of rows that repeat a kept ``doc_id``, all stay.
    """
    found = near_duplicates(documents, **settings)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["gone"], "left_anti")
