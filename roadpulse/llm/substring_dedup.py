"""Repeated passages by fingerprints of passages of words, grouped by anchor.

A passage of ``WINDOW`` words holds ``WINDOW - ANCHOR + 1`` runs of ``ANCHOR`` words;
the one with the smallest hash is its anchor, so equal passages have equal anchors,
and neighbouring passages mostly share theirs. A run of neighbouring passages with one
anchor is kept together, with the fingerprint of each passage, its path. This stands
in for suffix trees: there are no suffixes, no tree and no repeats of other lengths.

Passages are dealt by the anchor; for anchors that many passages of a sample have, by
the whole passage. So a group fits into memory: sorted by one number of anchor and path,
passages of the same number are a repeat. All but those of the smallest ``doc_id`` are
removed.

Before the shuffle a task looks for repeats among its own documents and sends only the
first of each, so a passage in very many documents is sent once per chunk of a task.

Words are not compared. A passage is told by 63 bits of its anchor and 48 of its path; one
with a frequent anchor, which tells little, by 63 bits of its path and 48 of its anchor.
Both are folded into one 64-bit number, and a false repeat needs an equal number in one
group, so chances grow with the size of a group, not with that of an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only, width
from roadpulse.llm.words import Words, grams, mix, words
from roadpulse.storage import materialise

WINDOW, ANCHOR = 13, 6
# Passages a task works on at a time.
CHUNK = 1 << 20
# One document in so many is looked at to find anchors with very many passages.
# That decides which prefix splits them, not what is found.
SAMPLE_OF = 16
# An anchor with fewer passages in the sample is not split.
HEAVY = 1000
_LEAVES = "part int, anchors binary, docs binary, counts binary, paths binary, known_docs binary, known binary"
_FOUND = "doc_id bigint, keys binary"
_ONE = np.uint64(1)
# What a path is sent as: its low bytes.
_PATH_BYTES = 6
_PATH = np.uint64((1 << 8 * _PATH_BYTES) - 1)


def passages(found: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, path, text number and place of each passage of ``window`` words."""
    path = grams(found.hashes, window)
    text = found.text_of_words()
    whole = np.flatnonzero(text[: len(path)] == text[window - 1 :]) if len(path) else np.zeros(0, np.int64)
    least = grams(found.hashes, anchor)
    # Minimum over window - anchor + 1 neighbours, by doubling.
    size, need = 1, window - anchor + 1
    while size < need:
        step = min(size, need - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return least[whole] & ~_ONE, path[whole], text[whole], whole


def names(anchors: np.ndarray, paths: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands for a passage: its anchor, which is even, or if that is heavy its path, made odd; and 48 bits of the other."""
    alone = np.isin(anchors, heavy)
    return np.where(alone, paths | _ONE, anchors), np.where(alone, anchors >> _ONE, paths) & _PATH


def _packed(paths: np.ndarray) -> bytes:
    return paths.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_PATH_BYTES].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _PATH_BYTES, 8), np.uint8)
    out[:, :_PATH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _PATH_BYTES)
    return out.view("<u8").reshape(-1)


def keys(anchors: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """One number for an anchor and a path."""
    return anchors ^ mix(paths + np.uint64(1))


def _parts(prefix: np.ndarray, n: int) -> np.ndarray:
    return ((mix(prefix) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _by_doc(docs: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The values of each document."""
    if not len(docs):
        return
    order = np.argsort(docs, kind="stable")
    docs, values = docs[order], values[order]
    starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    for lo, hi in zip(starts, [*starts[1:], len(docs)], strict=True):
        yield int(docs[lo]), values[lo:hi].tobytes()


def _leaves(window: int, anchor: int, n_parts: int, heavy):
    def chunk(docs: np.ndarray, anchors: np.ndarray, paths: np.ndarray) -> pa.RecordBatch:
        # Passages in ascending doc_id; a stable sort by key keeps that among equals.
        key = keys(anchors, paths)
        order = np.argsort(key, kind="stable")
        sorted_key, sorted_doc = key[order], docs[order]
        first = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
        smallest = sorted_doc[np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
        later = ~first & (sorted_doc > smallest)
        later &= np.r_[True, (sorted_key[1:] != sorted_key[:-1]) | (sorted_doc[1:] != sorted_doc[:-1])]
        known_docs, known = sorted_doc[later], sorted_key[later]
        sent = np.sort(order[first])
        at, d, a, p = sent, docs[sent], anchors[sent], paths[sent]
        # Neighbours with one anchor make a leaf; those of heavy anchors stand alone.
        alone = (a & _ONE).astype(bool)
        begins = np.r_[True, (at[1:] != at[:-1] + 1) | (d[1:] != d[:-1]) | (a[1:] != a[:-1])] | alone
        begin = np.flatnonzero(begins)
        counts = np.diff(np.r_[begin, len(at)]).astype(np.uint32)
        part = _parts(a[begin], n_parts)
        leaf_order = np.argsort(part, kind="stable")
        by_leaf = np.argsort(np.repeat(part, counts), kind="stable")
        edges = np.searchsorted(part[leaf_order], np.arange(n_parts + 1))
        path_edges = np.r_[0, np.cumsum(counts[leaf_order])]
        la, ld, lc, lp = a[begin][leaf_order], d[begin][leaf_order], counts[leaf_order], p[by_leaf]
        rows = [
            (i, la[lo:hi].tobytes(), ld[lo:hi].tobytes(), lc[lo:hi].tobytes(),
             _packed(lp[path_edges[lo] : path_edges[hi]]), b"", b"")
            for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if hi > lo
        ]
        # What is known to repeat already only passes through.
        known_part = _parts(known_docs.astype(np.uint64), n_parts)
        known_order = np.argsort(known_part, kind="stable")
        edges = np.searchsorted(known_part[known_order], np.arange(n_parts + 1))
        kd, kk = known_docs[known_order], known[known_order]
        rows += [
            (i, b"", b"", b"", b"", kd[lo:hi].tobytes(), kk[lo:hi].tobytes())
            for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if hi > lo
        ]
        kinds = [pa.int32(), *[pa.binary()] * 6]
        names = ["part", "anchors", "docs", "counts", "paths", "known_docs", "known"]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            docs, anchors, paths = (np.concatenate(x) for x in zip(*waiting, strict=True))
            order = np.argsort(docs, kind="stable")
            return chunk(docs[order], anchors[order], paths[order])

        for batch in batches:
            found = words(batch.column("text"))
            anchors, paths, text, _ = passages(found, window, anchor)
            anchors, paths = names(anchors, paths, heavy.value)
            if len(text):
                doc_ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
                waiting.append((doc_ids[text], anchors, paths))
                size += len(text)
            if size >= CHUNK:
                yield flush()
                waiting, size = [], 0
        if size:
            yield flush()

    return run


def _heavy(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, paths, _, _ = passages(words(batch.column("text")), window, anchor)
            once = np.unique(np.stack([anchors, paths]), axis=1)[0] if len(anchors) else anchors
            value, count = np.unique(once, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(count)], names=["anchor", "passages"]
            )

    return run


def _repeats(group: pd.DataFrame) -> pd.DataFrame:
    """The repeats of one group of leaves: per document the keys of passages that a smaller one has."""
    anchors = np.frombuffer(b"".join(group["anchors"]), np.uint64)
    docs = np.frombuffer(b"".join(group["docs"]), np.int64)
    counts = np.frombuffer(b"".join(group["counts"]), np.uint32)
    paths = _unpacked(b"".join(group["paths"]))
    key, doc = keys(np.repeat(anchors, counts), paths), np.repeat(docs, counts)
    # One node per path; its leaves in any order, compared with the smallest.
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    if len(key):
        smallest = np.repeat(np.minimum.reduceat(doc, start), np.diff(np.r_[start, len(key)]))
        later = doc > smallest
        key, doc = key[later], doc[later]
    known_docs = np.frombuffer(b"".join(group["known_docs"]), np.int64)
    known = np.frombuffer(b"".join(group["known"]), np.uint64)
    found = list(_by_doc(np.r_[doc, known_docs], np.r_[key, known]))
    return pd.DataFrame({"doc_id": [d for d, _ in found], "keys": [k for _, k in found]}).astype({"doc_id": "int64"})


def _remove(window: int, anchor: int, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(batch.column("text"))
            anchors, paths, text, place = passages(found, window, anchor)
            key = keys(*names(anchors, paths, heavy.value))
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            listed = batch.column("keys").to_pylist()
            n_words, n_removed, kept = [], [], []
            for i, (raw, repeats) in enumerate(zip(texts, listed, strict=True)):
                # bytes.split() splits by the same white space.
                some = (raw or b"").split()
                n_words.append(len(some))
                if repeats:
                    gone = np.frombuffer(b"".join(repeats), np.uint64)
                    here = slice(edges[i], edges[i + 1])
                    starts = place[here][np.isin(key[here], gone)] - found.bounds[i]
                    steps = np.zeros(len(some) + 1, np.int64)
                    steps[starts] += 1  # starts differ from each other
                    steps[starts + window] -= 1
                    covered = np.cumsum(steps[:-1]) > 0
                    some = [w for w, c in zip(some, covered.tolist(), strict=True) if not c]
                n_removed.append(n_words[-1] - len(some))
                kept.append(b" ".join(some))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def without_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``, one row per row of ``documents``.

    Removes each word covered by ``window`` consecutive words that also stand in a
    document with a smaller ``doc_id``, judged on the whole input. ``kept_text`` is
    the other words, joined by one space. A null or empty text has no words. Rows
    without ``doc_id`` are neither removed from nor held against others; rows that
    repeat a ``doc_id`` are not smaller than each other. An empty table gives an
    empty result; other columns are not looked at.
    """
    if not 0 < anchor < window:
        raise ValueError("an anchor must be shorter than the window")
    spark = documents.sparkSession
    for_python(spark)
    rows = only(documents, doc_id=documents["doc_id"].cast("bigint"), text="text")
    known = rows.filter("doc_id is not null")
    n_parts = 4 * width(spark)
    # At most 16 * n_parts anchors can each have so large a share of the sample.
    counted = materialise(
        known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_OF)) == 0)
        .mapInArrow(_heavy(window, anchor), "anchor bigint, passages bigint")
        .groupBy("anchor")
        .agg(F.sum("passages").alias("passages"))
        .filter(F.col("passages") > HEAVY // 16),
        "repeat-anchors",
    )
    total = counted.agg(F.sum("passages")).first()[0] or 0
    heavy = counted.filter(F.col("passages") > max(HEAVY, total // (16 * n_parts))).select("anchor").collect()
    heavy = spark.sparkContext.broadcast(np.array([r[0] for r in heavy], np.int64).view(np.uint64))
    leaves = known.mapInArrow(_leaves(window, anchor, n_parts, heavy), _LEAVES)
    repeats = leaves.groupBy("part").applyInPandas(_repeats, _FOUND)
    listed = repeats.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    joined = rows.join(listed.withColumnRenamed("doc_id", "_of"), F.col("doc_id") == F.col("_of"), "left")
    return joined.select("doc_id", "text", "keys").mapInArrow(
        _remove(window, anchor, heavy), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
