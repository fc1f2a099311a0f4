"""Interned n-grams and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from roadpulse.llm import ngram_table, resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    "The cat, the CAT sat; on 42 mats.",
    "",
    None,
    "!!! ...",
    "x",
    " ".join(["same"] * 500),
    "w" * 5000 + " " + "é" * 70 + " b",
    " ".join(f"{'long' * (k % 11)}{k % 37} ß" for k in range(400)),
]


def features(text):
    found = WORD.findall((text or "").encode().translate(LOWER))
    return len(found), [b" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]


@pytest.mark.parametrize("block", [ngram_table.BLOCK_WORDS, 1, 10])
def test_tables_equal_brute_force(block):
    words, blocks = ngram_table.tables(pa.array(TEXTS), 997, block)
    assert words.tolist() == [features(t)[0] for t in TEXTS]
    by_text = [Counter() for _ in TEXTS]
    total = np.zeros(997, np.int64)
    for found in blocks:
        total += np.bincount(found.buckets, found.counts, 997).astype(np.int64)
        for text, bucket in zip(found.texts.tolist(), found.buckets[found.slots].tolist(), strict=True):
            by_text[text][bucket] += 1
    want = [Counter(zlib.crc32(f) % 997 for f in features(t)[1]) for t in TEXTS]
    assert by_text == want and dict(enumerate(total.tolist())) == {b: sum(w[b] for w in want) for b in range(997)}


def test_hashes_equal_the_library():
    data = np.frombuffer(bytes(range(256)) * 2 + bytes(8), np.uint8)
    starts = np.arange(200)
    lengths = 1 + starts % 70
    want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]
    assert ngram_table.xxhash64(data, starts, lengths).tolist() == want
    assert ngram_table.crc32(data, starts, lengths).tolist() == [zlib.crc32(data[a : a + n]) for a, n in zip(starts, lengths, strict=True)]


def test_equal_keys_do_not_join_different_ngrams():
    """All keys the same: bytes alone tell slots apart, also beyond the first eight."""
    texts = [b"abcdefgh1", b"abcdefgh2", b"abc", b"abd", b"abcdefgh1", b"abcdefghijklmnopqrs", b"abcdefghijklmnopqrt", b"abc"]
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    slots, owners = ngram_table.intern(data, starts, lengths, np.full(len(texts), 7, np.uint64))
    assert [texts[owners[s]] for s in slots] == texts and len(owners) == len(set(texts))


def brute(rows, target, share=5, least=20):
    bags = [features(t) for _, t in rows]
    s = Counter(zlib.crc32(f) % 10_000 for _, fs in bags for f in fs)
    t = Counter(zlib.crc32(f) % 10_000 for text in target for f in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    out = []
    for (doc_id, _), (n, fs) in zip(rows, bags, strict=True):
        weight = sum(gain(zlib.crc32(f) % 10_000) for f in fs)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n >= least])
    enough = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(enough[: share * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def table(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return frame.selectExpr("*", "'x' as bucket", "1 as gain", "2 as score", "3 as at", "4 as n", "5 as weight")


def test_resampled_equals_brute_force(spark):
    words = [f"w{k % 23}" for k in range(400)]
    rows = [(k, " ".join(words[k : k + 10 + k % 40])) for k in range(120)]
    rows += [(None, t) for t in TEXTS] + [(7, rows[30][1])] * 60 + [(500 + k, t) for k, t in enumerate(TEXTS)]
    target = ["w1 w2 w3 w4", None, "", "the cat w9"]
    got = resampling.resampled(table(spark, rows), table(spark, [(1, t) for t in target]), share_percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, target, share=40)


def test_resampled_without_rows(spark):
    rows = [(1, " ".join(["w"] * 30))] * 40
    assert resampling.resampled(table(spark, []), table(spark, rows)).collect() == []
    got = resampling.resampled(table(spark, rows), table(spark, []))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, [])
