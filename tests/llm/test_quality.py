"""The quality classifier: updates against a plain version, held-out accuracy, odd inputs."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa

from roadpulse.llm import quality

SCHEMA = "doc_id bigint, text string"


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as label", "1 as score", "2 as shard", "3 as slots", "4 as quality")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int").selectExpr("*", "1 as toxic", "'y' as text", "2 as label")


def test_shapes():
    texts = pa.array(["Hello, WORLD!! x9y10", "", None, "ÉTÉ  a\naa", "aaaa"])
    want = [b"Aa, A! a0a0", b"", b"", b"a" + "".encode() + b"Aa  a\na", b"a"]
    got = quality.shapes(texts).to_pylist()
    assert got[:3] == want[:3] and got[4] == b"a" and got[3].split() == [b"aAa", b"a", b"a"]


def test_vectors_have_unit_length_and_know_no_neighbour():
    texts = ["one two two THREE!", "", None, "a b c d e f g h"]
    slots, values, bounds = quality.vectors(pa.array(texts))
    for i, text in enumerate(texts):
        alone = quality.vectors(pa.array([text], pa.string()))
        part = slice(bounds[i], bounds[i + 1])
        assert slots[part].tolist() == alone[0].tolist() and np.allclose(values[part], alone[1])
        rest = values[part][slots[part] != quality.BIAS]
        assert math.isclose((rest**2).sum(), 1 if text else 0) and (slots[part] == quality.BIAS).sum() == 1
    assert quality.AGAIN in slots[bounds[0] : bounds[1]] and quality.AGAIN not in slots[bounds[3] :]


def test_updates_equal_a_plain_version():
    rng = np.random.default_rng(5)
    learner = quality.Learner(np.zeros(50), np.zeros(50))
    z, n = [0.0] * 50, [0.0] * 50
    for _ in range(200):
        slots, label = rng.choice(50, 6, replace=False), float(rng.integers(2))
        values = rng.random(6)
        learner.learn(slots, values, label)
        w = {}
        for i in slots.tolist():
            over = abs(z[i]) - quality.L1
            w[i] = 0.0 if over <= 0 else -math.copysign(over, z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
        p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in zip(slots.tolist(), values, strict=True))))
        for i, x in zip(slots.tolist(), values, strict=True):
            g = (p - label) * x
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
    assert np.allclose(learner.z, z) and np.allclose(learner.n, n)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, known = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = {r["doc_id"]: r for r in quality.quality(docs, known).collect()}
    assert len(found) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in known.collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r["held_out"]} >= set(out)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())
    good, bad = ([found[i]["score"] for i in out if truth[i] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.99
    assert np.mean([found[i]["predicted"] == truth[i] for i in out]) > 0.95


def test_odd_rows(spark):
    good, bad = "A plain sentence of words. ", "BUY!!! NOW!!! $$$ "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5)) for i in range(60)]
    rows += [(None, good), (None, None), (70, ""), (71, None), (72, good * 4000)] + [(1, good)] * 40
    known = [(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (70, None), (71, 5), (1, 1), (1, 1), (999, 0)]
    got = quality.quality(documents(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[72]["score"] > 0.5 > by_id[2]["score"] and not by_id[None]["held_out"]
    assert by_id[70]["score"] == by_id[71]["score"]
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 2
    # Conflicting labels and the held-out fold teach nothing.
    fold = {i for i, _ in known if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = [(i, 1 - q if i in fold and q in (0, 1) else q) for i, q in known]
    again = quality.quality(documents(spark, rows), labels(spark, flipped)).collect()
    assert sorted(again, key=repr) == sorted(got, key=repr)


def test_without_rows_or_labels(spark):
    assert quality.quality(documents(spark, []), labels(spark, [(1, 1)])).collect() == []
    (row,) = quality.quality(documents(spark, [(1, "some text")]), labels(spark, [])).collect()
    assert row["score"] == 0.5 and row["predicted"] == 1
