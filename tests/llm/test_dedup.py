"""Near duplicates and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from roadpulse import storage
from roadpulse.llm import components as components_module
from roadpulse.llm import near_dup, substring_dedup
from roadpulse.llm.components import components
from roadpulse.llm.words import grams, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return frame.selectExpr("*", "'x' as component", "1 as class", "2 as bucket", "3 as keys")


def shingles(text):
    found = WORD.findall((text or "").translate(LOWER))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def brute_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def family(rng, size, n, changes):
    """A text and copies of it with some words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randrange(changes + 1)):
            some[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(some))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = []
    for size, n, changes in ((200, 60, 12), (60, 30, 3), (1500, 12, 60), (30, 20, 2)):
        texts += family(rng, size, n, changes)
    texts += [texts[0]] * 40 + [texts[0].upper()] + ["a b", "A  b", "a b c", "\t\n", "", None, "é É", "É É"]
    texts += [" ".join(f"q{rng.randrange(300)}" for _ in range(50)) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0])]
    got = near_dup.near_duplicates(documents(spark, rows), percent=percent).collect()
    assert len(got) == len(rows)
    want = brute_components(rows, percent)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"] is None
            continue
        assert r["component_id"] == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] == len(shingles(texts[r["doc_id"]]))


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e f g"), (3, "A b c d e f g"), (9, "other"), (None, "a b c d e f g"), (7, None), (8, None)]
    kept = near_dup.deduplicated(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1) for r in kept) == [-1, 3, 7, 8, 9]
    assert len(kept[0]) == 6


def test_no_documents(spark):
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0
    assert substring_dedup.without_repeats(documents(spark, [])).count() == 0


def test_sketches_turn_away_no_close_pair():
    """Differing bits never exceed differing samples."""
    rng = np.random.default_rng(3)
    for size in (5, 300, 1024, 1025, 5000):
        base = rng.integers(0, 2**63, size).astype(np.uint64)
        other = np.r_[base[size // 20 :], rng.integers(0, 2**63, size // 20).astype(np.uint64)]
        both, owner = np.r_[base, other], np.repeat([0, 1], [len(base), len(other)])
        level = np.full(2, near_dup.levels(np.array([size]))[0])
        a, b = near_dup.odd_sketches(both, owner, 2, level)
        bits = int(np.unpackbits((a ^ b).view(np.uint8)).sum())
        differing = len(np.setxor1d(base, other))
        assert bits <= differing
        if level[0] == 0 and differing < 100:
            assert bits >= differing * 0.8


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (40, 39)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
    assert {r["node"]: r["component"] for r in got if r["node"] != r["component"]} == want


def test_forest_keeps_what_is_connected():
    """Against a walk over the links; each node but the smallest of its component comes once."""
    rng = np.random.default_rng(5)
    for nodes, n in ((2, 1), (30, 12), (200, 150), (50, 400)):
        ends = np.sort(rng.integers(-nodes, nodes, (n, 2)), axis=1)
        ends = ends[ends[:, 0] != ends[:, 1]]
        node, least = components_module.forest(ends[:, 1], ends[:, 0])
        want = {int(x): int(x) for x in np.unique(ends)}
        for _ in want:
            for a, b in ends.tolist():
                want[a] = want[b] = min(want[a], want[b])
        assert dict(zip(node.tolist(), least.tolist(), strict=True)) == {a: b for a, b in want.items() if a != b}
        assert len(set(node.tolist())) == len(node)


@pytest.mark.parametrize("local", [1, 1 << 18])
def test_components_write_few_tables(spark, monkeypatch, local):
    """A chain whose links are dealt over many partitions; no table has a file for each of them."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(components_module, "LOCAL_LINKS", local)
    written = []

    def materialise(rows, label):
        out = storage.materialise(rows, label)
        written.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(components_module, "materialise", materialise)
    try:
        links = spark.range(60).selectExpr("id as a", "id + 1 as b").repartition(9, "a")
        got = {r["node"]: r["component"] for r in components(links, "a", "b").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(1, 61), 0)
    cores = spark.sparkContext.defaultParallelism
    assert all(files <= max(cores, 9) for _, files in written), written


def test_words_equal_a_regular_expression():
    texts = ["", None, " a b\tc\x0bd\n", "é" * 300 + " x", "\x1c\x85y", "w " * 50]
    found = words(pa.array(texts))
    assert np.diff(found.bounds).tolist() == [len(WORD.findall(t or "")) for t in texts]
    again = words(pa.array(["x", "w", "w w"]))
    assert again.hashes[1] == again.hashes[2] == found.hashes[-1] and again.hashes[0] != again.hashes[1]
    assert len(grams(found.hashes[:3], 5)) == 0


def brute_repeats(rows, window=13):
    first = defaultdict(list)
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k : k + window])].append(i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and min(first[tuple(w[k : k + window])]) < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [False, True])
def test_passages_equal_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(substring_dedup, "CHUNK", 500)
    if heavy:  # every anchor is split by the whole passage
        monkeypatch.setattr(substring_dedup, "SAMPLE_OF", 1)
        monkeypatch.setattr(substring_dedup, "HEAVY", 0)
    rng = random.Random(4)
    passages = [[f"p{k}_{n}" for n in range(rng.choice([12, 13, 14, 40]))] for k in range(12)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(4)):
            text += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20))]
            text += rng.choice(passages)
        rows.append((i, "  ".join(text) + "\n"))
    rows += [(200, "z " * 60), (201, "z " * 13), (202, "z " * 12), (203, None), (204, ""), (None, "z " * 30)]
    rows += [(201, "z " * 20), (50, rows[10][1])]
    rng.shuffle(rows)
    got = substring_dedup.without_repeats(documents(spark, rows).repartition(5)).collect()
    found = [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got]
    assert sorted(found, key=str) == brute_repeats(rows)


def test_window_must_hold_an_anchor(spark):
    with pytest.raises(ValueError, match="anchor"):
        substring_dedup.without_repeats(documents(spark, []), window=5, anchor=5)


@pytest.mark.parametrize("heavy", [True, False])
def test_many_passages_of_one_anchor_are_told_apart(spark, heavy, monkeypatch):
    """300,000 different passages around the same six words, some of them repeated on purpose."""
    monkeypatch.setattr(substring_dedup, "HEAVY", 1000 if heavy else 10**9)
    found = words(pa.array([" ".join(f"a{k}" for k in range(4000))]))
    runs = grams(found.hashes, 6)
    at = int(np.argmin(runs))
    common = " ".join(f"a{k}" for k in range(at, at + 6))
    texts = [" . ".join(f"x{i}p{j} y{i}q{j} z{i} {common} u{j} v{i}r{j} w{j}" for j in range(100)) for i in range(3000)]
    again = f"x7p5 y7q5 z7 {common} u5 v7r5 w5 ."
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000, f"begin here {again} and end there")]
    got = {r["doc_id"]: r for r in substring_dedup.without_repeats(documents(spark, rows)).collect()}
    assert {i: r["n_removed"] for i, r in got.items() if r["n_removed"]} == {9000: 13}
    assert got[9000]["kept_text"] == "begin here and end there"
