"""The burst trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from roadpulse.llm import trie


def conversations(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return frame.selectExpr("*", "1 as depth", "'x' as path", "2 as n", "3 as head", "4 as top")


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = f"{len(role or '')}:{role or ''}{text or ''}".encode()
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(key).hexdigest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c // 100 * 100, [])[:h] + turns[h:]
    return out


def brute(paths):
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            below[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in below
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    out = set()
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(who), len(node), parent, len(who), below[node], leaves[node], saved[node], sha))
    return out


def random_rows(seed):
    """Copies, shared openings, ends within others, ties, nulls, repeated rows, a long chain."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 120):
        kind = rng.random()
        if kind < 0.3:
            turns = [("user", "same"), ("assistant", "answer é"), ("user", "again")]
        else:
            turns = [(rng.choice(["user", None, ""]), rng.choice(["a", "bb", "", None, "ccc"])) for _ in range(rng.randrange(1, 9))]
        rows += [(c, rng.choice([k, k, None]), *turn) for k, turn in enumerate(turns)]
    rows += [(1000 + k, j, "user", f"turn {j}") for k in range(20) for j in range(k + 1)]
    rows += rows[:5] + [(None, 1, "user", "nobody")] * 3
    return rows


@pytest.mark.parametrize(("limit", "rounds"), [(trie.CONTAINER_TURNS, trie.ROUNDS), (20, trie.ROUNDS), (20, 2)])
def test_trie_equals_brute_force(spark, limit, rounds):
    rows = random_rows(limit + rounds)
    turns = trie.with_shared_openings(trie.turns_of(conversations(spark, rows)))
    paths = rebuilt(rows)
    assert [] in paths.values()
    got = trie.prefix_trie(turns, limit, rounds).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(paths)


def test_one_hot_conversation_and_ends_in_blocks(spark):
    """Most conversations equal, with ids far apart and below 0; one conversation has most turns."""
    ids = [-(10**12), -3, *range(1, 4000, 7), 10**12]
    rows = [(c, 0, "user", "hello") for c in ids] + [(5, k, "user", f"{k % 3}") for k in range(3000)]
    got = {tuple(r) for r in trie.prefix_trie(trie.turns_of(conversations(spark, rows))).collect()}
    # Without openings: conversation 5 alone differs.
    whole = defaultdict(list)
    for c, k, role, text in rows:
        whole[c].append((k, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    assert got == brute({c: [t[2:] for t in sorted(turns)] for c, turns in whole.items()})


def test_no_conversations(spark):
    frame = trie.conversation_trie(conversations(spark, [(None, 1, "user", "x")]))
    assert frame.collect() == [] and frame.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
