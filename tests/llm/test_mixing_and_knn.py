"""Mixing to target weights and exact top-k search."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import knn, mixing

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, `at` int"


def documents(spark, rows):
    """(doc_id, text, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, s, None, "x", 1) for i, t, s in rows], DOCUMENT)


def water_fill(sizes: dict) -> dict:
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def test_mixture_meets_targets(spark):
    rng = np.random.default_rng(1)
    sources = ["a", "b", "c", "d", None, "empty"]
    rows = []
    for i in range(3000):
        source = sources[0] if i % 3 == 0 else sources[int(rng.integers(0, 5))]
        rows.append((i, " ".join(["w"] * int(rng.integers(0, 60))), source))
    rows += [(5000, None, "empty"), (5001, "", "empty"), (7, "twice", "a"), (7, "twice", "a"), (None, "no id", "b")]
    frame = documents(spark, rows)
    got = mixing.mixture(frame).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = water_fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 2 and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 120
    again = mixing.mixture(frame.repartition(7)).collect()
    key = lambda r: (r["doc_id"] or -1, r["source"] or "", r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows_are_whole(spark):
    rows = [(i, "a b c", "x") for i in range(40)] + [(i, "d e", "y") for i in range(40, 50)]
    frame = documents(spark, rows)
    counts = {r["doc_id"]: r["copies"] for r in mixing.mixture(frame).collect()}
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in counts.items() if n}


def test_mixture_of_nothing(spark):
    assert mixing.mixture(documents(spark, [])).count() == 0
    only_empty = mixing.mixture(documents(spark, [(1, None, None), (2, " ", "s")])).collect()
    assert [(r["target"], r["taken"]) for r in only_empty] == [(0.0, 0), (0.0, 0)]


def brute(rows, k, every):
    vectors = [
        (i, np.floor(256 * np.array(v, float)))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, x in vectors:
        if q % every == 0:
            scores = sorted(
                ((-int(x[: len(y)] @ y[: len(x)]), i) for i, y in vectors if i != q)
            )
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("slice_rows", [17, 600])
def test_top_k_equals_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(knn, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 5)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(4, 8))
    rows = [(i, [float(x) for x in centre[i % 4] * (1 + i % 3) + rng.normal(size=8) * 0.2]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # one vector very often: ties
    rows += [(300, None), (350, [1.0, None] + [0.0] * 6), (400, [float("nan")] * 8), (450, [float("inf")] * 8)]
    rows += [(500, [0.5, 0.5]), (None, [1.0] * 8), (550, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cell string")
    got = sorted(map(tuple, knn.top_k(frame, every=10).collect()))
    assert got == brute(rows, 5, 10)


@pytest.mark.parametrize("spread", [0.0, 0.01, 3.0])
def test_top_k_of_repeated_ids(spark, monkeypatch, spread):
    """An id with a third of the rows, others with a few: all pairs of rows, as in the SQL."""
    monkeypatch.setattr(knn, "SLICE_ROWS", 60)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 8)) * 4
    rows = [(i, centre[i % 6] + rng.normal(size=8)) for i in range(1, 401)]
    rows += [(0, centre[0] + spread * rng.normal(size=8)) for _ in range(200)]
    rows += [(50, rows[49][1]) for _ in range(2)] + [(100, rng.normal(size=8)) for _ in range(3)] + [(7, rows[6][1])] * 9
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted(map(tuple, knn.top_k(frame).collect()))
    vectors = [(i, np.floor(256 * np.array(v))) for i, v in rows]
    want = []
    for q in sorted({i for i, _ in rows if i % 50 == 0}):
        pairs = sorted((-int(x @ y), i) for p, x in vectors if p == q for i, y in vectors if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(pairs[:5])]
    assert got == sorted(want)


def test_top_k_beside_rows_of_the_query(spark):
    """The query's own rows lie on a pivot, nearer than any other id."""
    rng = np.random.default_rng(4)
    rows = [(0, [50.0, 0.0, 0.0])] * 60 + [(i, [float(x) for x in rng.normal(size=3)]) for i in range(1, 41)]
    got = sorted(map(tuple, knn.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()))
    best = min((-256 * 50 * int(np.floor(256 * v[0])), i) for i, v in rows if i)
    assert got == [(0, n, best[1], -best[0]) for n in range(1, 6)]


def test_bounds_count_ids(spark):
    """Rows of the query's own id do not stand for its neighbours."""
    pivots = np.array([[0.0, 0.0], [100.0, 0.0]])
    near = [(0, 0.0), (0, 0.1), (0, 0.2), (1, 0.1)]
    limit = knn.bounds(pivots, {0: 1.0}, near, 2, [9, 9, 9, 4])
    assert limit[0][1] < 0


def test_top_k_of_few(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert knn.top_k(spark.createDataFrame([], schema)).count() == 0
    assert knn.top_k(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)).count() == 0
    three = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [2.0])], schema)
    assert sorted(map(tuple, knn.top_k(three).collect())) == [(0, 1, 2, 131072), (0, 2, 1, 65536)]


def test_bounds_prune(spark):
    """Far cells are not sent to a block whose neighbours are near."""
    pivots = np.array([[0.0, 0.0], [100.0, 0.0]])
    limit = knn.bounds(pivots, {0: 1.0}, [(0, 0.5), (0, 0.6), (1, 0.1)], 2)
    assert limit[0][0] < 0 < 90 < limit[0][1]


def test_words_are_counted_by_ascii_white_space(spark):
    frame = spark.createDataFrame([(" a b\tc\x0bd\n",), (None,), ("",)], "text string")
    assert [r[0] for r in frame.select(mixing.words(F.col("text"))).collect()] == [3, 0, 0]
