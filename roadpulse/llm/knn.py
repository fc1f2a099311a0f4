"""Exact top-k inner products as a Voronoi kNN join.

With one more component, ``sqrt(M**2 - |x|**2)`` for data (``M`` the largest norm) and 0
for queries, the squared distance is ``|q|**2 + M**2 - 2 q.x``: the largest inner
products are the nearest neighbours, and the triangle inequality holds.

1. Data and queries go to the nearest of a fixed number of pivots.
2. Summaries per cell (the largest distance of its queries; the few smallest distances
   of its data, one per id) bound how far the k-th neighbour of any of its queries can be.
3. A vector is sent to those blocks of queries only whose bound it can meet: its
   distance to its own pivot must be at least that between the pivots, less the
   block's radius and bound.
4. Blocks are solved where they meet, against slices of the data of bounded size, and
   the slices' best are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only
from roadpulse.storage import materialise

K = 5
SCALE = 256
QUERY_EVERY = 50
PIVOTS = 48
# Queries of a block, and vectors of a slice it is solved against at a time.
BLOCK_QUERIES, SLICE_ROWS, CHUNK = 1000, 600, 4096
# Room for rounding in the bounds; they must never be too sharp.
SLACK = 1e-6


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec``: components as ``floor(SCALE * x)``, without vectors that are null or not all finite."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = only(vectors, vec_id=vectors["vec_id"].cast("bigint"), embedding="embedding")
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        "vec_id", whole.alias("vec")
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of one length; shorter vectors end in zeros."""
    out = np.zeros((len(column), dim))
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _nearest(points: np.ndarray, last: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    whole = np.column_stack([points, last])
    squares = (whole**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * whole @ pivots.T
    cell = squares.argmin(1)
    return cell, np.sqrt(((whole - pivots[cell]) ** 2).sum(1))


def _cells(dim: int, norm2: float, pivots: np.ndarray, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("vec"), dim)
            last = np.sqrt(np.maximum(norm2 - (points**2).sum(1), 0))
            cell, distance = _nearest(points, last, pivots)
            asks = batch.column("vec_id").to_numpy() % every == 0
            query_cell, query_distance = _nearest(points, np.zeros(len(points)), pivots)
            columns = [
                batch.column("vec_id"), batch.column("vec"), pa.array(cell.astype(np.int32)), pa.array(distance),
                pa.array(np.where(asks, query_cell, -1).astype(np.int32)), pa.array(query_distance),
            ]
            names = ["vec_id", "vec", "cell", "distance", "query_cell", "query_distance"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _smallest(n: int):
    """The ``n`` smallest distances of each cell of a task, of distinct ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, pd.DataFrame] = {}
        for batch in batches:
            rows = batch.to_pandas().sort_values(["distance", "vec_id"]).drop_duplicates(["cell", "vec_id"])
            for cell, some in rows.groupby("cell").head(n).groupby("cell"):
                both = pd.concat([kept[cell], some]) if cell in kept else some
                kept[cell] = both.sort_values(["distance", "vec_id"]).drop_duplicates("vec_id").head(n)
        for some in kept.values():
            yield pa.RecordBatch.from_pandas(some[["cell", "vec_id", "distance"]], preserve_index=False)

    return run


def bounds(
    pivots: np.ndarray,
    radius: dict[int, float],
    near: list[tuple[int, float]],
    needed: int,
    ids: list[int] | None = None,
) -> dict[int, np.ndarray]:
    """Per cell of queries the least distance to its pivot that data of each cell must have.

    ``radius`` is of the queries' cells; ``near`` has the smallest distances of data
    to their pivot, of which ``needed`` of distinct ``ids`` (without them, each is of
    its own) give the bound. Too few data bound nothing.
    """
    between = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2))
    ids = list(range(len(near))) if ids is None else ids
    out = {}
    for cell, r in radius.items():
        nearest: dict[int, float] = {}
        for (c, d), who in zip(near, ids, strict=True):
            nearest[who] = min(nearest.get(who, np.inf), r + between[cell, c] + d)
        reach = sorted(nearest.values())
        farthest = reach[needed - 1] if len(reach) >= needed else np.inf
        out[cell] = between[cell] - r - farthest - SLACK * (1 + between[cell] + r)
    return out


def _send(limits: np.ndarray, n_slices: int):
    """Each vector once per block whose limit its distance meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meets = batch.column("distance").to_numpy()[:, None] >= limits[:, batch.column("cell").to_numpy()].T
            rows, block = np.nonzero(meets)
            some = batch.take(pa.array(rows))
            target = block * n_slices + some.column("slice").to_numpy()
            columns = [pa.array(target), some.column("vec_id"), some.column("vec"), pa.array(np.zeros(len(rows), bool))]
            yield pa.RecordBatch.from_arrays(columns, names=["target", "vec_id", "vec", "asks"])

    return run


def _solve(dim: int, k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        asks = group["asks"].to_numpy(bool)
        ids = group["vec_id"].to_numpy(np.int64)
        points = np.zeros((len(group), dim))
        for row, vec in enumerate(group["vec"]):
            points[row, : len(vec)] = vec
        query_ids, queries = ids[asks], points[asks]
        data_ids, data = ids[~asks], points[~asks]
        rows, found, scores = [], [], []
        for first in range(0, len(data_ids) if len(query_ids) else 0, CHUNK):
            part_ids = data_ids[first : first + CHUNK]
            score = queries @ data[first : first + CHUNK].T
            score[query_ids[:, None] == part_ids[None, :]] = -np.inf
            least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
            row, at = np.nonzero((score >= least[:, None]) & (score > -np.inf))
            rows.append(row), found.append(part_ids[at]), scores.append(score[row, at])
        if not rows:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        # The best of an id, over all of its rows.
        query_id, vec_id, value = query_ids[np.concatenate(rows)], np.concatenate(found), np.concatenate(scores)
        order = np.lexsort((vec_id, -value, query_id))
        query_id, vec_id, value = query_id[order], vec_id[order], value[order]
        begin = np.flatnonzero(np.r_[True, query_id[1:] != query_id[:-1]])
        rank = np.arange(len(query_id)) - np.repeat(begin, np.diff(np.r_[begin, len(query_id)]))
        best = rank < k
        return pd.DataFrame({"query_id": query_id[best], "vec_id": vec_id[best], "score": value[best].astype(np.int64)})

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query.

    Queries are the rows of ``vectors`` (``vec_id``, ``embedding``) whose id is divisible
    by ``every``; candidates are all rows with another id. Scores are whole numbers, exact
    below 2**53; ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component, and rows without id, take no part; shorter vectors count as
    ending in zeros. Rows that repeat an id are all candidates, and a query that repeats
    is answered with the best of the pairs of all its rows, as in the SQL, where a
    candidate may come once per row of the query. An empty table, or one without queries,
    gives an empty result; other columns are not looked at.

    The pivots (``PIVOTS`` vectors), ``k + 1`` numbers per cell and two per pair of cell
    and block reach the driver; no task holds more than a block and a slice. Rows are
    dealt by their number, not their id; of equal rows of a query, ``k`` are solved, as
    more cannot change the best.
    """
    spark = vectors.sparkSession
    for_python(spark, rows=2000)
    rows = quantised(vectors)
    norm = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    whole = rows.agg(F.count("*").alias("n"), F.max(norm).alias("norm2"), F.max(F.size("vec")).alias("dim")).first()
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not whole["n"] or not whole["dim"]:
        return spark.createDataFrame([], result)
    n, dim, norm2 = whole["n"], whole["dim"], whole["norm2"]
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    points = np.zeros((len(drawn), dim))
    for i, r in enumerate(drawn):
        points[i, : len(r["vec"])] = r["vec"]
    pivots = np.column_stack([points, np.sqrt(np.maximum(norm2 - (points**2).sum(1), 0))])

    schema = "vec_id bigint, vec array<double>, cell int, distance double, query_cell int, query_distance double"
    placed = rows.mapInArrow(_cells(dim, norm2, pivots, every), schema)
    placed = materialise(placed.withColumn("row", F.monotonically_increasing_id()), "knn-cells")
    place = F.min(F.struct("query_cell", "query_distance")).alias("p")
    queries = placed.filter("query_cell >= 0").groupBy("vec_id", "vec").agg(place, F.count("*").alias("n"))
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy")
    queries = queries.select("vec_id", "vec", "p.query_cell", "p.query_distance", copies)
    asked = queries.groupBy("query_cell").agg(F.max("query_distance").alias("r"), F.count("*").alias("n")).collect()
    if not asked:
        return spark.createDataFrame([], result)
    near = placed.select("cell", "vec_id", "distance").mapInArrow(
        _smallest(k + 1), "cell int, vec_id bigint, distance double"
    )
    near = near.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))
    near = near.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("d"))
    near = near.select("cell", F.explode(F.slice("d", 1, k + 1)).alias("d")).select("cell", "d.*").collect()
    # One of the nearest ids may be the query's own.
    limit = bounds(
        pivots,
        {r["query_cell"]: r["r"] for r in asked},
        [(r["cell"], r["distance"]) for r in near],
        k + 1,
        [r["vec_id"] for r in near],
    )

    # Blocks: small cells together, large ones in several.
    limits, first, pieces, open_size = [], {}, {}, BLOCK_QUERIES
    for r in sorted(asked, key=lambda r: r["query_cell"]):
        cell, size = r["query_cell"], r["n"]
        if open_size + size <= BLOCK_QUERIES:
            limits[-1] = np.minimum(limits[-1], limit[cell])
            open_size += size
            first[cell], pieces[cell] = len(limits) - 1, 1
        else:
            pieces[cell] = -(-size // BLOCK_QUERIES)
            first[cell] = len(limits)
            limits += [limit[cell]] * pieces[cell]
            open_size = size if pieces[cell] == 1 else BLOCK_QUERIES
    n_slices = -(-n // SLICE_ROWS)

    def of_cell(values: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("query_cell"))

    block = of_cell(first) + F.pmod(F.xxhash64("vec_id", "vec", "copy", F.lit("block")), of_cell(pieces))
    in_slices = F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)))
    target = (F.col("block") * n_slices + F.col("slice")).cast("bigint")
    asking = queries.select("vec_id", "vec", block.alias("block"), in_slices.alias("slice"))
    asking = asking.select(target.alias("target"), "vec_id", "vec", F.lit(True).alias("asks"))
    sliced = placed.withColumn("slice", F.pmod(F.xxhash64("row", F.lit("slice")), F.lit(n_slices)).cast("int"))
    sent = sliced.select("vec_id", "vec", "cell", "distance", "slice").mapInArrow(
        _send(np.array(limits), n_slices), "target bigint, vec_id bigint, vec array<double>, asks boolean"
    )
    solved = asking.unionByName(sent).groupBy("target").applyInPandas(
        _solve(dim, k), "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
