"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import folded, for_python
from roadpulse.storage import materialise

# Links that a task ties up among themselves at a time.
LOCAL_LINKS = 1 << 18


def forest(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect the same nodes: each node with the smallest it reaches, itself left out."""
    nodes, at = np.unique(np.concatenate([high, low]), return_inverse=True)
    a, b = at[: len(high)], at[len(high) :]
    root = np.arange(len(nodes))
    while True:
        # Hang the larger of two roots on the smaller, then let every node point at its root.
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, tied up among themselves some ``LOCAL_LINKS`` at a time."""
    some, size = [], 0

    def tied() -> pa.RecordBatch:
        high, low = (np.concatenate([b.column(k).to_numpy() for b in some]) for k in ("high", "low"))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(high, low)], names=["high", "low"])

    for batch in batches:
        some.append(batch)
        size += batch.num_rows
        if size >= LOCAL_LINKS:
            yield tied()
            some, size = [], 0
    if some:
        yield tied()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component``: for each linked node the smallest node it reaches, if that is another.

    Every task first ties up the links it reads among themselves. Then large and small
    stars alternate: every node's larger neighbours are tied to its smallest neighbour,
    then its smaller ones are, until each node hangs on the smallest of its component:
    no node has a larger and a smaller neighbour, or two smaller ones. The number of
    rounds grows as the logarithm of the nodes. Minima combine before the shuffle, and
    a node with very many links is split by the join, as both sides are plain tables.
    Each round is written to the shared folder, so a lost executor repeats no earlier
    round.

    Nulls and links of a node to itself say nothing; repeated links count once.
    """
    for_python(links.sparkSession)
    a, b = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    links = links.filter(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    links = materialise(links.mapInArrow(_local, "high bigint, low bigint"), "links")
    rows = 2 * links.count()
    while True:
        both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            links.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        # A link may come from several tasks, so smaller neighbours differ if the least and the largest do.
        below = F.when(F.col("other") < F.col("node"), F.col("other"))
        smallest = both.groupBy("node").agg(
            F.min("other").alias("least"), F.max("other").alias("most"), F.max(below).alias("last")
        )
        smallest = smallest.select(
            "node", F.least("node", "least").alias("least"),
            (F.col("last").isNotNull() & ((F.col("most") > F.col("node")) | (F.col("last") != F.col("least")))).alias("open"),
        )
        smallest = materialise(folded(smallest, rows), "large-star")
        if smallest.filter("open").isEmpty():
            return smallest.filter("least < node").select("node", F.col("least").alias("component"))
        large = both.filter("other > node").join(smallest.select("node", "least"), "node")
        large = large.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()
        large = materialise(folded(large, rows), "large-links")
        # A node has few smaller neighbours now, so this join has no hot key.
        root = large.groupBy("high").agg(F.min("low").alias("least"))
        tied = large.join(root, "high").filter("low != least").select(
            F.col("low").alias("high"), F.col("least").alias("low")
        )
        links = tied.union(root.select("high", F.col("least").alias("low"))).distinct()
        links = materialise(folded(links, rows), "links")
