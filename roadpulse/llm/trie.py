"""Prefix trie of conversations as a burst trie.

1. A turn's id is 128 bits of the SHA-256 of its role and text, so a conversation's path
   is the concatenation of its ids, and the order of paths is that of their bytes. Texts
   go no further than this.
2. Equal paths become one class with a count. The hash of the ids that end there is
   taken over sorted blocks of ids, streamed, so a class of any size fits.
3. All classes start in one container under the root. A container with more than
   ``CONTAINER_TURNS`` turns bursts: its paths are followed to where they first part, and
   each next turn id becomes the head of a container of its own. All containers that are
   too large burst in one round, so rounds follow the depth of branching, not the data.
4. Each remaining container is sorted and swept into nodes in one pass. A sweep holds the
   nodes between the head and the current path, with the finished children of each,
   which wait for their parent's smallest member.
5. The nodes that burst sum up what their containers found, deepest round first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only
from roadpulse.storage import materialise

ID_BYTES = 16
# Turns of distinct paths that a container may hold before it bursts: 256 kB of ids.
CONTAINER_TURNS = 1 << 14
# Containers that are still too large after so many rounds are swept as they are: a sweep
# streams, so this bounds how finely work is split, not what comes out.
ROUNDS = 32
# Conversation ids per block of a class: at most 2 ** BLOCK_BITS, as ids are distinct.
_BLOCK_BITS = 16
EVERY, MOST = 100, 5
_NOTHING = hashlib.sha256(b"").hexdigest()
_CLASS = "path binary, chars array<int>, n bigint, conv_id bigint, ends_sha256 string"
NODE = """conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,
    n_leaves bigint, saved_tokens bigint, ends_sha256 string"""
_NODE_NAMES = [part.split()[0] for part in NODE.split(",")]
_FLUSH = 1 << 13


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` (in order: turn, id, code points); null ids take no part.

    Turns are in ascending ``turn``, null first, equal ones by their id; repeated rows are
    repeated turns. A null role or text is empty. A conversation is one row of
    40 bytes a turn, so its length is bounded by memory (some 10 million turns).
    """
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = only(
        conversations.where(conversations["conv_id"].isNotNull()),
        conv_id=conversations["conv_id"].cast("bigint"),
        turn="turn",
        id=F.substring(F.sha2(whole, 256), 1, 2 * ID_BYTES),
        chars=F.length(text),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("turns"))


def kept_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its hundred: 0 to ``MOST``."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (MOST + 1)).cast("int")


def with_shared_openings(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the opening of the conversation that starts its hundred, then its own turns after that.

    At most ``2 * EVERY - 1`` conversations share one opening, so the join is even.
    """
    hundred = F.col("conv_id") - F.col("conv_id") % EVERY
    openings = turns.where(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("_hundred"), F.slice("turns", 1, MOST).alias("_opening")
    )
    h = F.col("_h")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    joined = turns.withColumns({"_hundred": hundred, "_h": kept_turns(F.col("conv_id"))}).join(openings, "_hundred", "left")
    opened = F.when(F.col("_opening").isNull(), own).otherwise(F.concat(F.slice("_opening", F.lit(1), h), own))
    return joined.select("conv_id", opened.alias("turns"))


def _sealed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of classes, sorted by path and block, as one row per class."""
    now, state, total, least = None, None, 0, None
    names = ["path", "chars", "n", "conv_id", "ends_sha256"]

    def batch(rows: list) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for part in batches:
        done = []
        for path, chars, n, conv_id, ids in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if now is not None and now[0] == path:
                state.update(b",")
            else:
                if now is not None:
                    done.append((*now, total, least, state.hexdigest()))
                now, state, total, least = (path, chars), hashlib.sha256(), 0, conv_id
            state.update(ids.encode())
            total, least = total + n, min(least, conv_id)
        if done:
            yield batch(done)
    if now is not None:
        yield batch([(*now, total, least, state.hexdigest())])


def _classes(paths: DataFrame) -> DataFrame:
    """One row per distinct path: ``path, chars, n, conv_id`` (smallest), ``ends_sha256``."""
    blocks = paths.groupBy("path", "chars", F.shiftright("conv_id", _BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    rows = blocks.select(
        "path",
        "chars",
        F.size("ids").cast("bigint").alias("n"),
        F.col("ids")[0].alias("conv_id"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        "block",
    )
    ordered = rows.repartition("path").sortWithinPartitions("path", "block").drop("block")
    return materialise(ordered.mapInArrow(_sealed, _CLASS), "trie-classes")


def _parting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``meet``: the depth to which the first and last path of a container, so all of them, agree."""
    for batch in batches:
        pairs = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True)
        meet = pa.array([len(commonprefix([a, b])) // ID_BYTES for a, b in pairs], pa.int32())
        kept = [n for n in batch.schema.names if n not in ("low", "high")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), meet], names=[*kept, "meet"])


def _head(depth: Column) -> Column:
    return F.substring(F.col("path"), F.lit(1), depth * ID_BYTES)


def _burst(classes: DataFrame, limit: int, rounds: int) -> tuple[DataFrame, list[DataFrame]]:
    """Classes with the ``top`` depth of their container, and per round the nodes that burst.

    ``parent`` is the smallest member of the container's parent.
    """
    opened = classes.withColumns({"top": F.lit(0), "parent": F.lit(None).cast("bigint")})
    closed, burst = [], []
    for _ in range(rounds):
        headed = opened.withColumn("head", _head(F.col("top")))
        turns = F.sum(F.length("path") / ID_BYTES)
        sizes = headed.groupBy("head").agg(turns.alias("turns"), F.count("*").alias("paths"))
        large = materialise(sizes.where((F.col("turns") > limit) & (F.col("paths") > 1)).select("head"), "trie-large")
        if large.isEmpty():
            break
        closed.append(headed.join(large, "head", "left_anti").drop("head"))
        inside = headed.join(large, "head")
        stats = inside.groupBy("head", "top").agg(
            F.min("path").alias("low"),
            F.max("path").alias("high"),
            F.sum("n").alias("n"),
            F.min("conv_id").alias("conv_id"),
            F.min("parent").alias("parent"),
        )
        schema = "head binary, top int, n bigint, conv_id bigint, parent bigint, meet int"
        parted = materialise(stats.mapInArrow(_parting, schema), "trie-burst")
        moved = inside.select("head", "path", "chars", F.col("n").alias("of"), F.col("conv_id").alias("least"), "ends_sha256")
        moved = moved.join(parted, "head").withColumn("ends", F.length("path") == F.col("meet") * ID_BYTES)
        # What a burst node itself needs of its paths: the sizes of the turns it shares, and who ends there.
        shared = moved.groupBy("head", "top", "n", "conv_id", "parent", "meet").agg(
            F.min(F.slice("chars", F.lit(1), F.col("meet"))).alias("chars"),
            F.max(F.when(F.col("ends"), F.col("ends_sha256"))).alias("ends_sha256"),
        )
        burst.append(materialise(shared.drop("head"), "trie-shared"))
        opened = materialise(
            moved.where(~F.col("ends")).select(
                "path",
                "chars",
                F.col("of").alias("n"),
                F.col("least").alias("conv_id"),
                "ends_sha256",
                (F.col("meet") + 1).alias("top"),
                F.col("conv_id").alias("parent"),
            ),
            "trie-open",
        )
    return reduce(DataFrame.unionByName, [*closed, opened]), burst


class _Node:
    __slots__ = ("n", "conv", "chars", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, chars: int) -> None:
        self.n, self.conv, self.chars, self.children, self.leaves, self.saved = 0, None, chars, 0, 0, 0
        self.ends, self.waiting = _NOTHING, []


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*_NODE_NAMES, "is_top"])


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, from their classes in the order of paths."""
    stack: list[_Node] = []  # the nodes of the current path, from its container's top
    out: list[tuple] = []
    before, top, above = None, 0, None

    def close(to: int) -> None:
        """Finish the nodes deeper than ``to``."""
        while stack and top + len(stack) - 1 > to:
            node, depth = stack.pop(), top + len(stack)
            out.extend((*child[:2], node.conv, *child[2:]) for child in node.waiting)
            leaves = node.leaves or 1
            saved = node.saved + (node.n - 1) * node.chars
            row = (node.conv, depth, node.n, node.children, leaves, saved, node.ends)
            if not stack:
                out.append((*row[:2], above, *row[2:], True))
                return
            parent = stack[-1]
            parent.n += node.n
            parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
            parent.children += 1
            parent.leaves += leaves
            parent.saved += saved
            parent.waiting.append((*row, False))

    for batch in batches:
        for path, chars, n, conv, ends, at, parent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            depth = len(path) // ID_BYTES
            if before is None or at != top or before[: at * ID_BYTES] != path[: at * ID_BYTES]:
                close(-1)
                top, above = at, parent
                stack.append(_Node(chars[at - 1] if at else 0))
            else:
                shared, most = top, min(len(before) // ID_BYTES, depth)
                while shared < most and before[shared * ID_BYTES : (shared + 1) * ID_BYTES] == path[shared * ID_BYTES : (shared + 1) * ID_BYTES]:
                    shared += 1
                close(shared)
            stack.extend(_Node(chars[k]) for k in range(top + len(stack) - 1, depth))
            node = stack[-1]
            node.n += n
            node.conv = conv if node.conv is None else min(node.conv, conv)
            node.ends, before = ends, path
            if len(out) >= _FLUSH:
                yield _nodes(out)
                out.clear()
    close(-1)
    if out:
        yield _nodes(out)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that burst: from a container's top down to where its paths part."""
    for batch in batches:
        for r in batch.to_pylist():
            sizes, saved, rows = [0, *(r["chars"] or [])], r["saved"], []
            for depth in range(r["meet"], r["top"] - 1, -1):
                saved += (r["n"] - 1) * sizes[depth]
                last, first = depth == r["meet"], depth == r["top"]
                ends = (r["ends_sha256"] if last else None) or _NOTHING
                parent = r["parent"] if first else r["conv_id"]
                rows.append((r["conv_id"], depth, parent, r["n"], r["children"] if last else 1, r["leaves"], saved, ends, first))
                if len(rows) >= _FLUSH:
                    yield _nodes(rows)
                    rows = []
            if rows:
                yield _nodes(rows)


def prefix_trie(turns: DataFrame, container_turns: int = CONTAINER_TURNS, rounds: int = ROUNDS) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id``, distinct, and its ``turns`` in order).

    ``conv_id`` is the smallest member, ``depth`` counts turns from the textless root,
    ``parent_conv_id`` is the parent's ``conv_id`` (root: null). ``saved_tokens`` sums over a
    node's subtree the code points that sharing saves. ``ends_sha256`` is of the members
    without further turns. A conversation without turns is a member of the root. Without
    conversations there is no node.
    """
    for_python(turns.sparkSession)
    paths = turns.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )
    contained, burst = _burst(_classes(paths), container_turns, rounds)
    columns = ["path", "chars", "n", "conv_id", "ends_sha256", "top", "parent"]
    ordered = contained.select(*columns).repartition(_head(F.col("top"))).sortWithinPartitions("path")
    schema = f"{NODE}, is_top boolean"
    found = [materialise(ordered.mapInArrow(_swept, schema), "trie-swept")]
    for nodes in reversed(burst):
        tops = reduce(DataFrame.unionByName, found).where("is_top and depth > 0")
        below = tops.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).cast("int").alias("meet")).agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        found.append(materialise(nodes.join(below, ["conv_id", "meet"]).mapInArrow(_chains, schema), "trie-chains"))
    return reduce(DataFrame.unionByName, found).drop("is_top")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all ``conversations``, rebuilt with the shared openings of their hundreds.

    Columns as in ``prefix_trie``. Rows without ``conv_id`` take no part; nulls, ties and
    repeated rows count as in ``turns_of``; other columns are not looked at.
    """
    return prefix_trie(with_shared_openings(turns_of(conversations)))
