"""Language identification by prediction with partial matching.

Each language has a context tree: for every context of up to ``ORDER`` bytes, how
often each next byte followed it. A byte that followed the longest context costs
``log2((n + d) / c)`` bits (``c`` of ``n`` times, ``d`` different bytes); one that did
not costs the escape, ``log2((n + d) / d)``, and is looked up after the context one
byte shorter, down to 8 bits without any. A context never seen costs nothing to
leave. The counts are frozen after training, so a text's code length under a
language is a sum over its bytes, and the language with the shortest code wins.

The trees are compiled into tables: the full cost under every language of each
sequence of ``ORDER + 1`` bytes that any tree holds, and what the rest pay to fall
back by one order. Texts are scored whole, a million bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.frames import only, for_python

ORDER = 3
# The bound of the training sample: about so many documents per language, none longer
# than so many characters. Trees, tables and what is broadcast are bounded by it.
TRAINING_DOCUMENTS, TRAINING_CHARS = 800, 20_000
FOLDS, HELD_OUT_FOLD = 3, 1
UNKNOWN = "und"
# A text whose best language needs more bits a byte is in none of the languages;
# without any model a byte takes 8.
MAX_BITS_PER_BYTE = 6.0
_SLICE = 1 << 20
_PAD = b"\n" * ORDER


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


class Slots:
    """A fixed hash table from 32-bit keys to row numbers, probed for many keys at once."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(2 * max(len(keys), 1)).bit_length())
        self.shift = np.uint32(32 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.rows = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros(1 << bits, np.uint32)
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            free = self.rows[at] < 0
            _, first = np.unique(at, return_index=True)
            won = np.zeros(len(todo), bool)
            won[first] = True
            won &= free
            self.rows[at[won]], self.keys[at[won]] = todo[won], keys[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        at = self._home(keys)
        out = self.rows[at]
        unsure = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        at = at[unsure]
        while len(unsure):
            at = (at + 1) & self.mask
            rows = self.rows[at]
            out[unsure] = rows
            go_on = (rows >= 0) & (self.keys[at] != keys[unsure])
            unsure, at = unsure[go_on], at[go_on]
        return out


@dataclass
class Model:
    """Costs in bits. By order: sequences of ``k + 1`` bytes, and escapes after ``k`` bytes."""

    languages: list[str]
    slots: list[Slots]
    costs: list[np.ndarray]
    escape_slots: list[Slots]
    escapes: list[np.ndarray]

    def bits(self, data: np.ndarray, first: int, last: int) -> np.ndarray:
        """Cost of each byte from ``first`` to ``last`` under each language, after the bytes before."""
        window = data[first - ORDER : last].astype(np.uint32)
        key = window[ORDER:].copy()
        for k in range(1, ORDER + 1):
            key |= window[ORDER - k : len(window) - k] << np.uint32(8 * k)
        out = np.zeros((len(key), len(self.languages)), np.float32)
        left = np.arange(len(key))
        for order in range(ORDER, -1, -1):
            # The key's low bytes: the byte itself, then its context, nearest first.
            now = key if order == 3 else key & np.uint32((1 << 8 * (order + 1)) - 1)
            row = self.slots[order].find(now)
            hit = row >= 0
            out[left[hit]] += self.costs[order][row[hit]]
            left, key, now = left[~hit], key[~hit], now[~hit]
            if not len(left):
                return out
            context = self.escape_slots[order].find(now >> np.uint32(8))
            seen = context >= 0
            out[left[seen]] += self.escapes[order][context[seen]]
        out[left] += 8.0
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        data = np.frombuffer(b"".join(_PAD + t for t in texts), np.uint8)
        ends = np.cumsum([ORDER + len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        for first in range(ORDER, len(data), _SLICE):
            last = min(first + _SLICE, len(data))
            cost = self.bits(data, first, last)
            some = np.flatnonzero((starts < last) & (ends > first) & (ends > starts))
            edges = np.empty(2 * len(some), np.int64)
            edges[0::2] = np.maximum(starts[some], first) - first
            edges[1::2] = np.minimum(ends[some], last) - first
            if len(edges) and edges[-1] == len(cost):
                edges = edges[:-1]
            if len(edges):
                total[some] += np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[0::2]
        return total


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte sequences of each language in the sample, with their number."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang in np.unique(langs.astype(str)):
            data = np.frombuffer(b"".join(_PAD + t for t, one in zip(texts, langs, strict=True) if one == lang), np.uint8)
            inside = np.concatenate([
                np.r_[np.zeros(ORDER, bool), np.ones(len(t), bool)]
                for t, one in zip(texts, langs, strict=True) if one == lang
            ])
            at = np.flatnonzero(inside)
            key = np.zeros(len(at), np.int64)
            for k in range(ORDER + 1):
                key |= data[at - k].astype(np.int64) << (8 * k)
            keys, number = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(number)],
                names=["lang", "seq", "number"],
            )


def compile_trees(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The tables of the languages' counts: per language sequences of ``ORDER + 1`` bytes and their numbers."""
    languages = sorted(counts)
    union = [
        np.unique(np.concatenate([np.zeros(0, np.int64)] + [k & ((1 << 8 * (o + 1)) - 1) for k, _ in counts.values()]))
        for o in range(ORDER + 1)
    ]
    contexts = [np.unique(u >> 8) for u in union]
    costs = [np.zeros((len(u), len(languages)), np.float32) for u in union]
    escapes = [np.zeros((len(c), len(languages)), np.float32) for c in contexts]
    for j, language in enumerate(languages):
        full, number = counts[language]
        for order in range(ORDER + 1):
            seq, at = np.unique(full & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            c = np.bincount(at, number, len(seq))
            context, of = np.unique(seq >> 8, return_inverse=True)
            n, d = np.bincount(of, c, len(context)), np.bincount(of, minlength=len(context))
            escapes[order][np.searchsorted(contexts[order], context), j] = np.log2((n + d) / d)
            # What it costs to leave this order, and the byte at the orders below.
            up = escapes[order][np.searchsorted(contexts[order], union[order] >> 8), j].astype(np.float64)
            if order:
                below = costs[order - 1][
                    np.searchsorted(union[order - 1], union[order] & ((1 << 8 * order) - 1)), j
                ]
            else:
                below = 8.0
            cost = up + below
            cost[np.searchsorted(union[order], seq)] = np.log2((n + d)[of] / c)
            costs[order][:, j] = cost
    return Model(
        languages,
        [Slots(u.astype(np.uint32)) for u in union],
        costs,
        [Slots(c.astype(np.uint32)) for c in contexts],
        escapes,
    )


def train(documents: DataFrame) -> Model:
    """Context trees of the languages of ``documents`` (``doc_id, text, lang``).

    Rows without text or ``lang`` teach nothing. Of each language about
    ``TRAINING_DOCUMENTS`` are taken, at least one, by a hash of id and text, and of each
    ``TRAINING_CHARS`` characters at most, from a place by hash; Spark counts their byte sequences, and only the counts, bounded
    by the sample, reach the driver. No language gives a model without languages.
    """
    for_python(documents.sparkSession)
    rows = only(documents, doc_id="doc_id", text="text", lang="lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )

    def number(use: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(use)), 32) / F.lit(2.0**32)

    # Empty texts count only where a language has no others.
    draw = F.when(F.length("text") > 0, number("train")).otherwise(F.lit(1.0))
    drawn = rows.withColumn("draw", draw)
    sizes = drawn.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not sizes:
        return compile_trees({})
    shares = {r["lang"]: max(TRAINING_DOCUMENTS / r["n"], r["least"]) for r in sizes}
    share = F.element_at(
        F.create_map(*[x for lang, most in shares.items() for x in (F.lit(lang), F.lit(most))]), F.col("lang")
    )
    spare = F.greatest(F.length("text") - TRAINING_CHARS + 1, F.lit(1))
    first = (F.floor(number("place") * spare) + 1).cast("int")
    part = F.substring(F.col("text"), first, F.lit(TRAINING_CHARS))
    sample = drawn.filter(F.col("draw") <= share).select("lang", part.alias("text"))
    counted = sample.mapInArrow(_counts, "lang string, seq bigint, number bigint")
    found = counted.groupBy("lang", "seq").agg(F.sum("number").alias("number")).toPandas()
    return compile_trees({
        lang: (part["seq"].to_numpy(np.int64), part["number"].to_numpy(np.float64))
        for lang, part in found.groupby("lang")
    })


def identified(
    documents: DataFrame, learn_from: DataFrame | None, carry: Sequence[str] = (), model: Model | None = None
) -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte``, one row per row of ``documents``.

    Columns named in ``carry`` come along as ``in_0``, ``in_1`` and so on. A ``model`` may
    be given instead of what to learn from.

    ``lang_pred`` is a language of ``learn_from`` (see ``train``), of which the text is
    most likely; ``score`` is its probability if all languages are equally likely
    beforehand. Null, empty and letterless texts are ``und`` with score 0, as is
    everything if nothing was learned. Equal code lengths go to the language first
    in order. Ids may be null or repeat; columns other than ``doc_id`` and ``text``
    are not looked at.
    """
    spark = documents.sparkSession
    for_python(spark)
    shared = spark.sparkContext.broadcast(model or train(learn_from))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            named = np.array(batch.column("has_letter").to_pylist(), bool)
            found, score, rate = [None] * len(texts), np.zeros(len(texts)), np.full(len(texts), 8.0)
            if model.languages and len(texts):
                bits = model.code_lengths(texts)
                best = bits.argmin(1)
                least = bits[np.arange(len(best)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                rate = least / np.maximum([len(t) for t in texts], 1)
                found = [model.languages[i] if ok else None for i, ok in zip(best, named, strict=True)]
            columns = [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(score), pa.array(rate)]
            names = ["doc_id", "found", "score", "bits_per_byte", *extra]
            yield pa.RecordBatch.from_arrays([*columns, *map(batch.column, extra)], names=names)

    has_letter = F.coalesce(documents["text"].rlike(r"\p{L}"), F.lit(False))
    extra = {f"in_{i}": name for i, name in enumerate(carry)}
    rows = only(documents, doc_id="doc_id", text="text", has_letter=has_letter, **extra)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"doc_id {kinds['doc_id']}, found string, score double, bits_per_byte double"
    scored = rows.mapInArrow(run, ", ".join([schema, *[f"{c} {kinds[c]}" for c in extra]]))
    known = F.col("found").isNotNull()
    return scored.select(
        "doc_id",
        F.coalesce("found", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        "bits_per_byte",
        *extra,
    )


def labelled(documents: DataFrame, learn_from: DataFrame) -> DataFrame:
    """``documents`` in a learned language, with ``lang`` as identified; all columns kept.

    Rejected are texts that are null or have no letter, and those for which even the best
    language takes more than ``MAX_BITS_PER_BYTE``. If no language was learned, only the
    former are, and ``lang`` stays.
    """
    names = documents.columns
    model = train(learn_from)
    if not model.languages:
        return documents.filter(documents["text"].rlike(r"\p{L}"))
    found = identified(documents, None, carry=names, model=model)
    known = F.col("lang_pred") != UNKNOWN
    kept = found.filter(known & (F.col("bits_per_byte") <= MAX_BITS_PER_BYTE))
    return kept.select(
        *[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"in_{i}").alias(c) for i, c in enumerate(names)]
    )
