"""Token ids of documents in compressed binary files.

A token file is written by one task, in ascending ``doc_id`` order over all files.
It is a Parquet file of segments: whole documents with about ``SEGMENT_IDS`` ids,
their ids as one message of the range coder (see ``rans``), whose frequency table
the segment's blocks share. So any segment, and any block in it, decodes alone, and
Spark's own readers and writers place the files in any store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import rans
from roadpulse.llm.frames import for_python, only, width
from roadpulse.llm.worker_memory import Memo

END_ID = 2
SEGMENT_IDS = 1 << 19
# Bytes of words and their ids that a Python worker remembers, and the longest such word.
# An executor may have more workers than cores: one that has just ended a task still lives.
REMEMBERED_BYTES, REMEMBERED_CHARS = 128 << 20, 40
# Bytes of texts that are encoded together, a batch more at most.
TOGETHER_BYTES = 4 << 20
# Words encoded in one run; the library works faster on short texts.
RUN_WORDS = 200
SEGMENT = """file int, segment int, start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<int>,
    table binary, states binary, offsets array<bigint>, words binary, checksums array<bigint>"""
_SCHEMA = pa.schema([
    ("file", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("table", pa.binary()),
    ("states", pa.binary()), ("offsets", pa.list_(pa.int64())), ("words", pa.binary()),
    ("checksums", pa.list_(pa.int64())),
])


class Encoder:
    """Byte-level BPE of the tokenizers library, which sees each word once.

    The vocabulary's pattern always starts a new piece at a single space between two
    other characters, so the words between such spaces are encoded on their own.
    """

    def __init__(self, vocabulary: str) -> None:
        import os
        import re

        # Spark runs a task per core; threads of the library would only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.white_run = re.compile(r"\s\s")
        self.single_space = re.compile(r"(?<=\S) (?=\S)")
        self.known = Memo(REMEMBERED_BYTES)
        # Tokens that begin with a space, which byte-level vocabularies write as U+0120.
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("\u0120")

    def _split(self, texts: list[str]) -> tuple[list[int], pa.Array, np.ndarray]:
        """The texts in another order, the words of all of them, and how many each has, one at least."""
        runs = [i for i, t in enumerate(texts) if self.white_run.search(t)]
        apart = set(runs)
        others = [i for i in range(len(texts)) if i not in apart]
        lists = pc.split_pattern(pa.array([texts[i] for i in others], pa.large_string()), " ")
        counts = [pc.list_value_length(lists).to_numpy(zero_copy_only=False)]
        words = [lists.flatten()]
        for i in runs:
            found = self.single_space.split(texts[i])
            counts.append(np.array([len(found)]))
            words.append(pa.array(found, pa.large_string()))
        return others + runs, pa.concat_arrays(words), np.concatenate(counts).astype(np.int64)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space.

        Words without white space at their ends or spaces within are encoded in runs,
        each word after a space: just the tokens that start a word begin with one.
        """
        plain = [w for w in words if w and not (w[0].isspace() or w[-1].isspace() or " " in w)]
        spaced = [" " + w for w in plain]
        runs = ["".join(spaced[i : i + RUN_WORDS]) for i in range(0, len(spaced), RUN_WORDS)]
        joined = [x for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False) for x in e.ids]
        ids = np.array(joined, "<u4")
        starts = np.flatnonzero(self.spaced[ids]) if len(ids) else []
        if len(starts) != len(plain):
            plain, starts = [], []
        edges = [*[4 * int(x) for x in starts], 4 * len(ids)]
        raw = ids.tobytes()
        found = {w: raw[a:b] for w, a, b in zip(plain, edges, edges[1:], strict=False)}
        others = [w for w in words if w not in found]
        rest = self.tokenizer.encode_batch_fast([" " + w for w in others], add_special_tokens=False)
        found |= {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(others, rest, strict=True)}
        return [found[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers. All words but a text's first follow a space.

        Each distinct word of the texts is looked up once in what the worker remembers;
        its occurrences take its ids from the table of the words of these texts.
        """
        if not texts:
            return []
        order, words, counts = self._split(texts)
        begin = np.cumsum(counts) - counts
        firsts = self.tokenizer.encode_batch_fast(words.take(pa.array(begin)).to_pylist(), add_special_tokens=False)
        later = np.ones(len(words), bool)
        later[begin] = False
        coded = words.filter(pa.array(later)).dictionary_encode()
        distinct, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        here = list(map(self.known.get, distinct))
        missing = [i for i, ids in enumerate(here) if ids is None]
        for i, ids in zip(missing, self._words([distinct[i] for i in missing]), strict=True):
            here[i] = ids
            if len(distinct[i]) <= REMEMBERED_CHARS:
                self.known.learn(distinct[i], ids)
        sizes = np.fromiter(map(len, here), np.int64, len(here)) // 4
        places = np.cumsum(sizes) - sizes
        sizes = sizes[codes]
        ends = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(places[codes] - ends[:-1], sizes)
        at += np.arange(len(at))
        raw = np.frombuffer(b"".join(here), "<u4")[at].tobytes()
        edges = (4 * ends[np.r_[0, np.cumsum(counts - 1)]]).tolist()
        out = [b""] * len(texts)
        for i, first, lo, hi in zip(order, firsts, edges, edges[1:], strict=False):
            out[i] = np.array(first.ids, "<u4").tobytes() + raw[lo:hi]
        return out


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``batches`` in fewer, larger tables, bounded in bytes."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size >= TOGETHER_BYTES:
            yield pa.Table.from_batches(some)
            some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def _segments(vocabulary, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        file, start, number = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, parts, size = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            m = rans.encode(ids)
            row = {
                "file": file, "segment": number, "start": start, "n_ids": len(ids), "doc_ids": doc_ids,
                "lengths": [len(p) // 4 for p in parts], "table": m.table, "states": m.states.tobytes(),
                "offsets": m.offsets.tolist(), "words": m.words.tobytes(), "checksums": m.checksums.tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in _together(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SEGMENT_IDS:
                    yield segment()
                    start, number = start + size, number + 1
                    doc_ids, parts, size = [], [], 0
        if parts:
            yield segment()

    return run


def write_token_files(
    documents: DataFrame, path: str, vocabulary_file: str | None = None, end_id: int = END_ID
) -> None:
    """Encode every whole text of ``documents`` (``doc_id``, ``text``) and write the files to ``path``.

    Each document's ids end with ``end_id``; a null or empty text has only that one.
    Files and documents in them are in ascending ``doc_id`` order, null first, and
    equal ids in the order of their texts. An empty table writes no segment. Other
    columns are not looked at. The driver reads ``vocabulary_file``, a file of the
    tokenizers library with a byte-level pattern.

    The texts are shuffled once, by ranges of ``doc_id``. A task holds one segment:
    ``SEGMENT_IDS`` ids and one document more at most.
    """
    spark = documents.sparkSession
    for_python(spark)
    with open(vocabulary_file or default_vocabulary(), encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    rows = only(documents, doc_id=documents["doc_id"].cast("bigint"), text="text")
    ordered = rows.repartitionByRange(width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_segments(vocabulary, end_id), SEGMENT).write.parquet(path)


def _message(row: dict) -> rans.Message:
    return rans.Message(
        row["n_ids"],
        row["table"],
        np.frombuffer(row["states"], "<u8").reshape(-1, rans.LANES),
        np.array(row["offsets"], np.int64),
        np.frombuffer(row["words"], "<u4"),
        np.array(row["checksums"], np.int64),
    )


def _documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode(_message(row)).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), row["lengths"], strict=True)]
                columns = [
                    pa.array([row["file"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + ends - lengths),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ]
                names = ["file", "doc_id", "start_in_file", "n_tokens", "ids_crc32"]
                if with_ids:
                    bounds = pa.array(np.r_[0, ends].astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files at ``path``.

    Everything is decoded and held against the checksums. ``start`` counts the ids of
    all documents before; it joins one total per file. ``ids_crc32`` is of the ids as
    little-endian 32-bit numbers; ``with_ids`` adds the ``ids`` themselves.
    """
    for_python(spark, rows=8)
    segments = spark.read.schema(SEGMENT).parquet(path)
    sizes = segments.groupBy("file").agg(F.sum("n_ids").alias("n"))
    starts = sizes.select(
        "file",
        F.expr("sum(n) over (order by file rows between unbounded preceding and current row) - n").alias("before"),
    )
    schema = "file int, doc_id bigint, start_in_file bigint, n_tokens bigint, ids_crc32 bigint"
    found = segments.mapInArrow(_documents(with_ids), schema + ", ids array<int>" * with_ids)
    joined = found.join(F.broadcast(starts), "file").withColumn("start", F.col("before") + F.col("start_in_file"))
    return joined.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
