"""SentencePiece encoding and decoding by an Aho-Corasick automaton and Viterbi.

One automaton holds all pieces. It reads a text once; at every character it
reports, over its output links, each piece that ends there, and the segmentation
of the text up to that place is relaxed with each. What counts as best is the
model's own rule:

* ``unigram``: the highest sum of piece scores; among equals the longer last piece.
* ``bpe``: scores are merge priorities, not weights, and their highest sum is not
  what such a model means ("the" would become "▁t", "he"). A piece is admitted after
  the best last piece before it only if merging the two pieces' characters by
  priority gives back just these two. Every prefix of a text has one segmentation
  whose neighbours all pass, and it is that of the merges, so the first piece that
  passes is the one.

A character without a piece becomes its UTF-8 bytes, as byte pieces; in a sum it
counts ten less than the lowest score, as the format says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.frames import for_python, only
from roadpulse.llm.worker_memory import PackedMemo, release

SPACE = "▁"
# What a Python worker remembers, in bytes: segmentations of short words, and which pairs
# of pieces may stand together.
REMEMBERED_BYTES, REMEMBERED_CHARS, REMEMBERED_PAIRS_BYTES = 24 << 20, 32, 24 << 20
# A pair takes its key and an entry of the dictionary; its two strings are shared by pieces.
_PAIR_BYTES = 120
# Batches after which a worker gives back what it has freed.
_RELEASE_BATCHES = 32


class Codec:
    """Encoder and decoder of one model file of kind ``bpe`` or ``unigram``."""

    def __init__(self, model: bytes, kind: str = "bpe") -> None:
        import sentencepiece

        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(reader.get_piece_size())
        self.surface = [b""] * len(ids)
        self.byte_ids = [reader.unk_id()] * 256
        self.strings = [""] * len(ids)
        self.scores: dict[str, float] = {}
        self.automaton = ahocorasick.Automaton()
        self.whole_words = True
        for i in ids:
            piece = reader.id_to_piece(i)
            if reader.is_byte(i):
                value = int(piece[3:5], 16)
                self.surface[i], self.byte_ids[value] = bytes([value]), i
            elif reader.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not (reader.is_control(i) or reader.is_unused(i)):
                self.scores[piece] = reader.get_score(i)
                self.strings[i] = piece
                self.surface[i] = piece.replace(SPACE, " ").encode()
                self.automaton.add_word(piece, (len(piece), self.scores[piece], i))
                self.whole_words &= SPACE not in piece.lstrip(SPACE)
        self.unknown_score = min(self.scores.values()) - 10
        self.automaton.make_automaton()
        self.segment = self._by_merges if kind == "bpe" else self._by_score
        self.known = PackedMemo(REMEMBERED_BYTES)
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text after merging neighbours, best score first, leftmost among equals."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stand_together(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            found = self.merged(left + right) == ([left, right] if left else [right])
            if len(self.pairs) * _PAIR_BYTES < REMEMBERED_PAIRS_BYTES:
                self.pairs[key] = found
        return found

    def _ids(self, text: str, size: list[int], piece: list[int]) -> list[int]:
        """Follow the last pieces back from the end; -1 is a character without a piece."""
        out, at = [], len(text)
        while at:
            if piece[at] < 0:
                out.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            else:
                out.append(piece[at])
            at -= size[at]
        return out[::-1]

    def _by_merges(self, text: str) -> list[int]:
        n, strings, together, pairs = len(text), self.strings, self._stand_together, self.pairs
        sizes, piece, last = [1] * (n + 1), [-1] * (n + 1), ["", *text]
        settled = 0
        for at, (size, _, i) in self.automaton.iter(text):
            end = at + 1
            if end == settled:
                continue
            key = (last[end - size], strings[i])
            if pairs.get(key) or (key not in pairs and together(*key)):
                sizes[end], piece[end], last[end], settled = size, i, strings[i], end
        return self._ids(text, sizes, piece)

    def _by_score(self, text: str) -> list[int]:
        n = len(text)
        best: list[float | None] = [0.0] + [None] * n
        sizes, piece, single = [1] * (n + 1), [-1] * (n + 1), [False] * (n + 1)
        done = 0  # places up to here have their best score

        def settle(to: int) -> None:
            # Where no piece is a single character, that character may be unknown.
            nonlocal done
            while done < to:
                done += 1
                if not single[done]:
                    score = best[done - 1] + self.unknown_score
                    if best[done] is None or score > best[done]:
                        best[done], sizes[done], piece[done] = score, 1, -1

        for at, (size, score, i) in self.automaton.iter(text):
            end = at + 1
            settle(at)
            total = best[end - size] + score
            single[end] |= size == 1
            now = best[end]
            if now is None or total > now or (total == now and size > sizes[end]):
                best[end], sizes[end], piece[end] = total, size, i
        settle(n)
        return self._ids(text, sizes, piece)

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it."""
        found = self.known.get(word)
        if found is None:
            found = self._chunk(SPACE + word)
            if len(word) < REMEMBERED_CHARS:
                self.known.learn(word, found)
        return found

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.segment(chunk), np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers.

        No piece of a model that splits by white space reaches over the start of a
        space, so the best segmentation is that of the words, each with the spaces
        before it; equal words of the texts are segmented once.
        """
        escaped = [text.replace(" ", SPACE) for text in texts]
        if not self.whole_words:
            return [np.array(self.segment(SPACE + t), np.int32).tobytes() if t else b"" for t in escaped]
        parts = [t.split(SPACE) if t else [] for t in escaped]
        here = {w: self._word(w) for w in set().union(*parts) if w}
        return [
            self._spaced(words, here) if "" in words else b"".join(map(here.__getitem__, words)) for words in parts
        ]

    def _spaced(self, words: list[str], here: dict[str, bytes]) -> bytes:
        """Ids of words with several spaces before some; the last may be empty after spaces."""
        out, spaces = [], SPACE
        for word in words[:-1]:
            if word:
                out.append(here[word] if spaces == SPACE else self._chunk(spaces + word))
                spaces = SPACE
            else:
                spaces += SPACE
        out.append(self._chunk(spaces + words[-1]))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the space before it that encoding adds is taken off."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _codec(model: bytes, kind: str) -> Codec:
    return Codec(model, kind)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _shared_model(spark: SparkSession, model_file: str | None, kind: str) -> Callable[[], Codec]:
    """The codec, made once per worker from the bytes the driver read (under 1 MB)."""
    with open(model_file or default_model(), "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    return lambda: _codec(model.value, kind)


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce(documents["text"], F.lit(""))
    return only(documents, doc_id="doc_id", text=text, n_chars=F.length(text).cast("bigint"), text_sha256=F.sha2(text, 256))


def _encoded_batches(
    codec: Codec, batches: Iterator[pa.RecordBatch]
) -> Iterator[tuple[pa.RecordBatch, list[bytes], pa.ListArray]]:
    """Each batch with the ids of its texts, as bytes and as lists."""
    for number, batch in enumerate(batches):
        if number % _RELEASE_BATCHES == 0:
            release()
        parts = codec.encode_all(batch.column("text").to_pylist())
        bounds = np.zeros(len(parts) + 1, np.int32)
        np.cumsum([len(p) // 4 for p in parts], out=bounds[1:])
        yield batch, parts, pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encoded(documents: DataFrame, model_file: str | None = None, kind: str = "bpe") -> DataFrame:
    """``doc_id, n_chars, ids, text_sha256``, one row per row of ``documents``.

    Whole texts are encoded. A null or empty text has no ids; ``n_chars`` of a null
    is 0. Repeated rows and null ``doc_id`` are kept as they are, an empty table
    gives an empty result, and other columns are not looked at. ``model_file`` is
    read by the driver; ``kind`` is ``bpe`` or ``unigram``.
    """
    spark = documents.sparkSession
    for_python(spark)
    codec = _shared_model(spark, model_file, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, ids in _encoded_batches(codec(), batches):
            columns = [batch.column("doc_id"), batch.column("n_chars"), ids, batch.column("text_sha256")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "ids", "text_sha256"])

    rows = _texts(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars bigint, ids array<int>, text_sha256 string")


def decoded(rows: DataFrame, model_file: str | None = None, kind: str = "bpe") -> DataFrame:
    """``rows`` with ``decoded``, the text of their ``ids``; null ids give a null text."""
    for_python(rows.sparkSession)
    codec = _shared_model(rows.sparkSession, model_file, kind)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec().decode
        for batch in batches:
            texts = [None if ids is None else decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return rows.mapInArrow(run, f"{schema}, decoded string")


def round_trip(documents: DataFrame, model_file: str | None = None, kind: str = "bpe") -> DataFrame:
    """``doc_id, n_chars, n_pieces, ids, decoded_sha256, exact``.

    ``exact`` says that decoding the ids gave the text back. It is false where the
    text holds the escape character U+2581, which decodes to a space.
    """
    spark = documents.sparkSession
    for_python(spark)
    codec = _shared_model(spark, model_file, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Both directions in one worker, which holds one model.
        decode = codec().decode
        for batch, parts, ids in _encoded_batches(codec(), batches):
            back = [hashlib.sha256(decode(np.frombuffer(p, np.int32).tolist()).encode()).hexdigest() for p in parts]
            exact = [a == b for a, b in zip(back, batch.column("text_sha256").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_chars"),
                    pa.array([len(p) // 4 for p in parts], pa.int64()),
                    ids,
                    pa.array(back, pa.string()),
                    pa.array(exact, pa.bool_()),
                ],
                names=["doc_id", "n_chars", "n_pieces", "ids", "decoded_sha256", "exact"],
            )

    rows = _texts(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars bigint, n_pieces bigint, ids array<int>, decoded_sha256 string, exact boolean"
    return rows.mapInArrow(run, schema)
