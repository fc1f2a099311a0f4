"""Token files: exact round trip, order and checksums."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import rans, token_files
from roadpulse.storage import fresh_path

TEXTS = ["", " ", "a  b", "one two\nthree", "x <|endoftext|> y<|endoftext|>", "\n lead and trail \n", "nb sp 　 wide", "é😀 " * 50, "z" * 5000]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 60_000), min_size=1, max_size=700), st.integers(1, 400))
def test_ids_come_back(ids, times):
    ids = np.array(ids * times, np.uint32)[:100_000]
    assert (rans.decode(rans.encode(ids)) == ids).all()


def test_rare_symbols_do_not_crowd_out():
    ids = np.r_[np.arange(50_000), np.zeros(200_000)].astype(np.uint32)
    table = rans.Table.of(ids)
    assert table.freqs.min() >= 1 and int(table.freqs.sum()) == 1 << table.bits
    back = rans.Table.unpack(table.pack())
    assert (back.symbols == table.symbols).all() and (back.freqs == table.freqs).all() and back.bits == table.bits


def test_size_is_near_entropy():
    ids = (np.random.default_rng(0).zipf(1.3, 300_000) % 50_000).astype(np.uint32)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    message = rans.encode(ids)
    assert 4 * len(message.words) < 1.01 * -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(message.checksums) == 5


def test_damage_is_found():
    message = rans.encode(np.arange(1000, dtype=np.uint32))
    message.words[3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(message)


@pytest.mark.parametrize("segment", [5, 1 << 19])
def test_files_hold_all_documents(spark, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    rows = [(i * 7 % 40, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(3, None), (None, "no id"), (3, "b")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as file", "2 as start")
    path = fresh_path(spark, "test-tokens")
    token_files.write_token_files(frame, path)
    got = token_files.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(token_files.default_vocabulary())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        assert (r["doc_id"], r["start"], r["n_tokens"], list(r["ids"])) == (doc_id, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    blocks = spark.read.schema(token_files.SEGMENT).parquet(path)
    assert blocks.agg(F.sum("n_ids")).first()[0] == start


def test_no_documents(spark):
    path = fresh_path(spark, "test-tokens")
    token_files.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_forgetful_encoder(monkeypatch):
    """What is not remembered is encoded again."""
    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", 600)
    with open(token_files.default_vocabulary(), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    library = Tokenizer.from_file(token_files.default_vocabulary())
    for _ in range(2):
        got = encoder.encode(TEXTS)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_texts_with_and_without_white_runs_together():
    """Words are cut and coded for many texts at once; each text gets its own ids back."""
    with open(token_files.default_vocabulary(), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    library = Tokenizer.from_file(token_files.default_vocabulary())
    texts = [*TEXTS, " x", "x ", "a\x1c b \x1f c", "it's 12 a", "a\xa0 b", *(f"w{i} the  w{i // 2}" for i in range(50)), "the the the"]
    got = encoder.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.encode([]) == []


def test_batches_are_encoded_together(monkeypatch):
    """A new word of several batches is encoded once, whether or not it can be remembered."""

    class Task:
        partitionId = staticmethod(lambda: 0)
        get = classmethod(lambda cls: cls)

    class Vocabulary:
        value = open(token_files.default_vocabulary(), encoding="utf-8").read()

    monkeypatch.setattr(token_files, "TaskContext", Task)
    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", 0)
    seen = []
    plain = token_files.Encoder._words
    monkeypatch.setattr(token_files.Encoder, "_words", lambda self, words: seen.extend(words) or plain(self, words))
    token_files._encoder.cache_clear()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a repeated word", None]})
    found = list(token_files._segments(Vocabulary, 2)(iter([batch] * 20)))
    token_files._encoder.cache_clear()
    assert sum(b.column("n_ids")[0].as_py() for b in found) == 20 * (3 + 2)
    assert sorted(seen) == ["repeated", "word"]
