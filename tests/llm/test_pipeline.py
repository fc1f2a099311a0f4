"""The registered queries and the pipeline over the given tables."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from compare import canonical, oracle_rows
from roadpulse.llm import language, near_dup, pieces, pii
from roadpulse.llm.oracle import ORACLE
from roadpulse.llm.queries import QUERIES

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, small, name):
    frame = QUERIES[name](spark, small)
    names, rows, _ = oracle_rows(small, ORACLE[name])
    got, want = canonical(frame.columns, frame.collect()), canonical(names, rows)
    assert got == want and got[1]


def test_pipeline(spark, small):
    """Each stage against what its operator says about the stage's own input."""
    before = spark.read.parquet(f"{small}/documents.parquet")
    assert before.columns == DOCUMENTS
    whole = {r["doc_id"]: r for r in before.collect()}
    (_, identify), (_, dedup), (_, redact), (_, mix), (_, encode) = corpus_pipeline.STAGES

    named = identify(spark, before, small)
    assert named.columns == DOCUMENTS
    rows = {r["doc_id"]: r for r in named.collect()}
    learn = before.filter(language.fold(before["doc_id"]) != language.HELD_OUT_FOLD)
    found = {r["doc_id"]: r for r in language.identified(before, learn).collect()}
    known = {i for i, r in found.items() if r["lang_pred"] != "und" and r["bits_per_byte"] <= language.MAX_BITS_PER_BYTE}
    assert set(rows) == known and all(r["text"] == whole[i]["text"] for i, r in rows.items())
    assert all(r["lang"] == found[i]["lang_pred"] for i, r in rows.items())

    single = dedup(spark, named, small)
    assert single.columns == DOCUMENTS
    kept = {r["doc_id"] for r in near_dup.near_duplicates(named).collect() if r["kept"]}
    assert {r["doc_id"] for r in single.collect()} == kept and len(kept) < len(rows)

    clean = redact(spark, single, small)
    assert clean.columns == DOCUMENTS
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(single).collect()}
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(texts) == kept
    for i, listed in spans.items():
        text, at, parts = whole[i]["text"], 0, []
        for kind, start, end in (s.split(":") for s in listed.split(",") if s):
            if int(start) >= at:
                parts += [text[at : int(start)], f"[{kind.upper()}]"]
            at = max(at, int(end))
        assert texts[i] == "".join([*parts, text[at:]])

    taken = mix(spark, clean, small)
    assert taken.columns == DOCUMENTS
    copies = taken.groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in copies} <= kept and max(r["count"] for r in copies) <= 2

    out = encode(spark, taken, small).collect()
    assert len(out) == sum(r["count"] for r in copies)
    codec = pieces.Codec(open(pieces.default_model(), "rb").read())
    for r in out[:50]:
        assert r["exact"] and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert codec.decode(list(r["ids"])) == texts[r["doc_id"]]
