"""What Python workers remember: right results within a few bytes a word."""

from __future__ import annotations

import sys
import tracemalloc

import pytest

from roadpulse.llm import pieces
from roadpulse.llm.worker_memory import PackedMemo


def test_packed_memo_tells_words_from_results_and_neighbours():
    memo = PackedMemo(1)  # one string for all words
    memo.room = 10_000
    words = ["a", "ab", "b", "YQ==", "YQ", "\n", "\t\n", "é", "▁", "😀x", "a b", "\0"]
    results = [w.encode() * 3 + b" \n\0" for w in words]
    for word, result in zip(words, results, strict=True):
        assert memo.get(word) is None
        memo.learn(word, result)
    assert len(memo.strings) == 1 and [memo.get(w) for w in words] == results
    assert memo.get("aa") is memo.get("YWE=") is memo.get("AAA=") is None


@pytest.mark.parametrize("limit", [0, 1, 5_000, 300_000])
def test_packed_memo_keeps_its_limit(limit):
    memo = PackedMemo(limit)
    for i in range(20_000):
        memo.learn(f"w{i}", b"1234567890123456")
    held = [memo.get(f"w{i}") for i in range(20_000)]
    assert set(held) <= {None, b"1234567890123456"} and None in held
    assert limit < 5_000 or held[0]
    if held[0]:
        assert sum(map(sys.getsizeof, memo.strings)) + sys.getsizeof(memo.strings) <= 1.1 * limit


def test_words_of_the_codec_take_few_bytes():
    """These words took 44 MB as entries of a dictionary."""
    codec = pieces.Codec(open(pieces.default_model(), "rb").read())
    cut = []
    codec.segment = lambda text: cut.append(1) or [7, len(text), 31_999]
    words = [f"{i * 2654435761 % 2**32:x}" for i in range(300_000)]
    tracemalloc.start()
    for i in range(0, len(words), 10_000):
        codec.encode_all([" ".join(words[i : i + 10_000])])
    held = tracemalloc.get_traced_memory()[0] - sys.getsizeof(cut)
    tracemalloc.stop()
    assert held < 25e6
    del cut[:]
    codec.encode_all([" ".join(words)])
    assert not cut  # all are remembered
