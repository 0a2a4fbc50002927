"""Packing: exact ids, gapless sequences, few of them; the local search on its own."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlens.llm import packing as P

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_are_the_tokenizers(text):
    assert P.token_ids(text).tolist() == _ids(text).tolist()


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "\r\n \t\x00", "I'll DON'T", None, "<|endoftext|>" * 3])
def test_special_texts(text):
    assert P.token_ids(text).tolist() == _ids(text).tolist()


def test_cuts():
    assert P.cuts(1, 8) == [(0, 1)] and P.cuts(8, 8) == [(0, 8)]
    assert P.cuts(9, 8) == [(0, 1), (1, 8)] and P.cuts(24, 8) == [(0, 8), (8, 8), (16, 8)]


def _check(rows, texts, size):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    wanted = defaultdict(list)
    for doc, text in texts:
        ids = _ids(text)
        for n, (start, length) in enumerate(P.cuts(len(ids), size)):
            wanted[doc].append((n, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    got = {d: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs) for d, rs in by_doc.items()}
    assert got == {d: sorted(w) for d, w in wanted.items()}
    return len(by_sequence), math.ceil(sum(r["length"] for r in rows) / size)


def test_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    used, least = _check(P.pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert used <= least + 1


def test_awkward_rows_and_rounds(odd, no_docs):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for group in (4, P.GROUP):
        _check(P.pack(odd, group=group).collect(), texts, 2048)
    assert P.pack(no_docs).count() == 0


def test_ids_come_with_the_pieces(odd):
    for r in P.pack(odd, size=64, with_ids=True).collect():
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def _check_bins(bins, lengths, size):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < lengths[b].sum() <= size for b in bins)


def test_local_search_empties_bins_and_raises_squared_fill():
    rng = np.random.default_rng(3)
    for size in (10, 100):
        for _ in range(20):
            lengths = rng.integers(1, size, 60)
            search = P.LocalSearch(lengths, [[i] for i in range(len(lengths))], size)
            search.shrink()
            bins = list(search.bins.values())
            _check_bins(bins, lengths, size)
            assert len(bins) < 60 and sum(lengths[b].sum() ** 2 for b in bins) > (lengths**2).sum()
            assert {n: lengths[b].sum() for n, b in search.bins.items()} == search.fill
            # no move is left: a shorter bin's item that fits a bin which it makes the fuller one
            for a in bins:
                for b in bins:
                    if a is not b and len(bins) > math.ceil(lengths.sum() / size):
                        room, fill = size - lengths[a].sum(), lengths[a].sum()
                        assert not any(lengths[i] <= room and lengths[b].sum() < fill + lengths[i] for i in b)
            assert len(P.pack_group(lengths, size)) <= len(P.best_fit(lengths, size))


def _fewest(lengths, size):
    """Fewest bins over all orders, by subsets: (bins, fill of the last one) of the best order of each subset."""
    best = [(0, size)] + [(len(lengths) + 1, 0)] * ((1 << len(lengths)) - 1)
    for subset, (bins, fill) in enumerate(best):
        for i, length in enumerate(lengths):
            if not subset >> i & 1:
                new = (bins, fill + length) if fill + length <= size else (bins + 1, length)
                best[subset | 1 << i] = min(best[subset | 1 << i], new)
    return best[-1][0]


def test_small_awkward_sets_reach_the_optimum():
    rng = np.random.default_rng(8)
    above = 0
    for low, high in ((1, 100), (20, 60), (30, 45), (5, 50)):
        for _ in range(15):
            lengths = rng.integers(low, high, 11)
            bins = P.pack_group(lengths, 100)
            _check_bins(bins, lengths, 100)
            above += len(bins) - _fewest(lengths.tolist(), 100)
    assert above <= 1  # a local search promises no optimum, and yet it is there


def test_bins_filled_one_by_one():
    lengths = np.array([7, 5, 5, 4, 3, 3, 3, 10, 1])
    bins = P.fullest_first(lengths, 10)
    _check_bins(bins, lengths, 10)
    assert sorted(lengths[b].sum() for b in bins) == [1, 10, 10, 10, 10]
    assert P.fullest_first(np.zeros(0, int), 10) == []


def test_what_a_group_closes():
    bins, fills = [[0], [1, 2], [3], [4, 5], [6]], np.array([10, 9, 8, 7, 1])
    assert P._closed(bins, fills, 10).tolist() == [True, True, True, False, False]  # 3 of 7 pieces go on
    assert P._closed([[0]], np.array([3]), 10).tolist() == [True]
    assert P._closed([[0], [1]], np.array([10, 10]), 10).tolist() == [True, True]


def test_rounds_lose_little_against_one_group(spark):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(i, " x" * int(n)) for i, n in enumerate(rng.integers(1, 63, 1500))], "doc_id long, text string")
    used = {g: P.pack(docs, size=64, group=g).select("sequence_id").distinct().count() for g in (150, 2000)}
    assert used[2000] <= used[150] <= 1.02 * used[2000] + 2
