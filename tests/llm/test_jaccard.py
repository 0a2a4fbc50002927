"""Jaccard join against brute force: whole table, near-copy families, awkward rows, chunks, the tree by itself."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from claimlens.llm import jaccard_join as J
from claimlens.llm.components import components
from claimlens.llm.shingles import bitmap, shingle_set, signature
from claimlens.llm.signature_tree import candidate_pairs


def _family(seed, members, words=60, edits=3):
    """Texts that drift away from one another, so that links form chains around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(members):
        if rng.random() < 0.3:
            base = list(base)
            base[rng.randrange(len(base))] = f"n{rng.randrange(10**6)}"
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def _wanted(rows):
    sets = {d: brute.shingles(t) for d, t in rows}
    return {d: (len(sets[d]), c) for d, c in brute.link_components(sets).items()}


def _got(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.linked(docs).collect()}


@pytest.mark.parametrize("chunk", [J.CHUNK, 5])
def test_families(spark, monkeypatch, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)
    monkeypatch.setattr(J, "LISTED", J.LISTED if chunk > 5 else 0)
    texts = [t for seed in range(6) for t in _family(seed, 25)] + ["short one", "short ONE", "a b c d e", ""]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    assert _got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == _wanted(rows)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert _got(docs) == _wanted([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows(odd, no_docs):
    rows = J.linked(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 10}
    assert by_id[4]["component_id"] == by_id[5]["component_id"] == 4
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert by_id[9]["n_shingles"] == 1 and by_id[9]["component_id"] == 9
    assert J.linked(no_docs).count() == 0
    left = J.drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 5 not in ids and 4 in ids and ids.count(None) == 2 and {1, 2, 3} <= set(ids)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 100])
def test_prefixes_of_linked_sets_meet(n):
    assert J.prefix_length(n) == n - -(-8 * n // 10) + 1


def test_tree_loses_no_pair():
    texts = [t for seed in range(10) for t in _family(seed, 40, words=30 + 7 * seed, edits=5)]
    sets = [shingle_set(t) for t in texts]
    sets = list({signature(s): s for s in sets}.values())
    sizes = np.array([len(s) for s in sets])
    bitmaps = [bitmap(s) for s in sets]
    listed = [pair for left, right in candidate_pairs(sizes, bitmaps) for pair in zip(left.tolist(), right.tolist())]
    found = set(listed)
    assert len(found) == len(listed) and all(a < b for a, b in found)
    side = np.arange(len(sets)) % 2
    across = {pair for left, right in candidate_pairs(sizes, bitmaps, side) for pair in zip(left.tolist(), right.tolist())}
    assert across == {(a, b) for a, b in found if side[a] != side[b]}
    for b in range(len(sets)):
        for a in range(b):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (sizes[a] + sizes[b] - common):
                assert (a, b) in found
    assert len(found) < len(sets) ** 2 / 4


def test_shingles_are_those_of_the_words():
    for text in ["", "a", "A b\tC\x0bd", "a b c d e", "a b c d e f a b c d e", "é à ç ü ö ä", "x" * 5000 + " y z v w"]:
        assert len(shingle_set(text)) == len(brute.shingles(text))
        assert (shingle_set(text) == shingle_set(text.translate(brute.LOWER))).all()
    assert signature(shingle_set("a b c d")) != signature(shingle_set("a b c d d"))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    names = {n: rng.randrange(1 << 60) for e in edges for n in e}
    links = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    root = {n: n for n in names.values()}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, b in edges:
        x, y = find(names[a]), find(names[b])
        root[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components(links.where(F.lit(False))).count() == 0
