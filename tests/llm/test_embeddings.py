"""Nearest neighbours, hard negatives and whitening against brute force."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.llm import graph_index, hard_negatives, whitening
from claimlens.llm.queries import QUERIES

D = 12


def awkward(rng):
    """Random rows, a third of them one vector, a repeated row, and rows that take no part."""
    rows = [(i, rng.standard_normal(D).tolist(), int(i % 3)) for i in range(400)]
    rows += [(i, [0.5] * D, int(i % 3)) for i in range(400, 600)]
    rows += [rows[0], rows[20], (20, rows[40][1], 1)]
    rows += [(700, None, 1), (720, [0.0] * D, 1), (740, [], 1), (None, [1.0] * D, 1), (760, [1.0] * D, None)]
    rows += [(780, [1.0] * (D - 1) + [None], 1), (800, [float("nan")] * D, 1), (801, [float("inf")] * D, 2), (802, [1.0] * 3, 2)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward(np.random.default_rng(3))


@pytest.fixture(scope="module")
def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    return df.withColumns({c: F.lit("extra") for c in ("key", "vec", "shard", "y", "codes", "block", "query", "rank", "score", "x", "keys", "n")})


def good(rows, zero=False):
    size = max(len(r[1] or []) for r in rows)
    kept = [r for r in rows if r[0] is not None and r[1] and len(r[1]) == size and all(x is not None and math.isfinite(x) for x in r[1])]
    return kept if zero else [r for r in kept if any(r[1])]


def brute_nearest(rows, k, every=20):
    rows = sorted({(i, tuple(v)) for i, v, _ in good(rows)})
    out = []
    for q, v in rows:
        if q % every == 0:
            hits = [(-math.fsum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def test_neighbours_of_awkward_rows(vectors, rows):
    index = graph_index.build_index(vectors, shard_rows=150)  # several shards
    assert index.shards.select(F.explode("keys").alias("k")).select(F.explode("k")).count() == len({(i, tuple(v)) for i, v, _ in good(rows)})
    found = graph_index.search(index, vectors.where("vec_id % 20 = 0"), k=7, block=9)  # several blocks
    got, want = sorted(tuple(r) for r in found.collect()), brute_nearest(rows, 7)
    assert len(got) == len(want) and [r[:2] for r in got] == [r[:2] for r in want]
    assert len(set(got) & set(want)) >= 0.98 * len(want)
    assert {r[2:] for r in got} <= {r[2:] for r in brute_nearest(rows, 1000)}  # every score is the true one


def test_all_candidates_where_there_are_few(spark):
    df = spark.createDataFrame([(20 * i, [float(i), 1.0]) for i in range(1, 5)], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in graph_index.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert [r[:3] for r in got if r[0] == 20] == [(20, 1, 80), (20, 2, 60), (20, 3, 40)] and len(got) == 12


def test_pruning_keeps_the_nearest_and_drops_what_it_covers():
    angles = np.array([0.0, 0.10, 0.12, -0.30, 3.0])
    points = np.column_stack([np.cos(angles), np.sin(angles)]).astype(np.float32)
    proposed = np.array([[4, 3, 2, 1, -1, 0]])
    strict, relaxed = (graph_index.robust_prune(points, np.array([0]), proposed, 4, a).tolist() for a in (1.0, 1.2))
    # 2 lies behind 1; the far point is hardly nearer to 1 than to the node, which the relaxed rule forgives
    assert strict == [[1, 3, -1, -1]] and relaxed == [[1, 3, 4, -1]]


def test_recall_of_the_query(spark, larger):
    got = QUERIES["op11_nearest_neighbours"](spark, larger).collect()
    table = sorted(tuple(r) for r in spark.read.parquet(os.path.join(larger, "embeddings.parquet")).select("vec_id", "embedding", "label").collect())
    want = brute_nearest(table, 20)
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id, r.score) for r in got} & {(q, i, s) for q, _, i, s in want}) >= 0.95 * len(want)


def brute_negatives(rows, every, n_pos=5, n_neg=10):
    y = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in good(rows, zero=True) if lab is not None]
    out = []
    for a, v, lab in y:
        if a % every == 0:
            scored = sorted((-sum(p * q for p, q in zip(v, w)), i, l) for i, w, l in y if i != a)
            for s, p, _ in [x for x in scored if x[2] == lab][:n_pos]:
                fit = [(i, -t) for t, i, l in scored if l != lab and 30 * -s <= 100 * -t <= 90 * -s]
                out += [(a, p, r + 1, i, -s, t) for r, (i, t) in enumerate(fit[:n_neg])]
    return sorted(out)


def test_hard_negatives_of_awkward_rows(vectors, rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SEEDS", 50)
    got = hard_negatives.mine(vectors, F.col("vec_id") % 20 == 0, block=8)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 20)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(1)
    y = np.vstack([rng.integers(-300, 300, (200, 70)), np.zeros((1, 70), int), np.full((1, 70), 7)]).astype(np.int32)
    turns = hard_negatives.rotations(70)
    anchors = hard_negatives.Anchors.of(np.arange(20), np.zeros(20), y[:20], turns)
    low, high = anchors.intervals(*hard_negatives.encode(y, turns))
    score = y.astype(np.int64) @ y[:20].T.astype(np.int64)
    assert (low <= score).all() and (score <= high).all()
    length = np.sqrt((y.astype(float) ** 2).sum(axis=1))
    assert np.median((high - low)[:200] / (length[:200, None] * length[:20])) < 0.5  # of 2 for no knowledge


def whitened(rows, k=32, scale=64):
    x = np.array([[math.floor(scale * e) + 1_000_000 for e in v] for _, v, _ in good(rows, zero=True)], float)
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return c @ v / np.sqrt(e), e / (c**2).sum() * len(x), [int(s) for s in ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)]


def check_whitening(got, table, k):
    values, explained, deviation = whitened(table, k)
    ids = [r[0] for r in good(table, zero=True)]
    assert len(got) == len(ids) * k and {r.n for r in got} == {len(ids)}
    assert {r.component: r.explained for r in got} == pytest.approx({i + 1: e for i, e in enumerate(explained)}, rel=1e-9)
    assert {round(r.identity_error, 6) for r in got} == {0.0}
    want = sorted((i, c + 1, d, w) for i, d, row in zip(ids, deviation, values) for c, w in enumerate(row))
    got = sorted((r.vec_id, r.component, r.deviation, r.whitened) for r in got)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.abs(np.array([r[3] for r in got]) - np.array([r[3] for r in want])).max() < 1e-7


def test_whitening_of_awkward_rows(vectors, rows):
    check_whitening(whitening.whiten(vectors).collect(), rows, D)


def test_whitening_query(spark, larger):
    table = spark.read.parquet(os.path.join(larger, "embeddings.parquet")).select("vec_id", "embedding", "label").collect()
    check_whitening(QUERIES["op13_whitening"](spark, larger).collect(), [tuple(r) for r in table], 32)


def test_whitening_of_equal_deviations_and_low_rank(spark):
    """Repeated eigenvalues end the Krylov space early; directions without deviation have no component."""
    corners = [(i, [float(s) if j == i // 2 else 0.0 for j in range(6)] + [2.0]) for i, s in enumerate([1, -1] * 6)]
    df = spark.createDataFrame(corners, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r.component for r in got} == set(range(1, 7)) and all(r.identity_error < 1e-9 for r in got)
    assert {round(r.explained, 9) for r in got} == {round(1 / 6, 9)}
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0


def test_empty_tables(vectors):
    empty = vectors.limit(0)
    marked = F.col("vec_id") % 20 == 0
    for found in (graph_index.nearest(empty, marked), hard_negatives.mine(empty, marked), whitening.whiten(empty)):
        assert found.count() == 0 and len(found.columns) >= 4
