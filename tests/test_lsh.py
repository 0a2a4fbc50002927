"""Approximate neighbours: recall and work against brute force, buckets, hot and awkward vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import lsh, neighbours


def test_probes_are_the_cheapest_buckets():
    planes = lsh.Planes.draw(7, tables=2, bits=4, seed=1)
    vectors = np.random.default_rng(2).standard_normal((9, 7))
    own, probed = planes.own(vectors), planes.probed(vectors, 5).reshape(9, 2, 5)
    for n, v in enumerate(vectors):
        for t in range(2):
            margin = planes.normals[t] @ v
            costs = {b: sum(m**2 for i, m in enumerate(margin) if (m > 0) != bool(b >> i & 1)) for b in range(16)}
            wanted = sorted(costs, key=costs.get)[:5]
            assert set(probed[n, t] - 16 * t) == set(wanted) and own[n, t] - 16 * t == wanted[0]


def test_recall_and_work(spark, base, monkeypatch):
    vectors = spark.read.parquet(f"{base}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    sought = []

    def search(asked, points, n_points, n_queries, k, whole=neighbours._search):
        sought.append(int(n_points @ n_queries))
        return whole(asked, points, n_points, n_queries, k)

    monkeypatch.setattr(lsh, "_search", search)
    asked = vectors.where("vec_id % 20 = 0")
    got = {(r["vec_id"], r["neighbour"]): r["distance"] for r in lsh.approximate_join(asked, vectors, "vec_id", "vec_id", "v", 10).collect()}
    rows = {r["vec_id"]: np.array(r["v"]) / np.linalg.norm(r["v"]) for r in vectors.collect()}
    want = {}
    for q in rows:
        if q % 20 == 0:
            ranked = sorted((1 - rows[q] @ v, i) for i, v in rows.items())[:10]
            want |= {(q, i): d for d, i in ranked}
    assert len(set(got) & set(want)) >= 0.9 * len(want)
    assert all(d == pytest.approx(max(0.0, 1 - rows[q] @ rows[i]), abs=1e-9) for (q, i), d in got.items())
    assert 0 < sought[0] < len(rows) * len({q for q, _ in want})  # pairs measured, those met twice included


def test_hot_vectors_and_rows_without_direction(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "POINT_UNIT", 16)
    monkeypatch.setattr(neighbours, "QUERY_UNIT", 8)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(120)] + [(i, [1.0] * 6) for i in range(120, 200)]
    rows += [(300, None), (301, [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = lsh.approximate_join(df, df, "id", "id", "v", 3, probes=256)
    assert {(r["id"], r["rank"]): r["neighbour"] for r in got.where("id >= 120").collect()} == {
        (i, r + 1): 120 + r for i in range(120, 200) for r in range(3)
    }
    assert got.count() == 3 * 200 and got.where("id >= 300").count() == 0
    assert lsh.approximate_join(df, df.limit(0), "id", "id", "v", 3).count() == 0
