"""Hot keys, sliced ranks, narrowed quantiles and multi-cell neighbour search against plain answers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlens.session import new_stage_path
from claimlens.operators import fraud_features, joins, neighbours, quantiles, ranking
from claimlens.operators.recommend import fit_collab, recommend_collab


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(6000).select(F.concat(F.lit("C"), "id").alias("claim_id"), key.alias("member_id"))


def test_skew_join_equals_left_join(spark, skewed):
    right = skewed.where("member_id IS NOT NULL").groupBy("member_id").agg(F.count("*").alias("n"))
    right = right.where("member_id <> 'k7'")
    want = skewed.join(right, "member_id", "left")
    columns = ["claim_id", "member_id", "n"]
    for hot in (None, joins.hot_keys(skewed, "member_id", rows=300)):
        got = joins.skew_join(skewed, right, "member_id", F.col("claim_id"), hot)
        assert got.count() == 6000
        assert got.select(columns).exceptAll(want.select(columns)).count() == 0


def test_hot_rows_are_dealt_over_many_tasks(spark, skewed):
    hot = joins.hot_keys(skewed, "member_id", rows=100)
    (key,) = hot.collect()
    assert key["member_id"] == "hot" and key["_salts"] >= 20
    right = skewed.select("member_id").distinct().where("member_id IS NOT NULL").withColumn("x", F.lit(1))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("-1", "false", "50")):
            spark.conf.set(name, value)
        joined = joins.skew_join(skewed, right, "member_id", F.col("claim_id"), hot)
        plan = joined._jdf.queryExecution().toString()
        assert "_salt" in plan and "CartesianProduct" not in plan
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(r["count"] for r in sizes) < 0.15 * skewed.count()  # the key itself holds a third


def test_heavy_keys_are_bounded(spark):
    counts = spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert joins.heavy(counts, "k", "n").count() == 0
    assert joins.heavy(counts.withColumn("n", F.col("k")), "k", "n", rows=9_000).count() == 999


def test_orphans_with_hot_key(spark, skewed):
    parents = spark.createDataFrame([("hot",)], "member_id string")
    got = joins.orphans(skewed, parents, "member_id")
    assert got.count() == 2000 and got.where("member_id = 'hot'").count() == 0


def test_hash_rank_equals_window(spark, skewed):
    got = ranking.hash_rank(skewed, ["member_id"], "claim_id", 7)
    order = Window.partitionBy("member_id").orderBy(F.md5(F.concat("claim_id", F.lit("|7"))), "claim_id")
    want = skewed.withColumn("rank", F.row_number().over(order))
    columns = ["claim_id", "member_id", "rank"]
    assert got.count() == 6000
    assert got.select(columns).exceptAll(want.select(*columns[:2], F.col("rank").cast("bigint"))).count() == 0


def test_folds_and_split_sizes(spark, skewed):
    folds = ranking.stratified_folds(skewed.fillna("none"), "member_id", "claim_id", 5)
    sizes = {r["fold"]: r["n"] for r in folds.where("member_id = 'hot'").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sizes == {i: 400 for i in range(5)}
    split = ranking.plain_split(skewed, "claim_id", 0.2)
    assert split.where("is_test = 1").count() == 1200


def test_running_total(spark):
    df = spark.range(2000).select((F.col("id") * 37 % 2000).cast("double").alias("x"), F.col("id").alias("v"))
    got = ranking.running_total(df, "x", ["v"], slices=7)
    order = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("v_before", F.coalesce(F.sum("v").over(order), F.lit(0)))
    assert got.select("x", "v", "v_before").exceptAll(want.select("x", "v", "v_before")).count() == 0


@pytest.mark.parametrize("cap", [100_000, 3])
def test_exact_quantiles(spark, monkeypatch, cap):
    """With a tiny collection limit the search has to narrow, count and use ties."""
    monkeypatch.setattr(quantiles, "MAX_COLLECT", cap)
    if cap == 3:
        monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 50)
        monkeypatch.setattr(quantiles, "MARGIN", 2 / 50)
    rng = np.random.default_rng(5)
    plain = rng.lognormal(7, 1.2, 3001)
    tied = np.where(rng.random(3001) < 0.4, 5.0, rng.integers(0, 40, 3001).astype(float))
    rows = [(float(a), float(b), None if i % 10 == 0 else i) for i, (a, b) in enumerate(zip(plain, tied))]
    df = spark.createDataFrame(rows, "plain double, tied double, holes int")
    fractions = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, {c: fractions for c in df.columns})
    holes = [i for i in range(3001) if i % 10]
    for name, values in (("plain", plain), ("tied", tied), ("holes", holes)):
        assert got[name] == pytest.approx(list(np.quantile(values, fractions)), rel=1e-12)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantiles.quantile(empty, "x", 0.5) is None


def brute_force(queries, points, k):
    """(query, rank) -> (neighbour, distance) with ties in key order."""

    def unit(v):
        n = np.linalg.norm(v)
        return v / n if n > 0 else v

    out = {}
    for qk, q in queries.items():
        ranked = sorted((round(max(0.0, 1 - float(unit(q) @ unit(p))), 12), pk) for pk, p in points.items())
        out[qk] = [(pk, d) for d, pk in ranked[:k]]
    return out


@pytest.mark.parametrize("pivots", [1, 12, 60])
def test_neighbours_equal_brute_force(spark, monkeypatch, pivots):
    """Clustered points, exact copies on a third of them, and zero vectors on both sides."""
    monkeypatch.setattr(neighbours, "QUERY_UNIT", 50)
    monkeypatch.setattr(neighbours, "POINT_UNIT", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    cloud = centres[rng.integers(0, 6, 240)] + 0.2 * rng.normal(size=(240, 5))
    cloud[::3] = cloud[0]
    cloud[7] = 0.0
    points = {f"p{i:03d}": v for i, v in enumerate(cloud)}
    asked = {f"q{i:03d}": v for i, v in enumerate(np.vstack([cloud[:60], rng.normal(size=(60, 5)), np.zeros((1, 5))]))}
    schema = "key string, vec array<double>"

    def frame(rows):
        df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in rows.items()], schema)
        return df.withColumn("vec", neighbours.unit_vector(F.col("vec")))

    known = frame(points).withColumn("payload", F.lit(None).cast("string"))
    queries = frame(asked)
    found = neighbours.nearest_vectors(queries, known, 6, pivots)
    got = queries.join(found, "vec").select("key", F.col("neighbours.distance").alias("d"), F.col("neighbours.key").alias("n")).collect()
    want = brute_force(asked, points, 6)
    assert len(got) == len(asked)
    for row in got:
        expected = want[row["key"]]
        assert row["d"] == pytest.approx([d for _, d in expected], abs=1e-9)
        assert row["n"] == [n for n, _ in expected]


def test_stored_index_is_asked_without_assigning_points_again(spark, monkeypatch):
    rng = np.random.default_rng(9)
    cloud = np.repeat(np.eye(6) * 4, 50, axis=0) + 0.1 * rng.normal(size=(300, 6))
    rows = [(f"p{i:03d}", None, [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(cloud)] + [("z", None, [0.0] * 6)]
    points = spark.createDataFrame(rows, "key string, payload string, vec array<double>")
    path = new_stage_path(spark, "index")
    monkeypatch.setattr(neighbours, "FOLDERS", 8)
    neighbours.NeighbourIndex.build(points, 5, path)
    assigned, read = [], []

    def assign(df, pivots, whole=neighbours._assign):
        assigned.append(df.count())
        return whole(df, pivots)

    def cells(index, asked, whole=neighbours.NeighbourIndex._cells):
        read.append((whole(index, asked), asked))
        return read[-1][0]

    monkeypatch.setattr(neighbours, "_assign", assign)
    monkeypatch.setattr(neighbours.NeighbourIndex, "_cells", cells)
    index = neighbours.NeighbourIndex.load(spark, path)
    near = points.where("key IN ('p003', 'p007', 'z')")
    got = {r["key"]: [n["key"] for n in r["neighbours"]] for r in near.join(index.nearest(near, 5), "vec").collect()}
    want = brute_force({k: np.array(v) for k, _, v in rows if k in got}, {k: np.array(v) for k, _, v in rows}, 5)
    assert got == {k: [n for n, _ in hits] for k, hits in want.items()}
    assert assigned == [2]  # the queries that are not zero; no point
    whole = spark.read.parquet(f"{path}/cells")
    for df, asked in read:
        touched = df.select(F.input_file_name().alias("f")).distinct().count()
        assert 0 < touched < whole.select(F.input_file_name().alias("f")).distinct().count()
        assert df.count() < whole.count()
    index.copy_to(f"{path}-copy")
    again = neighbours.NeighbourIndex.load(spark, f"{path}-copy").nearest(near, 5)
    assert sorted(map(str, again.collect())) == sorted(map(str, index.nearest(near, 5).collect()))
    with pytest.raises(ValueError):
        index.nearest(near, 6)


def test_a_vector_is_not_written_once_per_cell_it_searches(spark, monkeypatch):
    """Vectors in no particular direction need nearly every cell; what is written stays one row per vector."""
    rng = np.random.default_rng(11)
    cloud = rng.normal(size=(200, 12))
    points = spark.createDataFrame([(i, None, [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(cloud)], "key long, payload string, vec array<double>")
    written = {}

    def stage(df, name, whole=neighbours.stage):
        out = whole(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neighbours, "stage", stage)
    found = neighbours.nearest_vectors(points, points, 4, 10)
    got = {r["key"]: [n["key"] for n in r["neighbours"]] for r in points.join(found, "vec").collect()}
    want = brute_force(dict(enumerate(cloud)), dict(enumerate(cloud)), 4)
    assert got == {k: [n for n, _ in hits] for k, hits in want.items()}
    assert max(written.values()) <= 200, written


@pytest.mark.parametrize("n", [1, 2, 40, 300])
def test_nearest_pivot_of_two_levels(n):
    rng = np.random.default_rng(n)
    pivots, vectors = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.normal(size=(n, 4)), rng.normal(size=(500, 4))))
    cell, reach = neighbours._Pivots.of(pivots).nearest(vectors)
    chords = neighbours._chords(vectors, pivots)
    assert np.allclose(reach, chords.min(axis=1)) and np.allclose(chords[np.arange(500), cell], reach)


def test_knn_join_keeps_every_query(spark):
    rows = [(f"m{i:02d}", [1.0, float(i // 2), 2.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    got = neighbours.knn_join(df, df, "id", "id", "v", 3)
    assert got.groupBy("id").count().where("count = 3").count() == 20
    assert got.where("rank = 1 AND distance > 1e-9").count() == 0


def test_collaborative_scores_reconstruct_all_but_the_weakest_plan(spark):
    rows = [("a", "Gold", 1), ("a", "Gold", None), ("b", "Gold", 1), ("c", "Silver", 1), ("d", "Silver", 1), ("e", "Bronze", 1)]
    ratings = spark.createDataFrame(rows, "member_id string, plan_type string, rating int")
    model = fit_collab(ratings)
    best = {(r["member_id"], r["plan"]): r["score"] for r in recommend_collab(model, ratings, 3).collect()}
    assert best["a", "Gold"] == pytest.approx(2.0)
    assert best["e", "Bronze"] == pytest.approx(0.0)


def test_fraud_matrix_with_hot_provider_and_nulls(spark):
    rows = [
        (f"C{i}", f"M{i % 7}", "P0" if i % 3 == 0 else None if i % 3 == 1 else f"P{i % 11}", float(10 + i), i % 4, i % 3, 0)
        for i in range(300)
    ]
    claims = spark.createDataFrame(
        rows,
        "claim_id string, member_id string, provider_id string, claim_amount double, num_procedures int, days_in_hospital int, is_fraud int",
    )
    out = fraud_features.FraudFeatures().fit(claims).transform(claims)
    assert out.count() == 300 and out.select("claim_id").distinct().count() == 300
    ranges = out.agg(*[F.min(c).alias(f"lo_{c}") for c in fraud_features.C.FRAUD_FEATURES], *[F.max(c).alias(f"hi_{c}") for c in fraud_features.C.FRAUD_FEATURES]).first()
    assert all(0.0 <= x <= 1.0 for x in ranges)
