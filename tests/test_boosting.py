"""Boosted trees against a plain version on arrays, and what must hold of every tree."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from claimlens.operators import boosting
from claimlens.operators.boosting import Growth
from claimlens.plans import claim_models, fraud_models
from claimlens.plans.claim_models import with_probability
from claimlens.session import new_stage_path

COLUMNS = ("a", "b", "c")
DEEP = Growth(rounds=3, step=0.3, policy="depth", max_depth=3, l2=1.0, min_hessian=1.0, positive_weight=3.0)
LEAVES = Growth(rounds=3, step=0.3, policy="loss", max_depth=None, max_leaves=6, l2=0.0, min_hessian=1e-3, min_rows=20, positive_weight=None)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 900
    a, b, c = rng.integers(0, 12, n), rng.integers(0, 7, n), rng.integers(0, 2, n)
    # an interaction that no linear model sees, with noise
    label = (((a > 5) ^ (b > 3)) ^ (rng.random(n) < 0.1)).astype(int)
    return [(f"K{i:04}", float(a[i]), float(b[i]), float(c[i]), int(label[i]), int(i % 5 == 0), i % 3) for i in range(n)]


@pytest.fixture(scope="module")
def matrix(spark, rows):
    schema = "key string, a double, b double, c double, y int, is_test int, fold int"
    return spark.createDataFrame(rows, schema).repartition(5)


def plain_boosting(rows, rules):
    """The same growth on arrays: nodes as (tree, depth, feature, threshold, gain, weight, rows) in the order of splitting."""
    seen = [r for r in rows if rules.left_out is None or dict(zip(("is_test", "fold"), r[5:7]))[rules.left_out[0]] != rules.left_out[1]]
    x, y = np.array([r[1:4] for r in seen]), np.array([r[4] for r in seen])
    n1 = y.sum()
    w = np.where(y == 1, rules.positive_weight or len(y) / (2 * n1), 1.0 if rules.positive_weight else len(y) / (2 * (len(y) - n1)))
    margin, out = np.zeros(len(y)), []
    for number in range(rules.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def score(m):
            return g[m].sum() ** 2 / (h[m].sum() + rules.l2)

        def best(m):
            found = None
            for f in range(x.shape[1]):
                for t in sorted(set(x[:, f]))[:-1]:
                    left, right = m & (x[:, f] <= t), m & (x[:, f] > t)
                    if min(left.sum(), right.sum()) < max(1, rules.min_rows) or min(h[left].sum(), h[right].sum()) < rules.min_hessian:
                        continue
                    gain = score(left) + score(right) - score(m)
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, f, t, left, right)
            return found

        open_, leaves, weights = [(0, np.ones(len(y), bool))], 1, []
        while True:
            options = [(b, d, m) for d, m in open_ if (rules.max_depth is None or d < rules.max_depth) and (b := best(m)) is not None]
            if not options or (rules.max_leaves and leaves >= rules.max_leaves):
                break
            (gain, f, t, left, right), d, m = min(options, key=lambda o: (-o[0][0] if rules.policy == "loss" else o[1]))
            open_ = [o for o in open_ if o[1] is not m] + [(d + 1, left), (d + 1, right)]
            leaves += 1
            out.append((number, d, COLUMNS[f], t, round(gain, 6), int(m.sum())))
        for d, m in open_:
            weight = -g[m].sum() / (h[m].sum() + rules.l2)
            weights.append((number, d, None, None, round(weight, 6), int(m.sum())))
            margin[m] += rules.step * weight
        out += weights
    return sorted(out, key=str), margin


@pytest.mark.parametrize("rules", [DEEP, LEAVES, replace(LEAVES, left_out=("fold", 1)), replace(DEEP, left_out=("is_test", 1), gamma=0.0)])
def test_trees_equal_plain_growth(spark, matrix, rows, rules, monkeypatch):
    monkeypatch.setattr(boosting, "FLUSH", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 128)
    booster = boosting.train(boosting.bin_matrix(matrix, COLUMNS, "y"), [rules])[0]
    got = []
    for r in booster.nodes(spark).collect():
        inner = r["feature"] is not None
        got.append((r["tree"], r["depth"], r["feature"], r["threshold"], round(r["gain"] if inner else r["weight"], 6), r["n_rows"]))
    want, margin = plain_boosting(rows, rules)
    assert sorted(got, key=str) == want
    if rules.left_out is None:
        scored = with_probability(booster.model("y"), matrix).orderBy("key").collect()
        assert np.abs(np.array([r["probability"] for r in scored]) - 1 / (1 + np.exp(-margin))).max() < 1e-9


def test_models_side_by_side_equal_single_runs(matrix):
    binned = boosting.bin_matrix(matrix, COLUMNS, "y")
    rules = [DEEP, replace(LEAVES, rounds=5), replace(LEAVES, left_out=("fold", 0)), replace(DEEP, left_out=("fold", 2))]
    together = boosting.train(binned, rules)
    for rule, booster in zip(rules, together):
        alone = boosting.train(binned, [rule])[0]
        assert [(t.feature, t.cut, t.left) for t in alone.trees] == [(t.feature, t.cut, t.left) for t in booster.trees]
        assert np.allclose(np.concatenate([t.weight for t in alone.trees]), np.concatenate([t.weight for t in booster.trees]))


def test_what_holds_of_every_tree(spark, matrix):
    """Leaf count, sums of children, leaf weights, and best-first order, from the table of nodes."""
    rules = replace(LEAVES, rounds=2, max_leaves=9, min_rows=5)
    nodes = boosting.train(boosting.bin_matrix(matrix, COLUMNS, "y"), [rules])[0].nodes(spark)
    assert {r["n"] for r in nodes.groupBy("tree").agg(F.count_if(F.col("feature").isNull()).alias("n")).collect()} == {9}
    assert nodes.where(F.abs(F.col("weight") + F.col("gradient") / (F.col("hessian") + rules.l2)) > 1e-9).count() == 0
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}
    parent = {(t, c): n for (t, n), r in rows.items() if r["feature"] for c in (r["left_node"], r["right_node"])}
    for (tree, _), r in rows.items():
        if r["feature"]:
            both = [rows[tree, r["left_node"]], rows[tree, r["right_node"]]]
            assert r["n_rows"] == sum(b["n_rows"] for b in both)
            assert r["gradient"] == pytest.approx(sum(b["gradient"] for b in both))
            # whatever was open when this node was split had no larger gain
            for (other_tree, n), o in rows.items():
                if other_tree == tree and o["feature"] and o["split_order"] > r["split_order"]:
                    above = rows.get((tree, parent.get((tree, n))))
                    if above is None or above["split_order"] < r["split_order"]:
                        assert o["gain"] <= r["gain"] + 1e-9


def test_boosters_learn_what_a_line_cannot(matrix):
    aucs = {
        f: claim_models.train_claim(matrix.drop("is_test", "fold"), f, "y", "key", COLUMNS, rounds=12).metrics["auc_roc"]
        for f in ("logistic", "xgboost", "lightgbm")
    }
    assert aucs["xgboost"] > 0.85 and aucs["lightgbm"] > 0.85 and max(aucs["logistic"], 0.6) < min(aucs["xgboost"], aucs["lightgbm"])


def test_folds_and_reload(spark, matrix):
    features = matrix.drop("is_test", "fold")
    model = claim_models.train_claim(features, "lightgbm", "y", "key", COLUMNS, rounds=10, folds=3)
    assert model.metrics["cv_auc_mean"] > 0.8 and 0 <= model.metrics["cv_auc_std"] < 0.1
    path = new_stage_path(spark, "booster")
    model.save(path)
    again = claim_models.ClaimModel.load("lightgbm", path)
    before, after = (m.predict(features).select("key", "probability").orderBy("key").collect() for m in (model, again))
    assert before == after
    ranked = model.feature_importance(spark, COLUMNS).collect()
    assert {r["feature"] for r in ranked[:2]} == {"a", "b"} and sum(r["importance"] for r in ranked) == pytest.approx(1)


def test_nulls_one_class_and_no_rows(spark, matrix):
    holes = matrix.withColumn("a", F.when(F.col("key") > "K0500", F.col("a"))).withColumn("b", F.when(F.col("key") > "K0300", F.col("b")).otherwise(float("nan")))
    model = PipelineModel([boosting.train(boosting.bin_matrix(holes, COLUMNS, "y"), [DEEP])[0].model("y")])
    assert with_probability(model, holes).where("probability > 0 AND probability < 1").count() == 900
    ones = boosting.train(boosting.bin_matrix(matrix.where("y = 1"), COLUMNS, "y"), [LEAVES])[0]
    assert all(len(t.feature) == 1 for t in ones.trees)
    nothing = boosting.train(boosting.bin_matrix(matrix.limit(0), COLUMNS, "y"), [LEAVES])[0]
    assert nothing.trees == [] and with_probability(nothing.model("y"), matrix.limit(3)).select("probability").distinct().collect()[0][0] == 0.5


def test_a_scan_goes_down_only_to_the_nodes_it_asks_for():
    """Rows in blocks of a column each: every row ends where its values lead, and unasked subtrees are not entered."""
    tree = tuple(np.array(a) for a in ([0, 1, -1, -1, -1], [3, 2, 0, 0, 0], [1, 3, 0, 0, 0], [2, 4, 0, 0, 0]))
    bins = np.array([[0, 5, 3, 1, 9], [2, 0, 3, 7, 1]], np.uint8)
    every = {node: rows.tolist() for node, rows in boosting._rows_at(tree, bins, np.arange(5))}
    assert every == {2: [1, 4], 3: [0], 4: [2, 3]}
    needed = boosting._on_the_way(tree, [4])
    assert needed.tolist() == [True, True, False, False, True]
    assert [(n, r.tolist()) for n, r in boosting._rows_at(tree, bins, np.arange(5), needed)] == [(4, [2, 3])]


def test_cached_blocks_are_large():
    """Stored blocks of at most 4,096 rows are scanned in blocks of up to 65,536."""
    def block(n, start):
        return boosting._Block(np.full((2, n), start, np.uint8), np.ones(n, np.uint8), np.zeros((n, 1), np.int32), np.full((1, n), float(start)))

    made = list(boosting._in_large_blocks(iter([block(4096, i) for i in range(17)])))
    assert [len(b.label) for b in made] == [65536, 4096]
    assert made[0].margins[0, ::4096].tolist() == list(range(16)) and made[1].bins[0, 0] == 16


@pytest.mark.parametrize("rules", [DEEP, LEAVES, replace(LEAVES, left_out=("fold", 1))])
def test_scans_of_a_dealt_matrix_equal_plain_growth(spark, matrix, rows, rules, monkeypatch):
    """The same trees where the matrix is too large for one task."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    monkeypatch.setattr(boosting, "FEW", 100)
    test_trees_equal_plain_growth(spark, matrix, rows, rules, monkeypatch)


def test_a_small_matrix_is_trained_in_one_job(spark, matrix):
    """Six models of twenty trees start one job, not one for every scan."""
    binned = boosting.bin_matrix(matrix, COLUMNS, "y")
    rules = [replace(LEAVES, rounds=20, left_out=left_out) for left_out in (("is_test", 1), ("fold", 0), ("fold", 1), ("fold", 2))]
    rules += [replace(DEEP, rounds=20), replace(DEEP, rounds=20, left_out=("fold", 5))]
    context = spark.sparkContext
    context.setJobGroup("boosting", "six models")
    try:
        found = boosting.train(binned, rules)
        assert len(context.statusTracker().getJobIdsForGroup("boosting")) == 1
    finally:
        context._jsc.clearJobGroup()
    assert [len(b.trees) for b in found] == [20] * 6


def test_packed_columns_are_counted_as_they_are_one_by_one(monkeypatch):
    """Columns of 1 to 256 bins share words; sums by word give those of every column, for many rows and for few."""
    rng = np.random.default_rng(3)
    widths = [64, 1, 2, 60, 3, 256, 17, 2]
    layout = boosting._Layout.of([tuple(range(n - 1)) for n in widths])
    bins = np.stack([rng.integers(0, n, 5000) for n in widths]).astype(np.uint8)
    words = layout.words(bins)
    every, packed = np.arange(5000, dtype=np.int32), boosting._Words(words, layout)
    assert all((packed[c][every] == bins[c]).all() for c in range(len(widths))) and len(words) < len(widths)
    values = rng.random((2, 5000))
    parts = [every, every[::3], every[:10], every[:0]]
    got = boosting._sums_of(words, layout, parts, lambda rows: (values[0][rows], values[1][rows]))
    for rows, sums in zip(parts, got, strict=True):
        want = np.concatenate([
            np.stack([np.bincount(bins[c][rows], v, n) for v in (values[0][rows], values[1][rows], None)], axis=1) for c, n in enumerate(widths)
        ])
        assert np.allclose(sums, want)


@pytest.mark.parametrize("local_rows", [0, 1000])
def test_squares_equal_sparks_boosted_trees(matrix, monkeypatch, local_rows):
    """Least-squares boosting gives the probabilities of Spark's, weights included."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
    rules = Growth(rounds=5, step=0.2, max_depth=3, l2=0.0, min_hessian=0.0, positive_weight=19.0, loss="squares", bins=32)
    ours = boosting.train(boosting.bin_matrix(matrix, COLUMNS, "y", rules.bins), [rules])[0].model("y")
    assembled = VectorAssembler(inputCols=list(COLUMNS), outputCol="features").transform(matrix.withColumn("w", F.when(F.col("y") == 1, 19.0).otherwise(1.0)))
    spark_model = GBTClassifier(labelCol="y", weightCol="w", maxIter=5, maxDepth=3, stepSize=0.2, seed=1).fit(assembled)
    got, want = (
        [r["probability"] for r in out.orderBy("key").collect()]
        for out in (with_probability(ours, matrix), with_probability(spark_model, assembled))
    )
    assert np.abs(np.array(got) - np.array(want)).max() < 1e-9 and len(set(got)) > 10
    assert ours.featureImportances == pytest.approx(spark_model.featureImportances.toArray().tolist())


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_jobs_of_the_gbm_and_fraud_classifiers_do_not_grow_with_the_rounds(spark, matrix):
    features = matrix.drop("is_test", "fold").withColumnRenamed("key", "claim_id")
    for name, train in (
        ("gbm", lambda n: claim_models.train_claim(features, "gbm", "y", "claim_id", COLUMNS, rounds=n)),
        ("fraud", lambda n: fraud_models.train_fraud_supervised(features, COLUMNS, "y", rounds=n)),
    ):
        few, many = (_jobs(spark, f"{name}-{n}", lambda n=n: train(n)) for n in (2, 20))
        assert few == many, name


def test_gbm_refuses_what_sparks_trees_refuse(matrix):
    features = matrix.drop("is_test", "fold")
    gaps = features.withColumn("a", F.when(F.col("key") > "K0500", F.col("a")))
    for bad, said in ((gaps, "null or NaN in a"), (features.withColumn("y", F.col("y") + 1), "0 or 1"), (features.limit(0), "rows")):
        with pytest.raises(ValueError, match=said):
            claim_models.train_claim(bad, "gbm", "y", "key", COLUMNS, rounds=2)
