"""The forest against counting by hand, and the number of jobs it takes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import boosting, forest
from claimlens.operators.forest import Bagging
from claimlens.plans import claim_models


@pytest.fixture(scope="module")
def rows(spark):
    x = F.col("id")
    return spark.range(3000).select(
        x.alias("k"), (x % 7).cast("double").alias("a"), (x * 13 % 11).cast("double").alias("b"),
        ((x % 7 > 3) & (x % 5 > 0)).cast("int").alias("y"),
    ).repartition(3)


def _gini(y, w):
    a, b = (y == 0).sum() * w[0], (y == 1).sum() * w[1]
    return 2 * a * b / (a + b) if a + b else 0.0


def test_root_split_and_leaves_of_one_tree_are_the_best(rows):
    data = rows.toPandas()
    grown = forest.train(boosting.bin_matrix(rows, ["a", "b"], "y", forest.MAX_BINS), [Bagging(trees=1, max_depth=1)])[0]
    y, w = data["y"].to_numpy(), len(data) / (2 * np.bincount(data["y"]))
    gains = {
        (i, v): _gini(y, w) - _gini(y[data[c] <= v], w) - _gini(y[data[c] > v], w)
        for i, c in enumerate(("a", "b")) for v in sorted(data[c].unique())[:-1]
    }
    column, value = max(gains, key=gains.get)
    tree = grown.trees[0]
    assert (tree.feature[0], grown.edges[column][tree.cut[0]]) == (column, value)
    left = y[data[("a", "b")[column]] <= value]
    assert tree.share[1] == pytest.approx((left == 1).sum() * w[1] / ((left == 0).sum() * w[0] + (left == 1).sum() * w[1]))


def test_a_saved_forest_scores_alike_and_learns(spark, rows, tmp_path):
    model = claim_models.train_claim(rows, "rf", "y", "k", ["a", "b"], rounds=20)
    assert model.metrics["auc_roc"] > 0.8
    model.save(str(tmp_path))
    again = claim_models.ClaimModel.load("rf", str(tmp_path))
    both = model.predict(rows).join(again.predict(rows).select("k", F.col("probability").alias("p")), "k")
    assert both.where("p <> probability").count() == 0
    assert both.where("probability < 0 OR probability > 1").count() == 0


def test_draws_are_poisson_and_the_same_again():
    drawn = forest._drawn(Bagging(), 3, 5, 60_000)
    assert (drawn == forest._drawn(Bagging(), 3, 5, 60_000)).all()
    assert drawn.mean() == pytest.approx(1, abs=0.03) and drawn.var() == pytest.approx(1, abs=0.05)


def test_many_forests_take_as_many_jobs_as_one(spark, rows):
    """Spark's own forests took at least a job per level and fold."""
    folded = rows.withColumn("fold", (F.col("k") % 5).cast("int"))
    binned = boosting.bin_matrix(folded, ["a", "b"], "y", forest.MAX_BINS)
    context = spark.sparkContext

    def jobs(rules):
        context.setJobGroup(f"forest-{len(rules)}", "")
        found = forest.train(binned, rules)
        return found, len(context.statusTracker().getJobIdsForGroup(f"forest-{len(rules)}"))

    try:
        one, n_one = jobs([Bagging(trees=4, max_depth=3, left_out=("fold", 0))])
        five, n_five = jobs([Bagging(trees=4, max_depth=3, left_out=("fold", i)) for i in range(5)])
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert n_five <= n_one + 4
    for a, b in zip(one[0].trees, five[0].trees, strict=True):
        assert (a.feature == b.feature).all() and (a.share == b.share).all()


def test_a_gap_is_refused(rows):
    with pytest.raises(ValueError, match="null or NaN in a"):
        claim_models.train_claim(rows.withColumn("a", F.when(F.col("k") > 5, F.col("a"))), "rf", "y", "k", ["a", "b"], rounds=2)
