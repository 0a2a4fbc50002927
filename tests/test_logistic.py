"""Logistic models: the optimum, all folds in one scan per step, and what is refused."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from claimlens.operators import logistic
from claimlens.plans import claim_models
from claimlens.session import stage

COLUMNS = ("a", "b", "c")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3)) * [1.0, 5.0, 0.2]
    p = 1 / (1 + np.exp(-(0.7 * x[:, 0] - 0.2 * x[:, 1] + x[:, 2] - 1)))
    y = (rng.random(len(p)) < p).astype(int)
    data = [(f"K{i}", *map(float, r), int(v), i % 5, int(i % 5 == 0)) for i, (r, v) in enumerate(zip(x, y))]
    return stage(spark.createDataFrame(data, "claim_id string, a double, b double, c double, y int, fold int, is_test int"), "logistic-rows")


def test_coefficients_are_sparks(rows):
    fits = [logistic.Fit(0.01, (1.0, 3.0), ("fold", 2)), logistic.Fit(0.0005, (1.0, 1.0))]
    found = logistic.train(rows, COLUMNS, "y", fits)
    for fit, model in zip(fits, found):
        seen = rows if fit.left_out is None else rows.where(F.col("fold") != 2)
        weighted = seen.withColumn("weight", F.when(F.col("y") == 1, fit.weights[1]).otherwise(fit.weights[0]))
        spark_fit = LogisticRegression(
            labelCol="y", weightCol="weight", regParam=fit.penalty, standardization=False, maxIter=1000, tol=1e-12
        ).fit(VectorAssembler(inputCols=list(COLUMNS), outputCol="features").transform(weighted))
        assert np.allclose(model.coefficients.toArray(), spark_fit.coefficients.toArray(), atol=1e-6)
        assert abs(model.intercept - spark_fit.intercept) < 1e-6


def test_cross_validation_takes_a_scan_per_step(spark, rows):
    """Spark's classifier started a job or two per step and fold: hundreds."""
    context = spark.sparkContext
    context.setJobGroup("logistic-folds", "logistic-folds")
    try:
        mean, deviation = claim_models.cross_validate(rows.drop("fold"), "logistic", "y", "claim_id", COLUMNS)
        jobs = context.statusTracker().getJobIdsForGroup("logistic-folds")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0.7 < mean < 0.95 and deviation < 0.1
    assert len(jobs) < 120


def test_folds_of_one_class_and_separable_rows(spark):
    data = [(float(i), int(i >= 20), int(i >= 20)) for i in range(40)]
    rows = stage(spark.createDataFrame(data, "a double, y int, fold int"), "separable")
    one_class, separable = logistic.train(rows, ["a"], "y", [logistic.Fit(0.1, (1.0, 1.0), ("fold", 1)), logistic.Fit(1e-6, (1.0, 1.0))])
    assert one_class.intercept == -np.inf and one_class.coefficients.toArray().tolist() == [0.0]
    p = [r["p"] for r in rows.orderBy("a").select(separable.probability().alias("p")).collect()]
    assert max(p[:20]) < 0.01 and min(p[20:]) > 0.99


def test_gaps_and_other_labels_are_refused(spark, rows):
    with pytest.raises(ValueError, match="null or NaN in b"):
        claim_models.train_claim(rows.drop("fold", "is_test").withColumn("b", F.when(F.col("a") > 0, F.col("b"))), "logistic", "y", columns=COLUMNS)
    with pytest.raises(ValueError, match="0 or 1"):
        claim_models.train_claim(rows.drop("fold", "is_test").withColumn("y", F.col("y") + 1), "logistic", "y", columns=COLUMNS)
    model = claim_models.train_claim(rows.drop("fold", "is_test"), "logistic", "y", columns=COLUMNS)
    with pytest.raises(Exception, match="null or NaN in a"):
        model.predict(rows.withColumn("a", F.lit(None).cast("double"))).collect()
