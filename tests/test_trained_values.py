"""Trained models against an independent statement of what was trained."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators import fraud
from claimlens.operators.claim_features import FEATURES
from claimlens.operators.ranking import stratified_split
from claimlens.plans import claim_models
from claimlens.session import new_stage_path

PATHS = """
WITH RECURSIVE reached AS (
  SELECT claim_id, x, tree, 1 AS node FROM points, trees
  UNION ALL
  SELECT claim_id, x, tree, CASE WHEN x[feature[node] + 1] <= threshold[node] THEN "left"[node] ELSE "right"[node] END + 1
  FROM reached JOIN trees USING (tree) WHERE feature[node] >= 0
)
SELECT claim_id, SUM(depth[node]) AS total FROM reached JOIN trees USING (tree) WHERE feature[node] < 0 GROUP BY claim_id
"""


def test_forest_scores_follow_the_stored_trees(spark, ready):
    columns = list(C.FRAUD_FEATURES)
    model = fraud.fit_forest(ready.fraud_features, columns, trees=7, sample=64)
    path = new_stage_path(spark, "forest")
    model.save_to(spark, path)
    rows = model.score(ready.fraud_features.select("claim_id", *columns)).toPandas()
    db = duckdb.connect()
    db.register("scored", rows)
    db.execute(f"CREATE TABLE points AS SELECT claim_id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in columns)}] AS x FROM scored")
    db.execute(f"CREATE TABLE trees AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/trees/*.parquet')")
    total = dict(db.execute(PATHS).fetchall())
    assert len(total) == len(rows)
    expected = 2 * (np.log(63) + np.euler_gamma) - 2 * 63 / 64  # mean path among 64 points
    want = -np.exp2(-np.array([total[c] for c in rows["claim_id"]]) / (7 * expected))
    assert np.allclose(rows["sample_score"], want, atol=1e-12)
    below = (rows["sample_score"] < model.offset).mean()
    assert abs(below - C.CONTAMINATION) < 0.01
    assert np.allclose([model.train_min, model.train_max], [want.min() - model.offset, want.max() - model.offset])


def test_forest_nodes_split_their_own_sample(spark, ready):
    for tree in fraud.fit_forest(ready.fraud_features, list(C.FRAUD_FEATURES), trees=7, sample=64).trees:
        inner = [i for i, f in enumerate(tree["feature"]) if f >= 0]
        children = sorted(c for i in inner for c in (tree["left"][i], tree["right"][i]))
        assert children == list(range(1, len(tree["feature"])))  # every node but the root has one parent
        assert tree["size"] == 64 and len(tree["feature"]) == 2 * len(inner) + 1


def test_logistic_gradient_vanishes(ready):
    """Weighted gradient plus penalty is zero at the coefficients of all twenty columns."""
    model = claim_models.train_claim(ready.claim_features, "logistic")
    train = stratified_split(ready.claim_features, "claim_approved", "claim_id").where("is_test = 0").toPandas()
    x, y = train[list(FEATURES)].to_numpy(float), train["claim_approved"].to_numpy(float)
    fitted = model.model.stages[-1]
    beta = fitted.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + fitted.intercept)))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    gradient = np.append(x.T @ (weight * (p - y)) + beta, (weight * (p - y)).sum()) / len(y)
    flat = np.append(x.T @ (weight * (0.5 - y)), (weight * (0.5 - y)).sum()) / len(y)
    assert np.abs(gradient).max() < 1e-3 < np.abs(flat).max()


@pytest.mark.parametrize("family", claim_models.ALL_FAMILIES)
def test_families_learn_what_can_be_learnt(ready, family):
    """A constant model has an AUC of 0.5 here."""
    rows = ready.claim_features.withColumn("costly", (F.col("claim_amount") + F.col("num_procedures") > 0.5).cast("int"))
    model = claim_models.train_claim(rows, family, "costly", rounds=None if family == "logistic" else 5)
    assert model.metrics["auc_roc"] > 0.95
