"""Every registered query that has SQL gives exactly the same rows as that SQL on whole tables."""

from __future__ import annotations

import os

import pytest

from verification.harness import connect, differences, oracle_rows, spark_rows
from verification.load import REGISTRY

# Full trainings of hundreds of trees, minutes each: `python -m verification.check` runs them, the suite on TEST_ALL=1.
LONG = {
    "fraud_model_scores", "full_job_claim_lightgbm", "full_job_claim_logistic", "full_job_claim_rf", "full_job_claim_xgboost",
    "full_job_fraud", "gbm_risk_scores", "lake_job_trends", "lake_model_predictions", "lightgbm_risk_scores",
    "rf_risk_scores", "streamed_fraud_scores", "xgboost_risk_scores",
}
WITH_SQL = sorted(name for name, (_, sql) in REGISTRY.items() if sql and (name not in LONG or os.environ.get("TEST_ALL")))


@pytest.fixture(scope="module")
def db(base):
    return connect(base)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, db, base, name):
    run, sql = REGISTRY[name]
    assert differences(spark_rows(run(spark, base)), oracle_rows(db, sql)) == []


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
