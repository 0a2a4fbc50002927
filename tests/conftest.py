from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimlens import fixtures as fx  # noqa: E402
from claimlens.operators import joins  # noqa: E402
from claimlens.plans import jobs  # noqa: E402
from claimlens.session import build_session, stage  # noqa: E402

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "claimlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": "/tmp/claimlens-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def base():
    return BASE


@pytest.fixture(scope="session")
def members(spark):
    return stage(fx.members(spark, BASE), "test-members")


@pytest.fixture(scope="session")
def claims(spark):
    return stage(fx.claims(spark, BASE), "test-claims")


@pytest.fixture(scope="session")
def ready(claims, members):
    return jobs.preprocess_all({"claims": claims, "members": members})


@pytest.fixture(scope="session")
def enriched(claims, members):
    return stage(joins.enrich_claims(claims, members), "test-enriched")
