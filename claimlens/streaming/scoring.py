"""Structured Streaming jobs over requests, with the same functions as the batch jobs.

Every job writes one folder per micro-batch in overwrite mode, so a batch that is replayed after a
failure replaces its own output.  Features use fitted values only, never the micro-batch's own
statistics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimlens.functions.scalars import request_claim_id
from claimlens.operators import columns, quality
from claimlens.operators.claim_features import ClaimFeaturesModel
from claimlens.operators.fraud_features import FraudFeaturesModel
from claimlens.operators.notes import analyze_notes
from claimlens.operators.recommend import HybridRecommender, recommendation_records
from claimlens.plans.claim_models import ClaimModel
from claimlens.plans.fraud_models import FraudModel
from claimlens.session import staging


def _per_batch(
    stream: DataFrame, handle: Callable[[DataFrame], dict[str, DataFrame]], out: str, checkpoint: str
) -> StreamingQuery:
    """Run ``handle`` on each micro-batch and write its named results below ``out``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            with staging(batch.sparkSession):  # what a batch stages goes with it
                for name, df in handle(batch).items():
                    df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_claims(requests: DataFrame, features: ClaimFeaturesModel, model: ClaimModel) -> dict[str, DataFrame]:
    """``scored`` risk rows of valid requests, ``quarantine`` rows with the rules they break.

    Requests without a claim id get one made of their own values.
    """
    filled = columns.with_defaults(requests, columns.CLAIM_REQUEST_DEFAULTS, fill_nulls=True)
    if "claim_id" not in filled.columns:
        values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in requests.columns]
        filled = filled.withColumn("claim_id", request_claim_id(*values))
    ok, bad = quality.validate(filled, quality.CLAIM_REQUEST)
    return {"scored": model.risk_score(features.transform(ok)), "quarantine": bad}


def score_batch(
    requests: DataFrame, features: ClaimFeaturesModel, model: ClaimModel
) -> tuple[DataFrame, DataFrame]:
    """Scores of a whole table of requests, and one row of totals: total, approved and review."""
    results = score_claims(requests, features, model)["scored"]
    totals = results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("decision") == "Approve").alias("approved"),
        F.count_if(F.col("decision") == "Review").alias("review"),
    )
    return results, totals


def stream_claims(
    requests: DataFrame, features: ClaimFeaturesModel, model: ClaimModel, out: str, checkpoint: str
) -> StreamingQuery:
    return _per_batch(requests, lambda batch: score_claims(batch, features, model), out, checkpoint)


def score_fraud(requests: DataFrame, features: FraudFeaturesModel, model: FraudModel) -> dict[str, DataFrame]:
    """``scored`` fraud rows from stored statistics and the training score range."""
    ok, bad = quality.validate(requests, quality.FRAUD_REQUEST)
    return {"scored": model.predict(features.transform_requests(ok), batch_range=False), "quarantine": bad}


def stream_fraud(
    requests: DataFrame, features: FraudFeaturesModel, model: FraudModel, out: str, checkpoint: str
) -> StreamingQuery:
    return _per_batch(requests, lambda batch: score_fraud(batch, features, model), out, checkpoint)


def analyze_requests(requests: DataFrame) -> dict[str, DataFrame]:
    """``analysed`` notes of valid requests, ``quarantine`` rows with the rules they break."""
    filled = columns.with_defaults(requests, columns.NOTE_REQUEST_DEFAULTS, fill_nulls=True)
    ok, bad = quality.validate(filled, quality.NOTE_REQUEST)
    return {"analysed": analyze_notes(ok), "quarantine": bad}


def stream_notes(requests: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return _per_batch(requests, analyze_requests, out, checkpoint)


def recommend_requests(requests: DataFrame, recommender: HybridRecommender, n: int = 3) -> dict[str, DataFrame]:
    filled = columns.with_defaults(requests, columns.PLAN_REQUEST_DEFAULTS, fill_nulls=True)
    ok, bad = quality.validate(filled, quality.PLAN_REQUEST)
    return {"recommended": recommendation_records(recommender.answers(ok, n), ok), "quarantine": bad}


def stream_recommendations(
    requests: DataFrame, recommender: HybridRecommender, out: str, checkpoint: str, n: int = 3
) -> StreamingQuery:
    return _per_batch(requests, lambda batch: recommend_requests(batch, recommender, n), out, checkpoint)
