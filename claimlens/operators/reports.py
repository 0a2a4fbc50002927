"""Standing reports over claims, providers and members."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions import scalars as S


def claim_summary(claims: DataFrame) -> DataFrame:
    """Counts and amounts by month, type and status."""
    return claims.groupBy(S.month(F.col("claim_date")).alias("month"), "claim_type", "claim_status").agg(
        F.count("*").alias("num_claims"),
        F.sum("claim_amount").alias("total_claimed"),
        F.sum("approved_amount").alias("total_approved"),
        F.avg("claim_amount").alias("avg_claim"),
        F.sum(F.col("is_fraud").cast("int")).alias("fraud_count"),
    )


def provider_fraud_risk(providers: DataFrame, claims: DataFrame) -> DataFrame:
    """Fraud rate of every provider, with or without claims.

    Claims are aggregated per provider before the join, so the join sees one row per provider and a
    hot provider is combined map-side.  A provider without claims has total 0 and null sums.
    """
    per_provider = (
        claims.where(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            F.count("claim_id").alias("total_claims"),
            F.avg("claim_amount").alias("avg_claim_amount"),
            F.sum(F.col("is_fraud").cast("int")).alias("fraud_claims"),
            F.count("*").alias("_rows"),
        )
    )
    return providers.join(per_provider, "provider_id", "left").select(
        "provider_id",
        "provider_name",
        "provider_type",
        "state",
        F.coalesce("total_claims", F.lit(0)).alias("total_claims"),
        "avg_claim_amount",
        "fraud_claims",
        S.percent(F.col("fraud_claims"), F.coalesce("_rows", F.lit(1))).alias("fraud_rate_pct"),
    )


def latest_prediction(predictions: DataFrame, version: str = "model_version") -> DataFrame:
    """The row of the highest version per claim, combined map-side."""
    rest = [c for c in predictions.columns if c != "claim_id"]
    latest = F.max(F.struct(version, *[c for c in rest if c != version])).alias("_latest")
    return predictions.groupBy("claim_id").agg(latest).select(
        "claim_id", *[F.col(f"_latest.{c}").alias(c) for c in rest]
    )


def _per_claim(predictions: DataFrame, score: str, prefix: str) -> DataFrame:
    return predictions.groupBy("claim_id").agg(
        F.count("*").alias(f"{prefix}_rows"),
        F.count(score).alias(f"{prefix}_scored"),
        F.sum(score).alias(f"{prefix}_sum"),
    )


def member_risk_profile(
    members: DataFrame,
    claims: DataFrame,
    claim_predictions: DataFrame,
    fraud_predictions: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """Claims, spend and mean scores per member.

    By default a claim scored several times counts once per pair of predictions, as three chained
    left joins would have it; the pairs are never built, their number weights the sums instead.
    ``dedupe=True`` keeps only the latest prediction of each kind.
    """
    if dedupe:
        claim_predictions = latest_prediction(claim_predictions)
        fraud_predictions = latest_prediction(fraud_predictions)
    scored = claims.join(_per_claim(claim_predictions, "risk_score", "cp"), "claim_id", "left").join(
        _per_claim(fraud_predictions, "anomaly_score", "fp"), "claim_id", "left"
    )
    cp_rows = F.coalesce("cp_rows", F.lit(1))
    fp_rows = F.coalesce("fp_rows", F.lit(1))
    per_member = (
        scored.where(F.col("member_id").isNotNull())
        .groupBy("member_id")
        .agg(
            F.sum(cp_rows * fp_rows).alias("_claims"),
            F.sum(F.col("claim_amount") * cp_rows * fp_rows).alias("lifetime_spend"),
            F.sum(F.col("cp_sum") * fp_rows).alias("_risk"),
            F.sum(F.col("cp_scored") * fp_rows).alias("_risk_n"),
            F.sum(F.col("fp_sum") * cp_rows).alias("_anomaly"),
            F.sum(F.col("fp_scored") * cp_rows).alias("_anomaly_n"),
        )
    )
    return members.join(per_member, "member_id", "left").select(
        "member_id",
        "age",
        "plan_type",
        "num_chronic_conditions",
        F.coalesce("_claims", F.lit(0)).alias("total_claims"),
        "lifetime_spend",
        (F.col("_risk") / F.nullif("_risk_n", F.lit(0))).alias("avg_risk_score"),
        (F.col("_anomaly") / F.nullif("_anomaly_n", F.lit(0))).alias("avg_anomaly_score"),
    )


def monthly_trend(claims: DataFrame) -> DataFrame:
    """Counts and amounts by month and type, newest month first."""
    return (
        claims.groupBy(S.month(F.col("claim_date")).alias("month"), "claim_type")
        .agg(
            F.count("*").alias("num_claims"),
            F.sum("claim_amount").alias("total_amount"),
            F.avg("claim_amount").alias("avg_amount"),
            F.sum(F.col("is_fraud").cast("int")).alias("fraud_count"),
        )
        .orderBy(F.desc("month"), "claim_type")
    )


def provider_risk_top(claims: DataFrame, n: int = 50) -> DataFrame:
    """Providers with the highest fraud rate; ties go to the lower provider id."""
    return (
        claims.groupBy("provider_id")
        .agg(
            F.count("*").alias("total_claims"),
            F.avg("claim_amount").alias("avg_claim"),
            F.sum(F.col("is_fraud").cast("int")).alias("fraud_claims"),
        )
        .withColumn("fraud_rate_pct", S.percent(F.col("fraud_claims"), F.col("total_claims")))
        .orderBy(F.desc("fraud_rate_pct"), F.asc_nulls_first("provider_id"))
        .limit(n)
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def dataset_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: size of each table, fraud rate and approval rate."""
    claims = tables["claims"].agg(
        F.count("*").alias("n_claims"),
        F.avg(F.col("is_fraud").cast("int")).alias("fraud_rate"),
        F.avg((F.col("claim_status") == "Approved").cast("int")).alias("approval_rate"),
    )
    others = {
        f"n_{name}": df.agg(F.count("*")).scalar() for name, df in tables.items() if name != "claims"
    }
    return claims.withColumns(others)


def label_rates(claims: DataFrame) -> DataFrame:
    return claims.agg(
        F.count("*").alias("n_claims"),
        F.avg(S.approved_label(F.col("claim_status"))).alias("approval_rate"),
        F.avg("is_fraud").alias("fraud_rate"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, null left out, in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def decision_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("decision") == "Approve").alias("approved"),
        F.count_if(F.col("decision") == "Review").alias("review"),
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.sum("is_anomaly").alias("n_anomalies"), F.avg("is_anomaly").alias("anomaly_rate")
    )


def interactions(members: DataFrame) -> DataFrame:
    """Enrolments as implicit ratings; repeats add up and a missing rating counts as 1."""
    rating = F.coalesce("rating", F.lit(1)) if "rating" in members.columns else F.lit(1)
    return members.groupBy("member_id", "plan_type").agg(F.sum(rating).alias("rating"))
