"""Claim feature matrix: 15 numeric and 5 categorical columns, keyed by claim."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions import scalars as S
from claimlens.operators.quantiles import quantile
from claimlens.operators.transforms import (
    LabelIndexer,
    LabelIndexerModel,
    MedianImputer,
    MedianImputerModel,
    StateModel,
    ZScaler,
    ZScalerModel,
)

FEATURES = (*C.CLAIM_NUMERIC, *C.CLAIM_CATEGORICAL)


def base_features(claims: DataFrame, threshold: float | None) -> DataFrame:
    """Add the engineered columns; ``threshold`` is the amount above which a claim is high-cost."""
    col = F.col
    high = S.above_flag(col("claim_amount"), threshold) if threshold is not None else F.lit(0)
    return (
        claims.withColumns(
            {
                "claim_per_procedure": col("claim_amount") / S.at_least_one(col("num_procedures")),
                "risk_score_age": S.age_risk(col("member_age")),
                "risk_score_bmi": S.bmi_risk(col("member_bmi")),
                "high_cost_flag": high,
                "inpatient_flag": S.category_flag(col("claim_type"), "Inpatient"),
                "emergency_flag": S.category_flag(col("claim_type"), "Emergency"),
            }
        )
        .withColumn(
            "composite_risk",
            S.composite_risk(
                col("risk_score_age"),
                col("risk_score_bmi"),
                col("num_chronic"),
                col("member_smoker"),
                col("high_cost_flag"),
            ),
        )
    )


def high_cost_threshold(claims: DataFrame, approx: bool = False) -> float | None:
    return quantile(claims, "claim_amount", C.HIGH_COST_QUANTILE, approx)


def lake_features(claims: DataFrame, threshold: float = C.HIGH_COST_AMOUNT) -> DataFrame:
    """Feature columns of the lake job: fixed amount threshold, unclipped risk, nulls filled last."""
    return (
        claims.withColumns(
            {
                "claim_approved": S.approved_label(F.col("claim_status")),
                "high_cost_flag": S.above_flag(F.col("claim_amount"), float(threshold)),
            }
        )
        .withColumn(
            "composite_risk",
            S.composite_risk_v2(
                F.col("age"), F.col("num_chronic_conditions"), F.col("smoker"), F.col("high_cost_flag")
            ),
        )
        .fillna({"bmi": 25.0, "num_chronic_conditions": 0})
    )


class ClaimFeaturesModel(StateModel):
    """Fitted claim features; the high-cost threshold and all statistics come from the fit."""

    def transform_batch(self, claims: DataFrame, threshold: float | None) -> DataFrame:
        state = self.fitted
        label = []
        base = base_features(claims, threshold)
        if "claim_status" in claims.columns:
            base = base.withColumn("claim_approved", S.approved_label(F.col("claim_status")))
            label = ["claim_approved"]
        carried = [c for c in ("claim_id", "member_id") if c in claims.columns]
        out = base.select(*carried, *[F.col(c) for c in FEATURES], *label)
        out = MedianImputerModel(state["medians"]).transform(out)
        out = LabelIndexerModel(state["classes"]).transform(out)
        return ZScalerModel(state["scale"]).transform(out)

    def _transform(self, claims: DataFrame) -> DataFrame:
        return self.transform_batch(claims, self.fitted["threshold"])

    def transform_with_batch_threshold(self, claims: DataFrame) -> DataFrame:
        """Recompute the high-cost threshold on the rows at hand, as a batch scorer without memory would."""
        return self.transform_batch(claims, high_cost_threshold(claims))


class ClaimFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Impute medians, index categories, standardise; needs enriched claims."""

    approx = Param(Params._dummy(), "approx", "sketch quantiles instead of exact ones", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, approx=False):
        super().__init__()
        self._set(approx=approx)

    def _fit(self, claims: DataFrame) -> ClaimFeaturesModel:
        approx = self.getOrDefault(self.approx)
        threshold = high_cost_threshold(claims, approx)
        frame = base_features(claims, threshold).select(*FEATURES)
        imputer = MedianImputer(columns=C.CLAIM_NUMERIC, approx=approx).fit(frame)
        indexer = LabelIndexer(columns=C.CLAIM_CATEGORICAL).fit(frame)
        scaler = ZScaler(columns=FEATURES).fit(indexer.transform(imputer.transform(frame)))
        return ClaimFeaturesModel(
            {
                "threshold": threshold,
                "medians": imputer.fitted,
                "classes": indexer.fitted,
                "scale": scaler.fitted,
            }
        )
