"""Column repair: rename, default, fill; plus the plain projections around predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C


def normalise_columns(df: DataFrame, names: Mapping[str, str] = C.MEMBER_COLUMN_NAMES) -> DataFrame:
    """Rename each column that exists under its old name and not yet under its new one."""
    have = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in have and new not in have})


def with_defaults(df: DataFrame, defaults: Mapping[str, object], fill_nulls: bool = False) -> DataFrame:
    """Add absent columns as constants; with ``fill_nulls`` also replace nulls of present ones."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        if name not in have:
            new[name] = default
        elif fill_nulls:
            new[name] = F.coalesce(F.col(name), default.cast(df.schema[name].dataType))
    return df.withColumns(new) if new else df


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    have = set(df.columns)
    return df.fillna({name: value for name, value in values.items() if name in have})


# Defaults a stored row gets when a column is left out
MEMBER_INSERT_DEFAULTS = {"smoker": 0, "tenure_months": 0, "num_chronic_conditions": 0}
PROVIDER_INSERT_DEFAULTS = {"total_claims": 0, "fraud_rate": 0.0}
CLAIM_INSERT_DEFAULTS = {
    "approved_amount": 0.0, "days_in_hospital": 0, "num_procedures": 1, "prior_auth": 0, "is_fraud": 0,
}

# Defaults of optional request fields
CLAIM_REQUEST_DEFAULTS = {
    "num_procedures": 1, "days_in_hospital": 0, "prior_auth": 0, "member_smoker": 0,
    "member_plan": "Silver", "num_chronic": 0, "state": "CA",
}
PLAN_REQUEST_DEFAULTS = {
    "num_chronic_conditions": 0, "tenure_months": 12, "annual_premium": 5000.0, "deductible": 1000,
    "income_score": 0.5,
}
NOTE_REQUEST_DEFAULTS = {"note_id": "NOTE000001"}


def default_stats(df: DataFrame) -> DataFrame:
    """Fill the aggregates a fraud request may leave out, from its own amount where needed."""
    amount = F.col("claim_amount")
    return with_defaults(
        df,
        {
            "provider_avg_claim": amount,
            "provider_claim_count": F.lit(100),
            "provider_unique_members": F.lit(80),
            "member_claim_count": F.lit(5),
            "member_avg_claim": amount * 0.6,
            "member_total_spend": amount * 3,
        },
        fill_nulls=True,
    )


def head_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows in key order (top-k per partition, then merged; no full sort)."""
    return df.orderBy(*keys).limit(n)


def prediction_view(scored: DataFrame) -> DataFrame:
    """Rows of the prediction table from a transformed frame."""
    return scored.select(
        "claim_id",
        "member_id",
        vector_to_array("probability")[1].alias("approval_probability"),
        F.col("prediction").cast("int").alias("predicted_approved"),
        F.current_timestamp().alias("predicted_at"),
    )
