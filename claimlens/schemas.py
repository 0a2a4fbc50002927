"""Declared schemas of every table; no source infers its columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _D, _DATE, _TS = (
    T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampType(),
)

MEMBERS = _struct(
    ("member_id", _S), ("age", _I), ("gender", _S), ("state", _S), ("bmi", _D), ("smoker", _I),
    ("plan_type", _S), ("tenure_months", _I), ("num_chronic_conditions", _I),
    ("primary_diagnosis", _S), ("annual_premium", _D), ("deductible", _D), ("member_since", _DATE),
)

PROVIDERS = _struct(
    ("provider_id", _S), ("provider_name", _S), ("provider_type", _S), ("state", _S),
    ("avg_claim_amount", _D), ("total_claims", _I), ("fraud_rate", _D), ("accreditation", _S),
    ("years_active", _I),
)

CLAIMS = _struct(
    ("claim_id", _S), ("member_id", _S), ("provider_id", _S), ("claim_date", _DATE),
    ("claim_type", _S), ("diagnosis_code", _S), ("procedure_code", _S), ("claim_amount", _D),
    ("approved_amount", _D), ("claim_status", _S), ("days_in_hospital", _I),
    ("num_procedures", _I), ("prior_auth", _I), ("is_fraud", _I),
)

NOTES = _struct(
    ("note_id", _S), ("member_id", _S), ("note_date", _DATE), ("clinical_note", _S),
    ("diagnosis_code", _S), ("diagnosis_label", _S), ("sentiment_label", _S),
)

CLAIM_PREDICTIONS = _struct(
    ("claim_id", _S), ("member_id", _S), ("model_version", _S), ("approval_probability", _D),
    ("risk_score", _D), ("risk_band", _S), ("decision", _S), ("created_at", _TS),
)

FRAUD_PREDICTIONS = _struct(
    ("claim_id", _S), ("model_version", _S), ("anomaly_score", _D), ("fraud_flag", _I),
    ("combined_fraud_score", _D), ("alert_level", _S), ("created_at", _TS),
)

PLAN_RECOMMENDATIONS = _struct(
    ("member_id", _S), ("recommended_plan", _S), ("recommendation_score", _D),
    ("model_version", _S), ("created_at", _TS),
)

MODEL_REGISTRY = _struct(
    ("model_name", _S), ("model_type", _S), ("version", _S), ("auc_roc", _D),
    ("precision_score", _D), ("recall_score", _D), ("f1_score", _D), ("training_rows", T.LongType()),
    ("artifact_path", _S), ("is_active", T.BooleanType()), ("deployed_at", _TS), ("created_at", _TS),
)

INTERACTIONS = _struct(("member_id", _S), ("plan_type", _S), ("rating", _I))

RUN_RESULTS = _struct(
    ("timestamp", _TS), ("best_claim", _S), ("results", T.MapType(_S, _D)), ("passed", T.BooleanType()),
)

CLAIM_REQUEST = _struct(
    ("member_id", _S), ("claim_amount", _D), ("claim_type", _S), ("diagnosis_code", _S),
    ("procedure_code", _S), ("num_procedures", _I), ("days_in_hospital", _I), ("prior_auth", _I),
    ("member_age", _I), ("member_bmi", _D), ("member_smoker", _I), ("member_plan", _S),
    ("num_chronic", _I), ("state", _S),
)

FRAUD_REQUEST = _struct(
    ("claim_id", _S), ("member_id", _S), ("provider_id", _S), ("claim_amount", _D),
    ("num_procedures", _I), ("days_in_hospital", _I), ("provider_avg_claim", _D),
    ("provider_claim_count", T.LongType()), ("provider_unique_members", T.LongType()),
    ("member_claim_count", T.LongType()), ("member_avg_claim", _D), ("member_total_spend", _D),
)

NOTE_REQUEST = _struct(("note_id", _S), ("clinical_note", _S))

PLAN_REQUEST = _struct(
    ("member_id", _S), ("age", _I), ("bmi", _D), ("num_chronic_conditions", _I),
    ("tenure_months", _I), ("annual_premium", _D), ("deductible", _D), ("income_score", _D),
)

TABLES = {"members": MEMBERS, "claims": CLAIMS, "providers": PROVIDERS, "notes": NOTES}
TABLE_FILES = {
    "members": "members", "claims": "claims", "providers": "providers", "notes": "clinical_notes",
}
