"""Declared row rules, uniqueness and allowed-value checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C


def _one_of(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# rule name -> SQL predicate; as with a table CHECK, a null operand does not break a rule
MEMBER_RULES = {
    "age_present": "age IS NOT NULL",
    "age_range": "age BETWEEN 18 AND 100",
    "bmi_positive": "bmi > 0",
    "plan_known": _one_of("plan_type", C.PLANS),
}
CLAIM_RULES = {
    "date_present": "claim_date IS NOT NULL",
    "type_known": _one_of("claim_type", C.CLAIM_TYPES),
    "amount_positive": "claim_amount > 0",
    "status_known": _one_of("claim_status", C.CLAIM_STATUSES),
}

CLAIM_REQUEST = {
    "member_present": "member_id IS NOT NULL",
    "amount_present": "claim_amount IS NOT NULL",
    "amount_positive": "claim_amount > 0",
    "type_present": "claim_type IS NOT NULL",
    "diagnosis_present": "diagnosis_code IS NOT NULL",
    "procedure_present": "procedure_code IS NOT NULL",
    "procedures_min": "num_procedures >= 1",
    "days_min": "days_in_hospital >= 0",
    "prior_auth_flag": "prior_auth BETWEEN 0 AND 1",
    "age_present": "member_age IS NOT NULL",
    "age_range": "member_age BETWEEN 18 AND 100",
    "bmi_present": "member_bmi IS NOT NULL",
    "bmi_range": "member_bmi BETWEEN 10 AND 70",
    "smoker_flag": "member_smoker BETWEEN 0 AND 1",
    "chronic_min": "num_chronic >= 0",
}
FRAUD_REQUEST = {
    "claim_present": "claim_id IS NOT NULL",
    "member_present": "member_id IS NOT NULL",
    "provider_present": "provider_id IS NOT NULL",
    "amount_present": "claim_amount IS NOT NULL",
    "procedures_present": "num_procedures IS NOT NULL",
    "days_present": "days_in_hospital IS NOT NULL",
}
NOTE_REQUEST = {
    "note_present": "clinical_note IS NOT NULL",
    "note_length": "length(clinical_note) >= 10",
}
PLAN_REQUEST = {
    "member_present": "member_id IS NOT NULL",
    "age_present": "age IS NOT NULL",
    "age_range": "age BETWEEN 18 AND 100",
    "bmi_present": "bmi IS NOT NULL",
    "bmi_range": "bmi BETWEEN 10 AND 70",
    "chronic_min": "num_chronic_conditions >= 0",
    "tenure_min": "tenure_months >= 1",
    "premium_positive": "annual_premium > 0",
    "deductible_positive": "deductible > 0",
    "income_range": "income_score BETWEEN 0 AND 1",
}


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add ``broken_rules``: the names of the rules a row breaks, in rule order."""
    broken = [F.when(~F.coalesce(F.expr(rule), F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("broken_rules", F.array_compact(F.array(*broken)))


def validate(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into (rows that pass, rows that break a rule with the rule names)."""
    checked = check_rules(df, rules)
    ok = checked.where(F.size("broken_rules") == 0).drop("broken_rules")
    return ok, checked.where(F.size("broken_rules") > 0)


def check_unique(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def unseen_categories(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` that ``known`` does not have."""
    return df.select(column).distinct().join(known.select(column).distinct(), column, "left_anti")


def outside_domain(df: DataFrame, column: str, allowed) -> DataFrame:
    """Distinct values outside the allowed ones; empty when the column is clean."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).select(column).distinct()
