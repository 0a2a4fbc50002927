"""Feature engineering, validation, defaults and fitted transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import fixtures as fx
from claimlens.operators import claim_features, columns, fraud_features, joins, quality, transforms
from claimlens.session import stage
from verification import fixture_sql as v
from verification.registry import query, rounded


def _enriched(spark, base):
    return joins.enrich_claims(fx.claims(spark, base), fx.members(spark, base))


# --- B: columns, rules, defaults ----------------------------------------------------------------


@query(
    v.with_views(
        """SELECT member_id, age AS member_age, RND(bmi, 4) AS member_bmi, smoker AS member_smoker, plan_type AS member_plan,
        num_chronic_conditions AS num_chronic, 'active' AS status, 25.0::DOUBLE AS copay FROM members""",
        v.MEMBERS,
    )
)
def normalised_members(spark, base):
    members = fx.members(spark, base).select("member_id", *C.MEMBER_COLUMN_NAMES)
    renamed = columns.normalise_columns(members)
    return rounded(columns.with_defaults(renamed, {"status": "active", "copay": 25.0, "member_age": 40}))


@query(v.with_views("SELECT member_id, RND(COALESCE(bmi, 25.0::DOUBLE), 4) AS bmi, age FROM members", v.MEMBERS))
def filled_members(spark, base):
    return rounded(columns.fill_nulls(fx.members(spark, base).select("member_id", "bmi", "age"), {"bmi": 25.0, "age": 40}))


@query(
    v.with_views(
        """SELECT claim_id, concat_ws(',',
          CASE WHEN NOT claim_date >= DATE '1996-01-01' THEN 'recent' END,
          CASE WHEN NOT claim_type IN ('Inpatient','Outpatient','Emergency','Pharmacy') THEN 'type_known' END,
          CASE WHEN NOT claim_amount > 50000 THEN 'amount_floor' END,
          CASE WHEN NOT provider_id < 'PRV0050' THEN 'provider_block' END) AS broken_rules
        FROM claims""",
        v.CLAIMS,
    )
)
def claim_rule_report(spark, base):
    """Rules that part of the fixture breaks; a null provider breaks none."""
    rules = {
        "recent": "claim_date >= DATE '1996-01-01'",
        "type_known": "claim_type IN ('Inpatient', 'Outpatient', 'Emergency', 'Pharmacy')",
        "amount_floor": "claim_amount > 50000",
        "provider_block": "provider_id < 'PRV0050'",
    }
    checked = quality.check_rules(fx.claims(spark, base), rules)
    return checked.select("claim_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query(
    v.with_views(
        """SELECT 'claims' AS table_name, COUNT(*) FILTER (claim_amount > 0 AND claim_date IS NOT NULL) AS n_valid,
          COUNT(*) FILTER (NOT (claim_amount > 0 AND claim_date IS NOT NULL)) AS n_broken FROM claims
        UNION ALL SELECT 'members', COUNT(*) FILTER (COALESCE(age BETWEEN 18 AND 100 AND bmi > 0, bmi IS NULL)),
          COUNT(*) FILTER (NOT COALESCE(age BETWEEN 18 AND 100 AND bmi > 0, bmi IS NULL)) FROM members""",
        v.CLAIMS, v.MEMBERS,
    )
)
def table_validation(spark, base):
    parts = []
    for name, df, rules in (
        ("claims", fx.claims(spark, base), quality.CLAIM_RULES),
        ("members", fx.members(spark, base), quality.MEMBER_RULES),
    ):
        checked = quality.check_rules(df, rules)
        parts.append(
            checked.agg(
                F.count_if(F.size("broken_rules") == 0).alias("n_valid"),
                F.count_if(F.size("broken_rules") > 0).alias("n_broken"),
            ).select(F.lit(name).alias("table_name"), "n_valid", "n_broken")
        )
    return parts[0].unionByName(parts[1])


@query(
    v.with_views(
        """SELECT claim_id, member_id, RND(claim_amount, 4) AS claim_amount, COALESCE(num_procedures, 1) AS num_procedures,
        COALESCE(days_in_hospital, 0) AS days_in_hospital, member_age, COALESCE(member_plan, 'Silver') AS member_plan,
        COALESCE(state, 'CA') AS state FROM claim_requests
        WHERE claim_amount > 0 AND member_age BETWEEN 18 AND 100 AND member_bmi BETWEEN 10 AND 70""",
        v.CLAIMS, v.MEMBERS, v.CLAIM_REQUESTS,
    )
)
def accepted_claim_requests(spark, base):
    requests = columns.with_defaults(fx.claim_requests(spark, base), columns.CLAIM_REQUEST_DEFAULTS, fill_nulls=True)
    ok, _ = quality.validate(requests, quality.CLAIM_REQUEST)
    return rounded(
        ok.select(
            "claim_id", "member_id", "claim_amount", "num_procedures", "days_in_hospital", "member_age",
            "member_plan", "state",
        )
    )


@query(
    v.with_views(
        """SELECT claim_id, concat_ws(',', CASE WHEN claim_amount <= 0 THEN 'amount_positive' END,
        CASE WHEN member_age > 100 THEN 'age_range' END, CASE WHEN member_bmi IS NULL THEN 'bmi_present' END) AS broken_rules
        FROM claim_requests WHERE claim_amount <= 0 OR member_age > 100 OR member_bmi IS NULL""",
        v.CLAIMS, v.MEMBERS, v.CLAIM_REQUESTS,
    )
)
def rejected_claim_requests(spark, base):
    requests = columns.with_defaults(fx.claim_requests(spark, base), columns.CLAIM_REQUEST_DEFAULTS, fill_nulls=True)
    _, bad = quality.validate(requests, quality.CLAIM_REQUEST)
    return bad.select("claim_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query("SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def repeated_order_keys(spark, base):
    return quality.check_unique(fx.table(spark, base, "lineitem"), "l_orderkey")


@query(
    v.with_views(
        """SELECT member_id, COALESCE(CASE WHEN smoker = 1 THEN 1 END, 0) AS smoker,
        COALESCE(CASE WHEN tenure_months > 12 THEN tenure_months END, 0) AS tenure_months, 0 AS num_chronic_conditions FROM members""",
        v.MEMBERS,
    )
)
def insert_defaults(spark, base):
    rows = fx.members(spark, base).select(
        "member_id",
        F.when(F.col("smoker") == 1, F.col("smoker")).alias("smoker"),
        F.when(F.col("tenure_months") > 12, F.col("tenure_months")).alias("tenure_months"),
    )
    return columns.with_defaults(rows, columns.MEMBER_INSERT_DEFAULTS, fill_nulls=True)


@query(
    v.with_views(
        """SELECT claim_id, RND(COALESCE(CASE WHEN claim_type = 'Lab' THEN 5000.0::DOUBLE END, claim_amount), 4) AS provider_avg_claim,
        100 AS provider_claim_count, 80 AS provider_unique_members, 5 AS member_claim_count,
        RND(claim_amount * 0.6::DOUBLE, 4) AS member_avg_claim, RND(claim_amount * 3, 4) AS member_total_spend FROM claims""",
        v.CLAIMS,
    )
)
def request_default_stats(spark, base):
    rows = fx.claims(spark, base).select(
        "claim_id", "claim_amount", F.when(F.col("claim_type") == "Lab", 5000.0).alias("provider_avg_claim")
    )
    return rounded(columns.default_stats(rows).drop("claim_amount"))


@query(v.with_views("SELECT claim_id, claim_amount FROM claims ORDER BY claim_id LIMIT 5", v.CLAIMS))
def first_claims(spark, base):
    return columns.head_rows(fx.claims(spark, base).select("claim_id", "claim_amount"), 5, "claim_id")


@query(
    v.with_views(
        """SELECT DISTINCT procedure_code FROM claims WHERE claim_date >= DATE '1998-01-01' AND procedure_code IS NOT NULL
        AND procedure_code NOT IN (SELECT procedure_code FROM claims WHERE claim_date < DATE '1998-01-01' AND claim_amount < 4000
          AND procedure_code IS NOT NULL)""",
        v.CLAIMS,
    )
)
def unseen_procedures(spark, base):
    """Procedure codes of recent claims that the cheap older claims never used."""
    claims = fx.claims(spark, base).where("procedure_code IS NOT NULL")
    recent = claims.where("claim_date >= DATE '1998-01-01'")
    old = claims.where("claim_date < DATE '1998-01-01' AND claim_amount < 4000")
    return quality.unseen_categories(recent, old, "procedure_code")


@query(
    v.with_views(
        "SELECT DISTINCT claim_type FROM claims WHERE claim_type NOT IN ('Inpatient','Outpatient','Emergency')", v.CLAIMS
    )
)
def types_outside_domain(spark, base):
    return quality.outside_domain(fx.claims(spark, base), "claim_type", ["Inpatient", "Outpatient", "Emergency"])


# --- B6-B13: engineered columns -----------------------------------------------------------------

_BASE = """base AS (SELECT e.*, claim_amount / GREATEST(num_procedures, 1) AS claim_per_procedure,
  LEAST(GREATEST(member_age / 85.0::DOUBLE, 0), 1) AS risk_score_age,
  CASE WHEN member_bmi IS NOT NULL THEN LEAST(GREATEST((member_bmi - 18.5::DOUBLE) / 40.0::DOUBLE, 0), 1) END AS risk_score_bmi,
  CAST(CASE WHEN claim_amount > (SELECT quantile_cont(claim_amount, 0.9) FROM enriched) THEN 1 ELSE 0 END AS INT) AS high_cost_flag,
  CAST(CASE WHEN claim_type = 'Inpatient' THEN 1 ELSE 0 END AS INT) AS inpatient_flag,
  CAST(CASE WHEN claim_type = 'Emergency' THEN 1 ELSE 0 END AS INT) AS emergency_flag FROM enriched e),
features AS (SELECT *, risk_score_age * 0.3::DOUBLE + risk_score_bmi * 0.2::DOUBLE + LEAST(GREATEST(num_chronic / 3.0::DOUBLE, 0), 1) * 0.3::DOUBLE
  + member_smoker * 0.1::DOUBLE + high_cost_flag * 0.1::DOUBLE AS composite_risk FROM base)"""


@query(
    v.with_views(
        """SELECT claim_id, RND(claim_per_procedure, 4) AS claim_per_procedure, RND(risk_score_age, 4) AS risk_score_age,
        RND(risk_score_bmi, 4) AS risk_score_bmi, high_cost_flag, inpatient_flag, emergency_flag,
        RND(composite_risk, 4) AS composite_risk, CAST(CASE WHEN claim_status = 'Approved' THEN 1 ELSE 0 END AS INT) AS claim_approved
        FROM features""",
        v.CLAIMS, v.MEMBERS, v.ENRICHED, _BASE,
    )
)
def claim_base_features(spark, base):
    claims = stage(_enriched(spark, base), "enriched")
    out = claim_features.base_features(claims, claim_features.high_cost_threshold(claims))
    return rounded(
        out.select(
            "claim_id", "claim_per_procedure", "risk_score_age", "risk_score_bmi", "high_cost_flag",
            "inpatient_flag", "emergency_flag", "composite_risk",
            claim_features.S.approved_label(F.col("claim_status")).alias("claim_approved"),
        )
    )


@query(
    v.with_views(
        """SELECT claim_id, CAST(CASE WHEN claim_status = 'Approved' THEN 1 ELSE 0 END AS INT) AS claim_approved,
        CAST(CASE WHEN claim_amount > 450000 THEN 1 ELSE 0 END AS INT) AS high_cost_flag,
        RND(m.age / 85.0::DOUBLE * 0.3::DOUBLE + m.num_chronic_conditions / 3.0::DOUBLE * 0.4::DOUBLE + m.smoker * 0.1::DOUBLE
          + CASE WHEN claim_amount > 450000 THEN 0.2::DOUBLE ELSE 0 END, 4) AS composite_risk,
        RND(COALESCE(m.bmi, 25.0::DOUBLE), 4) AS bmi, COALESCE(m.num_chronic_conditions, 0) AS num_chronic_conditions
        FROM claims c LEFT JOIN members m ON c.member_id = m.member_id""",
        v.CLAIMS, v.MEMBERS,
    )
)
def lake_claim_features(spark, base):
    members = fx.members(spark, base).select("member_id", "age", "bmi", "smoker", "plan_type", "num_chronic_conditions")
    joined = joins.skew_join(fx.claims(spark, base), members, "member_id", F.col("claim_id"))
    out = claim_features.lake_features(joined, threshold=450000)
    return rounded(
        out.select("claim_id", "claim_approved", "high_cost_flag", "composite_risk", "bmi", "num_chronic_conditions")
    )


_FRAUD_RAW = """pstat AS (SELECT provider_id, AVG(claim_amount) AS a, COUNT(claim_id) AS n, COUNT(DISTINCT member_id) AS u FROM claims GROUP BY 1),
mstat AS (SELECT member_id, COUNT(claim_id) AS n, AVG(claim_amount) AS a, SUM(claim_amount) AS s FROM claims GROUP BY 1),
raw AS (SELECT claim_id, is_fraud, claim_amount, CAST(num_procedures AS DOUBLE) AS num_procedures, CAST(days_in_hospital AS DOUBLE) AS days_in_hospital,
 COALESCE(p.a, 0) AS provider_avg_claim, CAST(COALESCE(p.n, 0) AS DOUBLE) AS provider_claim_count,
 CAST(COALESCE(p.u, 0) AS DOUBLE) AS provider_unique_members, CAST(COALESCE(m.n, 0) AS DOUBLE) AS member_claim_count,
 COALESCE(m.a, 0) AS member_avg_claim, COALESCE(m.s, 0) AS member_total_spend,
 CASE WHEN p.a IS NULL THEN 1 ELSE claim_amount / GREATEST(p.a, 1) END AS amount_vs_provider_avg,
 CASE WHEN m.a IS NULL THEN 1 ELSE claim_amount / GREATEST(m.a, 1) END AS amount_vs_member_avg,
 CAST(num_procedures AS DOUBLE) / GREATEST(days_in_hospital, 1) AS procedure_density
 FROM claims c LEFT JOIN pstat p ON c.provider_id = p.provider_id LEFT JOIN mstat m ON c.member_id = m.member_id)"""


@query(
    v.with_views(
        """SELECT claim_id, RND(amount_vs_provider_avg, 4) AS amount_vs_provider_avg, RND(amount_vs_member_avg, 4) AS amount_vs_member_avg,
        RND(procedure_density, 4) AS procedure_density FROM raw""",
        v.CLAIMS, _FRAUD_RAW,
    )
)
def fraud_ratios(spark, base):
    claims = joins.with_claim_stats(fx.claims(spark, base))
    return rounded(
        fraud_features.fraud_ratios(claims).select(
            "claim_id", "amount_vs_provider_avg", "amount_vs_member_avg", "procedure_density"
        )
    )


# --- I: fitted transforms -----------------------------------------------------------------------

_MEASURES = ("claim_amount", "member_bmi", "claim_per_procedure", "risk_score_bmi")


@query(
    v.with_views(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, RND(MIN({c}), 4) AS min_value, RND(MAX({c}), 4) AS max_value, RND(AVG({c}), 4) AS mean_value,
            RND(STDDEV_POP({c}), 4) AS std_value, RND(MEDIAN({c}), 4) AS median_value FROM features"""
            for c in _MEASURES
        ),
        v.CLAIMS, v.MEMBERS, v.ENRICHED, _BASE,
    )
)
def fitted_column_stats(spark, base):
    frame = stage(claim_features.base_features(_enriched(spark, base), 0.0).select(*_MEASURES), "measures")
    return rounded(transforms.fit_stats(frame, list(_MEASURES)))


@query(
    v.with_views(
        "SELECT member_id, RND(COALESCE(bmi, (SELECT MEDIAN(bmi) FROM members)), 4) AS bmi FROM members", v.MEMBERS
    )
)
def imputed_bmi(spark, base):
    members = fx.members(spark, base).select("member_id", "bmi")
    return rounded(transforms.MedianImputer(columns=["bmi"]).fit(members).transform(members))


@query(
    v.with_views(
        """SELECT claim_id, CAST(DENSE_RANK() OVER (ORDER BY claim_type) - 1 AS DOUBLE) AS claim_type,
        CAST(DENSE_RANK() OVER (ORDER BY COALESCE(diagnosis_code, 'Unknown')) - 1 AS DOUBLE) AS diagnosis_code,
        CAST(DENSE_RANK() OVER (ORDER BY COALESCE(procedure_code, 'Unknown')) - 1 AS DOUBLE) AS procedure_code FROM claims""",
        v.CLAIMS,
    )
)
def indexed_categories(spark, base):
    claims = fx.claims(spark, base).select("claim_id", "claim_type", "diagnosis_code", "procedure_code")
    return transforms.LabelIndexer(columns=["claim_type", "diagnosis_code", "procedure_code"]).fit(claims).transform(claims)


@query(
    v.with_views(
        """SELECT member_id, RND((annual_premium - (SELECT AVG(annual_premium) FROM members)) / (SELECT STDDEV_POP(annual_premium) FROM members), 4) AS annual_premium
        FROM members""",
        v.MEMBERS,
    )
)
def standardised_premium(spark, base):
    members = fx.members(spark, base).select("member_id", "annual_premium")
    return rounded(transforms.ZScaler(columns=["annual_premium"]).fit(members).transform(members))


@query(
    v.with_views(
        """SELECT member_id, RND((annual_premium - (SELECT MIN(annual_premium) FROM members)) /
        (SELECT MAX(annual_premium) - MIN(annual_premium) FROM members), 4) AS annual_premium, 0.0::DOUBLE AS constant_column FROM members""",
        v.MEMBERS,
    )
)
def range_scaled_premium(spark, base):
    members = fx.members(spark, base).select("member_id", "annual_premium", F.lit(7.0).alias("constant_column"))
    scaler = transforms.RangeScaler(columns=["annual_premium", "constant_column"])
    return rounded(scaler.fit(members).transform(members))


def _claim_matrix_sql() -> str:
    imputed = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), (SELECT MEDIAN({c}) FROM features)) AS {c}" for c in C.CLAIM_NUMERIC)
    coded = ", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c}, 'Unknown')) - 1 AS DOUBLE) AS {c}" for c in C.CLAIM_CATEGORICAL
    )
    names = (*C.CLAIM_NUMERIC, *C.CLAIM_CATEGORICAL)
    stats = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in names)
    scaled = ", ".join(f"RND(({c} - m_{c}) / s_{c}, 4) AS {c}" for c in names)
    return v.with_views(
        f"SELECT claim_id, member_id, claim_approved, {scaled} FROM matrix, (SELECT {stats} FROM matrix)",
        v.CLAIMS, v.MEMBERS, v.ENRICHED, _BASE,
        f"""matrix AS (SELECT claim_id, member_id, CAST(CASE WHEN claim_status = 'Approved' THEN 1 ELSE 0 END AS INT) AS claim_approved,
        {imputed}, {coded} FROM features)""",
    )


@query(_claim_matrix_sql())
def claim_feature_matrix(spark, base):
    claims = stage(_enriched(spark, base), "enriched")
    return rounded(claim_features.ClaimFeatures().fit(claims).transform(claims))


def _fraud_matrix_sql() -> str:
    ranges = ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in C.FRAUD_FEATURES)
    scaled = ", ".join(f"RND(({c} - lo_{c}) / (hi_{c} - lo_{c}), 4) AS {c}" for c in C.FRAUD_FEATURES)
    return v.with_views(
        f"SELECT claim_id, is_fraud, {scaled} FROM raw, (SELECT {ranges} FROM raw)", v.CLAIMS, _FRAUD_RAW
    )


@query(_fraud_matrix_sql())
def fraud_feature_matrix(spark, base):
    claims = stage(fx.claims(spark, base), "claims")
    return rounded(fraud_features.FraudFeatures().fit_transform(claims)[1])
