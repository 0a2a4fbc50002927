"""Domain constants every operator shares.

Everything in this module is a fixed value of the claims domain (word lists, rule tables, weights,
thresholds).  They are stated once, in natural order, and never computed.
"""

# --- Fixed values: plans -----------------------------------------------------------------------
PLANS = ("Bronze", "Silver", "Gold", "Platinum")
DEFAULT_PLAN = "Silver"

# plan -> (premium score, coverage score, deductible score)
PLAN_SCORES = {
    "Bronze": (1, 2, 4),
    "Silver": (2, 3, 3),
    "Gold": (3, 4, 2),
    "Platinum": (4, 5, 1),
}

# --- Fixed values: allowed categories ----------------------------------------------------------
CLAIM_TYPES = ("Inpatient", "Outpatient", "Emergency", "Pharmacy", "Lab")
CLAIM_STATUSES = ("Approved", "Denied", "Pending")
UNKNOWN_CATEGORY = "Unknown"

# --- Fixed values: column names and defaults of an enriched claim -------------------------------
MEMBER_COLUMN_NAMES = {
    "age": "member_age",
    "bmi": "member_bmi",
    "smoker": "member_smoker",
    "plan_type": "member_plan",
    "num_chronic_conditions": "num_chronic",
}
ENRICHED_DEFAULTS = {
    "member_age": 40,
    "member_bmi": 25.0,
    "member_smoker": 0,
    "member_plan": "Silver",
    "num_chronic": 0,
}

# --- Fixed values: claim feature columns --------------------------------------------------------
CLAIM_NUMERIC = (
    "claim_amount",
    "member_age",
    "member_bmi",
    "num_chronic",
    "num_procedures",
    "days_in_hospital",
    "prior_auth",
    "member_smoker",
    "claim_per_procedure",
    "risk_score_age",
    "risk_score_bmi",
    "high_cost_flag",
    "inpatient_flag",
    "emergency_flag",
    "composite_risk",
)
CLAIM_CATEGORICAL = ("claim_type", "member_plan", "state", "procedure_code", "diagnosis_code")
HIGH_COST_QUANTILE = 0.90
HIGH_COST_AMOUNT = 15000

# --- Fixed values: fraud feature columns --------------------------------------------------------
FRAUD_FEATURES = (
    "claim_amount",
    "num_procedures",
    "days_in_hospital",
    "provider_avg_claim",
    "provider_claim_count",
    "provider_unique_members",
    "member_claim_count",
    "member_avg_claim",
    "member_total_spend",
    "amount_vs_provider_avg",
    "amount_vs_member_avg",
    "procedure_density",
)

# --- Fixed values: scoring ----------------------------------------------------------------------
# (upper bound of the band, label); bands are open below and closed above, starting at 0
RISK_BANDS = ((0.2, "Very Low"), (0.4, "Low"), (0.6, "Medium"), (0.8, "High"), (1.0, "Very High"))
DECISION_THRESHOLD = 0.5
FRAUD_WEIGHTS = {"anomaly_score": 0.5, "high_fraud_cluster": 0.3, "is_anomaly": 0.2}
FRAUD_CLUSTER_RATE = 0.15
ANOMALY_FLAG_SCORE = 0.75
CONTAMINATION = 0.05
FOREST_TREES = 200
FOREST_SAMPLE = 256
KMEANS_CLUSTERS = 5
KMEANS_RESTARTS = 10

# --- Fixed values: recommendation ---------------------------------------------------------------
PROFILE_COLUMNS = (
    "age",
    "bmi",
    "num_chronic_conditions",
    "tenure_months",
    "annual_premium",
    "deductible",
)
HYBRID_WEIGHTS = {"collab": 0.40, "knn": 0.35, "content": 0.25}
# tier -> ranked (plan, score)
FALLBACK_PLANS = {
    "senior": (("Platinum", 0.90), ("Gold", 0.75), ("Silver", 0.55)),
    "middle": (("Gold", 0.85), ("Silver", 0.72), ("Platinum", 0.60)),
    "young": (("Silver", 0.88), ("Bronze", 0.70), ("Gold", 0.55)),
}

# --- Fixed values: clinical abbreviations -------------------------------------------------------
ABBREVIATIONS = {
    "pt": "patient",
    "hx": "history",
    "dx": "diagnosis",
    "tx": "treatment",
    "rx": "prescription",
    "htn": "hypertension",
    "dm": "diabetes mellitus",
    "cad": "coronary artery disease",
    "ckd": "chronic kidney disease",
    "bp": "blood pressure",
    "hr": "heart rate",
    "sob": "shortness of breath",
    "cp": "chest pain",
    "n/v": "nausea vomiting",
}
ABBREVIATIONS_SHORT = {
    "pt": "patient",
    "htn": "hypertension",
    "dx": "diagnosis",
    "tx": "treatment",
    "hx": "history",
    "dm": "diabetes mellitus",
    "sob": "shortness of breath",
    "cp": "chest pain",
    "n/v": "nausea vomiting",
    "bp": "blood pressure",
}

# --- Fixed values: keyword diagnosis, first match wins ------------------------------------------
DIAGNOSIS_RULES = (
    ("hypertension", "I10", 0.85),
    ("diabetes", "E11", 0.82),
    ("asthma", "J45", 0.80),
    ("pain", "M54", 0.70),
    ("cancer", "C34", 0.75),
    ("depression", "F32", 0.78),
    ("coronary", "I25", 0.80),
    ("kidney", "N18", 0.77),
)
DEFAULT_DIAGNOSIS = ("J06", 0.60)

# --- Fixed values: sentiment words --------------------------------------------------------------
TOKEN_POSITIVE = (
    "smooth", "fast", "excellent", "great", "professional", "helpful", "good", "happy", "satisfied",
)
TOKEN_NEGATIVE = (
    "waiting", "frustrated", "rejected", "disappointed", "confusing", "slow", "bad", "terrible", "awful",
)
SUBSTRING_POSITIVE = ("smooth", "fast", "excellent", "great", "professional", "helpful")
SUBSTRING_NEGATIVE = ("waiting", "frustrating", "rejected", "disappointed", "confusing")
