"""The same fixture views as SQL, written on their own so that the oracle shares no expression."""

from claimlens import constants as C
from verification.registry import ROUND_OFFSET

LINES = """li AS (SELECT l_orderkey, COUNT(*) AS n_li, MIN(l_suppkey) AS sk, MIN(l_partkey) AS pk,
  MIN(l_quantity) AS q, MAX(l_discount) AS d, SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey)"""

CLAIMS = (
    LINES
    + """,
claims AS (SELECT concat('CLM', lpad(CAST(o_orderkey AS STRING),7,'0')) AS claim_id,
  concat('MBR', lpad(CAST(o_custkey AS STRING),6,'0')) AS member_id,
  CASE WHEN sk IS NULL THEN NULL ELSE concat('PRV', lpad(CAST(sk AS STRING),4,'0')) END AS provider_id,
  CAST(o_orderdate AS DATE) AS claim_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Inpatient'
    WHEN '3-MEDIUM' THEN 'Outpatient' WHEN '5-LOW' THEN 'Pharmacy' ELSE 'Lab' END AS claim_type,
  p_type AS diagnosis_code, p_brand AS procedure_code, o_totalprice AS claim_amount,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 12 <> 0 THEN o_totalprice * 0.8::DOUBLE ELSE 0.0::DOUBLE END AS approved_amount,
  CASE o_orderstatus WHEN 'P' THEN 'Denied' ELSE CASE WHEN o_orderkey % 12 = 0 THEN 'Pending' ELSE 'Approved' END END AS claim_status,
  CAST(CASE WHEN o_orderpriority='2-HIGH' THEN COALESCE(CAST(q AS INT) % 15, 0) ELSE 0 END AS INT) AS days_in_hospital,
  CAST(COALESCE(n_li,1) AS INT) AS num_procedures, CAST(o_custkey % 2 AS INT) AS prior_auth,
  CAST(CASE WHEN d >= 0.10::DOUBLE AND n_ret >= 3 THEN 1 ELSE 0 END AS INT) AS is_fraud
FROM orders LEFT JOIN li ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = pk)"""
)

MEMBERS = """members AS (SELECT concat('MBR', lpad(CAST(c_custkey AS STRING),6,'0')) AS member_id,
 CAST(18 + c_custkey % 68 AS INT) AS age,
 CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender, n_name AS state,
 CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 15 + (c_acctbal + 1000) / 11000 * 40 END AS bmi,
 CAST(CASE WHEN c_custkey % 11 < 2 THEN 1 ELSE 0 END AS INT) AS smoker,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Bronze' WHEN 'BUILDING' THEN 'Silver' WHEN 'FURNITURE' THEN 'Gold'
   WHEN 'HOUSEHOLD' THEN 'Platinum' ELSE 'Silver' END AS plan_type,
 CAST(1 + (c_custkey * 7) % 120 AS INT) AS tenure_months, CAST(c_custkey % 4 AS INT) AS num_chronic_conditions,
 3000 + ABS(c_acctbal) * 1.5::DOUBLE AS annual_premium,
 CAST(CASE c_custkey % 5 WHEN 0 THEN 500 WHEN 1 THEN 1000 WHEN 2 THEN 2000 WHEN 3 THEN 3500 ELSE 5000 END AS INT) AS deductible
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PROVIDERS = """providers AS (SELECT concat('PRV', lpad(CAST(s_suppkey AS STRING),4,'0')) AS provider_id, s_name AS provider_name,
 CASE s_suppkey % 5 WHEN 0 THEN 'Hospital' WHEN 1 THEN 'Clinic' WHEN 2 THEN 'Specialist' WHEN 3 THEN 'Lab' ELSE 'Pharmacy' END AS provider_type,
 n_name AS state FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""



def _in_turn(words, key: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"([{listed}])[CAST(({key}) % {len(words)} AS INT) + 1]"


NOTES = f"""notes AS (SELECT concat('NOTE', lpad(CAST(doc_id AS STRING),6,'0')) AS note_id,
 concat('MBR', lpad(CAST(doc_id % 100 + 1 AS STRING),6,'0')) AS member_id,
 CAST(DATE '1997-01-01' + CAST(doc_id % 730 AS INT) AS DATE) AS note_date,
 COALESCE(text, '') || ' ' || upper({_in_turn(C.ABBREVIATIONS, 'doc_id')}) || ', '
   || {_in_turn([*[word for word, _, _ in C.DIAGNOSIS_RULES], 'wellness'], 'doc_id')} || '!' AS clinical_note FROM documents)"""

_FEELINGS = [*C.TOKEN_POSITIVE, *C.TOKEN_NEGATIVE, *C.SUBSTRING_NEGATIVE, "nothing"]
FEEDBACK = f"""feedback AS (SELECT conv_id, turn, COALESCE(text, '') || ' ' || upper({_in_turn(_FEELINGS, 'conv_id * 3 + turn')})
 || ' ' || {_in_turn(_FEELINGS, 'conv_id + turn * 5')} AS text FROM conversations)"""

_VERSIONS = """CROSS JOIN (SELECT 'v1' AS model_version UNION ALL SELECT 'v2' AS model_version) v
 WHERE v.model_version = 'v1' OR o_orderkey % 10 = 0"""

CLAIM_PREDICTIONS = f"""claim_predictions AS (SELECT concat('CLM', lpad(CAST(o_orderkey AS STRING),7,'0')) AS claim_id,
 concat('MBR', lpad(CAST(o_custkey AS STRING),6,'0')) AS member_id, v.model_version,
 CAST(o_orderkey % 100 AS DOUBLE) / 100 AS risk_score FROM orders {_VERSIONS})"""

FRAUD_PREDICTIONS = f"""fraud_predictions AS (SELECT concat('CLM', lpad(CAST(o_orderkey AS STRING),7,'0')) AS claim_id,
 v.model_version, CAST(o_orderkey % 97 AS DOUBLE) / 97 AS anomaly_score FROM orders {_VERSIONS})"""

ENRICHED = """enriched AS (SELECT c.*, m.age AS member_age, m.bmi AS member_bmi, m.smoker AS member_smoker,
 m.plan_type AS member_plan, m.num_chronic_conditions AS num_chronic, m.state AS state
 FROM claims c LEFT JOIN members m ON c.member_id = m.member_id)"""

CLAIM_REQUESTS = """claim_requests AS (SELECT claim_id, c.member_id,
 CASE WHEN k % 29 = 0 THEN -claim_amount ELSE claim_amount END AS claim_amount, claim_type,
 COALESCE(diagnosis_code,'NONE') AS diagnosis_code, COALESCE(procedure_code,'NONE') AS procedure_code,
 CASE WHEN k % 13 <> 0 THEN num_procedures END AS num_procedures,
 CASE WHEN k % 17 <> 0 THEN days_in_hospital END AS days_in_hospital, prior_auth,
 CAST(CASE WHEN k % 31 = 0 THEN age + 90 ELSE age END AS INT) AS member_age, bmi AS member_bmi, smoker AS member_smoker,
 CASE WHEN k % 7 <> 0 THEN plan_type END AS member_plan, num_chronic_conditions AS num_chronic,
 CASE WHEN k % 11 <> 0 THEN state END AS state
 FROM (SELECT *, CAST(substr(claim_id, 4) AS BIGINT) AS k FROM claims) c LEFT JOIN members m ON c.member_id = m.member_id)"""

PLAN_REQUESTS = """plan_requests AS (SELECT member_id, age, bmi, num_chronic_conditions, tenure_months, annual_premium, deductible,
 CASE WHEN k % 9 <> 0 THEN CAST(k % 10 AS DOUBLE) / 10 END AS income_score
 FROM (SELECT *, CAST(substr(member_id, 4) AS BIGINT) AS k FROM members))"""


def with_views(body: str, *views: str) -> str:
    """Full statement; ``RND(x, 4)`` stands for rounding with the shared offset."""
    views_text = "WITH " + ",\n".join(views) + "\n" if views else ""
    return (views_text + body.strip()).replace("RND(", f"ROUND({ROUND_OFFSET:.7f}::DOUBLE + ")
