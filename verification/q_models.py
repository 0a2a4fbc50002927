"""Evaluation, scoring, fraud detection and recommendation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import fixtures as fx
from claimlens.functions import scalars as S
from claimlens.functions.text import plan_explanation
from claimlens.operators import boosting, claim_features, columns, evaluation, fraud, fraud_features, joins, neighbours, ranking
from claimlens.operators import recommend as R
from claimlens.operators import reports
from claimlens.plans import claim_models, fraud_models
from claimlens.session import new_stage_path, stage
from verification import fixture_sql as v
from verification.registry import query, rounded

# --- scored rows: a deterministic score per claim -----------------------------------------------

_SCORED = """scored AS (SELECT claim_id, member_id, is_fraud, CAST(CASE WHEN claim_status = 'Approved' THEN 1 ELSE 0 END AS INT) AS label,
 CAST(k % 101 AS DOUBLE) / 100 AS p, CAST(CASE WHEN k % 101 >= 50 THEN 1 ELSE 0 END AS INT) AS prediction, k
 FROM (SELECT *, CAST(substr(claim_id, 4) AS BIGINT) * 37 + num_procedures * 11 AS k FROM claims))"""


def _scored(spark, base):
    k = F.substring("claim_id", 4, 20).cast("long") * 37 + F.col("num_procedures") * 11
    return fx.claims(spark, base).select(
        "claim_id", "member_id", "is_fraud",
        S.approved_label(F.col("claim_status")).alias("label"),
        ((k % 101).cast("double") / 100).alias("p"),
        (k % 101 >= 50).cast("int").alias("prediction"),
        k.alias("k"),
    )


@query(v.with_views("SELECT label, prediction, COUNT(*) AS n_rows FROM scored GROUP BY 1, 2", v.CLAIMS, _SCORED))
def confusion_matrix(spark, base):
    return evaluation.confusion(_scored(spark, base))


@query(
    v.with_views(
        """SELECT class, RND(precision, 4) AS precision, RND(recall, 4) AS recall, RND(f1_score, 4) AS f1_score, support FROM (
          SELECT class, precision, recall, f1_score, support FROM measures
          UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS a, COUNT(*) AS n FROM scored)
          UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), CAST(SUM(support) AS BIGINT) FROM measures
          UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
            SUM(f1_score * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM measures)""",
        v.CLAIMS, _SCORED,
        """measures AS (SELECT class, tp / predicted AS precision, tp / support AS recall,
          2 * (tp / predicted) * (tp / support) / (tp / predicted + tp / support) AS f1_score, support
          FROM (SELECT CAST(c AS VARCHAR) AS class, COUNT(*) FILTER (label = c AND prediction = c) AS tp,
            COUNT(*) FILTER (prediction = c) AS predicted, COUNT(*) FILTER (label = c) AS support
            FROM scored, (SELECT unnest([0, 1]) AS c) GROUP BY c))""",
    )
)
def classification_report(spark, base):
    return rounded(evaluation.classification_report(_scored(spark, base)))


@query(
    v.with_views(
        """SELECT RND((SUM(CASE WHEN label = 1 THEN r END) - MAX(np) * (MAX(np) + 1) / 2.0::DOUBLE) / (MAX(np) * CAST(MAX(nn) AS DOUBLE)), 4) AS auc FROM (
          SELECT label, (2 * rank() OVER (ORDER BY p) + COUNT(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r,
          COUNT(*) FILTER (label = 1) OVER () AS np, COUNT(*) FILTER (label = 0) OVER () AS nn FROM scored)""",
        v.CLAIMS, _SCORED,
    )
)
def roc_auc(spark, base):
    return rounded(evaluation.roc_auc(_scored(spark, base), "label", "p"))


@query(
    v.with_views(
        """SELECT RND((SUM(CASE WHEN label = 1 THEN r END) - MAX(np) * (MAX(np) + 1) / 2.0::DOUBLE) / (MAX(np) * CAST(MAX(nn) AS DOUBLE)), 4) AS auc FROM (
          SELECT label, (2 * rank() OVER (ORDER BY s) + COUNT(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r,
          COUNT(*) FILTER (label = 1) OVER () AS np, COUNT(*) FILTER (label = 0) OVER () AS nn
          FROM (SELECT is_fraud AS label, claim_amount AS s FROM claims))""",
        v.CLAIMS,
    )
)
def amount_auc(spark, base):
    """How well the bare amount ranks fraud: nearly every score is distinct."""
    return rounded(evaluation.roc_auc(fx.claims(spark, base), "is_fraud", "claim_amount"))


@query(
    v.with_views("SELECT RND(AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END), 4) AS accuracy FROM scored", v.CLAIMS, _SCORED)
)
def prediction_accuracy(spark, base):
    return rounded(evaluation.accuracy(_scored(spark, base)))


@query(
    v.with_views(
        "SELECT claim_status, COUNT(*) AS n_rows, RND((SELECT COUNT(*) / CAST(COUNT(DISTINCT claim_status) AS DOUBLE) FROM claims) / COUNT(*), 4) AS weight FROM claims GROUP BY 1",
        v.CLAIMS,
    )
)
def balanced_class_weights(spark, base):
    return rounded(evaluation.class_weights(fx.claims(spark, base), "claim_status"))


@query(
    v.with_views(
        "SELECT is_fraud, COUNT(*) AS n_rows, CASE WHEN is_fraud = 1 THEN 19.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM claims GROUP BY 1",
        v.CLAIMS,
    )
)
def fraud_class_weights(spark, base):
    return evaluation.class_weights(fx.claims(spark, base), "is_fraud", 19.0)


@query(
    v.with_views(
        """SELECT claim_id, is_fraud, CAST(CASE WHEN rn <= round(n * 0.2::DOUBLE) THEN 1 ELSE 0 END AS INT) AS is_test FROM (
          SELECT claim_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(claim_id || '|42'), claim_id) AS rn,
          COUNT(*) OVER (PARTITION BY is_fraud) AS n FROM claims)""",
        v.CLAIMS,
    )
)
def stratified_split(spark, base):
    return ranking.stratified_split(fx.claims(spark, base).select("claim_id", "is_fraud"), "is_fraud", "claim_id")


@query(
    v.with_views(
        """SELECT claim_id, claim_status, CAST((row_number() OVER (PARTITION BY claim_status ORDER BY md5(claim_id || '|42'), claim_id) - 1) % 5 AS INT) AS fold
        FROM claims""",
        v.CLAIMS,
    )
)
def stratified_folds(spark, base):
    return ranking.stratified_folds(fx.claims(spark, base).select("claim_id", "claim_status"), "claim_status", "claim_id")


@query(
    v.with_views(
        """SELECT claim_id, ROUND(p, 4) AS approval_probability, ROUND(1 - p, 4) AS risk_score,
        CASE WHEN 1 - p <= 0 THEN NULL WHEN 1 - p <= 0.2::DOUBLE THEN 'Very Low' WHEN 1 - p <= 0.4::DOUBLE THEN 'Low'
          WHEN 1 - p <= 0.6::DOUBLE THEN 'Medium' WHEN 1 - p <= 0.8::DOUBLE THEN 'High' ELSE 'Very High' END AS risk_band,
        CASE WHEN p >= 0.5 THEN 'Approve' ELSE 'Review' END AS decision FROM scored""",
        v.CLAIMS, _SCORED,
    )
)
def risk_table(spark, base):
    scored = evaluation.risk_scores(_scored(spark, base), "p")
    return scored.select("claim_id", "approval_probability", "risk_score", "risk_band", "decision")


@query(
    v.with_views(
        "SELECT COUNT(*) AS total, COUNT(*) FILTER (p >= 0.5) AS approved, COUNT(*) FILTER (p < 0.5) AS review FROM scored",
        v.CLAIMS, _SCORED,
    )
)
def decision_summary(spark, base):
    return reports.decision_summary(evaluation.risk_scores(_scored(spark, base), "p"))


_NORMALISED = """normalised AS (SELECT claim_id, d, 1 - (d - lo) / (hi - lo + 1e-9::DOUBLE) AS s, CAST(CASE WHEN d < 0 THEN 1 ELSE 0 END AS INT) AS is_anomaly
 FROM (SELECT claim_id, p - 0.05::DOUBLE AS d FROM scored), (SELECT MIN(p - 0.05::DOUBLE) AS lo, MAX(p - 0.05::DOUBLE) AS hi FROM scored))"""


@query(
    v.with_views(
        """SELECT claim_id, is_anomaly, ROUND(s, 4) AS anomaly_score, CAST(CASE WHEN s > 0.75 THEN 1 ELSE 0 END AS INT) AS fraud_flag FROM normalised""",
        v.CLAIMS, _SCORED, _NORMALISED,
    )
)
def normalised_anomalies(spark, base):
    scored = _scored(spark, base).select("claim_id", (F.col("p") - 0.05).alias("decision_score"))
    return fraud.flag_anomalies(scored).drop("decision_score")


@query(
    v.with_views(
        "SELECT CAST(SUM(is_anomaly) AS BIGINT) AS n_anomalies, RND(AVG(is_anomaly), 4) AS anomaly_rate FROM normalised",
        v.CLAIMS, _SCORED, _NORMALISED,
    )
)
def anomaly_summary(spark, base):
    scored = _scored(spark, base).select("claim_id", (F.col("p") - 0.05).alias("decision_score"))
    return rounded(reports.anomaly_summary(fraud.flag_anomalies(scored)))


@query(
    v.with_views(
        """SELECT claim_id, RND(c, 4) AS combined_fraud_score, CAST(CASE WHEN c > 0.5 THEN 1 ELSE 0 END AS INT) AS final_fraud_flag,
        CASE WHEN c > 0.75 THEN 'HIGH' WHEN c > 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level
        FROM (SELECT claim_id, ROUND(p * 0.5::DOUBLE + is_fraud * 0.3::DOUBLE + prediction * 0.2::DOUBLE, 4) AS c FROM scored)""",
        v.CLAIMS, _SCORED,
    )
)
def combined_fraud_scores(spark, base):
    scored = _scored(spark, base).select(
        "claim_id", F.col("p").alias("anomaly_score"), F.col("is_fraud").alias("high_fraud_cluster"),
        F.col("prediction").alias("is_anomaly"),
    )
    return rounded(
        fraud.combine_scores(scored).select("claim_id", "combined_fraud_score", "final_fraud_flag", "alert_level")
    )


@query(
    v.with_views(
        """SELECT CAST(k % 5 AS INT) AS cluster_id, COUNT(*) AS size, RND(ROUND(AVG(is_fraud), 4), 4) AS fraud_rate,
        CAST(CASE WHEN AVG(is_fraud) > 0.04 THEN 1 ELSE 0 END AS INT) AS high_fraud_cluster FROM scored GROUP BY 1""",
        v.CLAIMS, _SCORED,
    )
)
def cluster_profile(spark, base):
    assigned = _scored(spark, base).withColumn("cluster_id", (F.col("k") % 5).cast("int"))
    return rounded(fraud.cluster_profile(assigned, "is_fraud", 0.04))


_CENTRES = [[100000.0, 2.0, 0.0], [250000.0, 4.0, 0.0], [400000.0, 6.0, 7.0]]
_DISTANCE = "sqrt((claim_amount - {0})^2 + (num_procedures - {1})^2 + (days_in_hospital - {2})^2)"


@query(
    v.with_views(
        f"""SELECT claim_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INT) AS cluster_id,
        RND(ROUND(LEAST(d0, d1, d2), 4), 4) AS cluster_distance, CAST(CASE WHEN d2 < d0 AND d2 < d1 THEN 1 ELSE 0 END AS INT) AS high_fraud_cluster
        FROM (SELECT claim_id, {', '.join(_DISTANCE.format(*c) + f' AS d{i}' for i, c in enumerate(_CENTRES))} FROM claims)""",
        v.CLAIMS,
    )
)
def cluster_scores(spark, base):
    names = ["claim_amount", "num_procedures", "days_in_hospital"]
    scored = fraud.score_clusters(fx.claims(spark, base), names, _CENTRES, [2])
    return rounded(scored.select("claim_id", "cluster_id", "cluster_distance", "high_fraud_cluster"))


@query(
    v.with_views(
        """SELECT a.x AS antecedent, b.x AS consequent, RND(a.n / t, 4) AS antecedent_support, RND(b.n / t, 4) AS consequent_support,
        RND(p.n / t, 4) AS support, RND(p.n / a.n, 4) AS confidence, RND((p.n / a.n) / (b.n / t), 4) AS lift,
        RND(p.n / t - (a.n / t) * (b.n / t), 4) AS leverage, RND((1 - b.n / t) / (1 - p.n / a.n), 4) AS conviction
        FROM (SELECT x, y, CAST(COUNT(*) AS DOUBLE) AS n FROM (SELECT diagnosis_code AS x, procedure_code AS y FROM claims
                UNION ALL SELECT procedure_code, diagnosis_code FROM claims) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2) p
        JOIN items a ON p.x = a.x JOIN items b ON p.y = b.x, (SELECT CAST(COUNT(*) AS DOUBLE) AS t FROM claims)
        WHERE p.n / t >= 0.005 AND p.n / a.n >= 0.15""",
        v.CLAIMS,
        """items AS (SELECT x, CAST(COUNT(*) AS DOUBLE) AS n FROM (SELECT diagnosis_code AS x FROM claims UNION ALL SELECT procedure_code FROM claims)
          WHERE x IS NOT NULL GROUP BY 1)""",
    )
)
def code_association_rules(spark, base):
    """Thresholds low enough for the evenly spread fixture codes."""
    return rounded(fraud.association_rules(fx.claims(spark, base), 0.005, 0.15))


_AUCS = """aucs AS (SELECT claim_type AS model, CAST(row_number() OVER (ORDER BY claim_type) - 1 AS INT) AS position, AVG(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS auc
 FROM scored JOIN (SELECT claim_id AS c, claim_type FROM claims) ON claim_id = c GROUP BY 1)"""


def _aucs(spark, base):
    types = fx.claims(spark, base).select("claim_id", "claim_type")
    hit = (F.col("label") == F.col("prediction")).cast("double")
    per_type = _scored(spark, base).join(types, "claim_id").groupBy("claim_type").agg(F.avg(hit).alias("auc"))
    rows = {r["claim_type"]: r["auc"] for r in per_type.orderBy("claim_type").collect()}
    return evaluation.metrics_frame(spark, rows)


@query(
    v.with_views(
        "SELECT position, model, RND(auc, 4) AS auc, CASE WHEN auc >= 0.5 THEN 'PASS' ELSE 'FAIL' END AS status FROM aucs",
        v.CLAIMS, _SCORED, _AUCS,
    )
)
def quality_gate(spark, base):
    return rounded(evaluation.quality_gate(_aucs(spark, base), 0.5))


@query(v.with_views("SELECT position, model, RND(auc, 4) AS auc FROM aucs ORDER BY auc DESC, position LIMIT 1", v.CLAIMS, _SCORED, _AUCS))
def best_model(spark, base):
    return rounded(evaluation.best_model(_aucs(spark, base)))


# --- trained models: every row, and what SQL can state of its scores ------------------------------


def _claim_matrix(spark, base):
    claims = stage(joins.enrich_claims(fx.claims(spark, base), fx.members(spark, base)), "enriched")
    return stage(claim_features.ClaimFeatures().fit(claims).transform(claims), "claim-features")


def _band_of(risk):
    return F.expr(
        f"CASE WHEN {risk} <= 0 THEN 'none' WHEN {risk} <= 0.2 THEN 'Very Low' WHEN {risk} <= 0.4 THEN 'Low' "
        f"WHEN {risk} <= 0.6 THEN 'Medium' WHEN {risk} <= 0.8 THEN 'High' ELSE 'Very High' END"
    )


def risk_facts(scored, auc=None):
    """Keys, and whether probability, risk, band and decision agree up to the fourth digit."""
    p, band = F.col("approval_probability"), F.coalesce("risk_band", F.lit("none"))
    edge = F.lit(0.00005)
    facts = scored.select(
        "claim_id", "member_id",
        p.between(0, 1).alias("probability_ok"),
        (F.abs(F.col("risk_score") - (1 - p)) < 0.00015).alias("risk_ok"),
        ((band == _band_of("(risk_score - 0.00006)")) | (band == _band_of("(risk_score + 0.00006)"))).alias("band_ok"),
        F.when(p >= C.DECISION_THRESHOLD + edge, F.col("decision") == "Approve")
        .when(p <= C.DECISION_THRESHOLD - edge, F.col("decision") == "Review")
        .otherwise(F.col("decision").isin("Approve", "Review")).alias("decision_ok"),
    )
    return facts if auc is None else facts.withColumn("auc_ok", F.lit(bool(0.4 <= auc <= 1.0)))


RISK_FACTS = "claim_id, member_id, true AS probability_ok, true AS risk_ok, true AS band_ok, true AS decision_ok"


def _trained(family: str):
    def run(spark, base):
        features = _claim_matrix(spark, base)
        model = claim_models.train_claim(features, family)
        return risk_facts(model.risk_score(features), model.metrics["auc_roc"])

    run.__name__ = f"{family}_risk_scores"
    run.__doc__ = f"Every claim scored by the {family} model at its default settings."
    return run


for _family in claim_models.ALL_FAMILIES:
    query(v.with_views(f"SELECT {RISK_FACTS}, true AS auc_ok FROM claims", v.CLAIMS))(_trained(_family))


@query(v.with_views(f"SELECT {RISK_FACTS}, true AS same_ok FROM claims", v.CLAIMS))
def reloaded_claim_scores(spark, base):
    """A saved and loaded model gives the scores of the one that was trained."""
    features, path = _claim_matrix(spark, base), new_stage_path(spark, "claim-model")
    model = claim_models.train_claim(features, "logistic")
    model.save(path)
    before = model.risk_score(features).select("claim_id", F.col("approval_probability").alias("_before"))
    after = claim_models.ClaimModel.load("logistic", path).risk_score(features)
    joined = after.join(before, "claim_id")
    same = joined.select("claim_id", (F.col("_before") == F.col("approval_probability")).alias("same_ok"))
    return risk_facts(after).join(same, "claim_id")


@query("SELECT 'logistic' AS model, true AS mean_ok, true AS deviation_ok")
def cross_validated_auc(spark, base):
    """Mean and deviation of the AUC over five stratified folds of all claims."""
    mean, deviation = claim_models.cross_validate(_claim_matrix(spark, base), "logistic", "claim_approved", "claim_id")
    return spark.createDataFrame([("logistic", bool(0.4 <= mean <= 1), bool(0 <= deviation <= 0.2))], "model string, mean_ok boolean, deviation_ok boolean")


@query(
    "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in claim_features.FEATURES)
    + "]) AS feature, true AS importance_ok"
)
def logistic_feature_importance(spark, base):
    ranked = claim_models.train_claim(_claim_matrix(spark, base), "logistic").feature_importance(spark)
    return ranked.select("feature", (F.col("importance") >= 0).alias("importance_ok"))


@query(
    v.with_views(
        """SELECT claim_id, c.member_id, true AS probability_ok, true AS prediction_ok, true AS auc_ok
        FROM claims c JOIN members m ON c.member_id = m.member_id""",
        v.CLAIMS, v.MEMBERS,
    )
)
def lake_model_predictions(spark, base):
    """The lake model at its default rounds; claims of unknown members are skipped."""
    members = fx.members(spark, base).select(
        "member_id", "age", "bmi", "smoker", "plan_type", "num_chronic_conditions", "state"
    )
    joined = joins.skew_join(fx.claims(spark, base), members, "member_id", F.col("claim_id"))
    frame = stage(claim_features.lake_features(joined, 450000), "lake")
    model, auc = claim_models.train_claim_lake(frame)
    predicted = columns.prediction_view(model.transform(frame))
    p = F.col("approval_probability")
    return predicted.select(
        "claim_id", "member_id", p.between(0, 1).alias("probability_ok"),
        ((p > 0.5).cast("int") == F.col("predicted_approved")).alias("prediction_ok"),
        F.lit(bool(0.4 <= auc <= 1.0)).alias("auc_ok"),
    )


# --- boosted trees node by node ------------------------------------------------------------------

_TREE_COLUMNS = ("num_procedures", "days_in_hospital", "prior_auth", "amount_class")
_TREE_ROWS = f"""tree_rows AS (SELECT claim_id, CAST(is_fraud AS DOUBLE) AS y,
 [{", ".join(f"CAST({c} AS DOUBLE)" for c in _TREE_COLUMNS)}] AS x
 FROM (SELECT *, CAST(floor(claim_amount / 20000) AS INT) AS amount_class FROM claims))"""


def _best_split(name: str, rows: str, l2: float, least_h: float, least_n: int) -> str:
    """CTE ``name``: the split of ``rows`` (x, g, h) with the largest gain, and the sums on its sides."""
    return f"""{name} AS (SELECT *, gl * gl / (hl + {l2}) + gr * gr / (hr + {l2}) - g * g / (h + {l2}) AS gain FROM (
  SELECT *, g - gl AS gr, h - hl AS hr, n - nl AS nr FROM (
   SELECT f, t, SUM(cg) OVER below AS gl, SUM(ch) OVER below AS hl, SUM(cn) OVER below AS nl,
     SUM(cg) OVER (PARTITION BY f) AS g, SUM(ch) OVER (PARTITION BY f) AS h, SUM(cn) OVER (PARTITION BY f) AS n
   FROM (SELECT f, x[f] AS t, SUM(g) AS cg, SUM(h) AS ch, COUNT(*) AS cn FROM {rows}, (SELECT unnest([1, 2, 3, 4]) AS f) GROUP BY 1, 2)
   WINDOW below AS (PARTITION BY f ORDER BY t)))
  WHERE least(hl, hr) >= {least_h} AND least(nl, nr) >= {least_n} ORDER BY gain DESC, f, t LIMIT 1)"""


def _node(model: str, tree: str, depth: str, value: str, g: str, h: str, n: str, f: str = "NULL", t: str = "NULL") -> str:
    names = f"CASE {f} " + " ".join(f"WHEN {i + 1} THEN '{c}'" for i, c in enumerate(_TREE_COLUMNS)) + " END"
    return f"'{model}' AS model, {tree} AS tree, {depth} AS depth, {names} AS feature, RND(CAST({t} AS DOUBLE), 4) AS threshold, RND({value}, 4) AS value, RND({g}, 4) AS gradient, RND({h}, 4) AS hessian, CAST({n} AS BIGINT) AS n_rows"


_STUMPS = [
    "s0 AS (SELECT x, y, w, w * (0.5::DOUBLE - y) AS g, w * 0.25::DOUBLE AS h FROM (SELECT *, CASE WHEN y = 1 THEN 19.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM tree_rows))",
    _best_split("b0", "s0", 1.0, 1.0, 1),
    """s1 AS (SELECT x, w * (p - y) AS g, w * p * (1 - p) AS h FROM (SELECT s0.*, 1 / (1 + exp(-0.3::DOUBLE * CASE WHEN s0.x[b0.f] <= b0.t
      THEN -gl / (hl + 1) ELSE -gr / (hr + 1) END)) AS p FROM s0, b0))""",
    _best_split("b1", "s1", 1.0, 1.0, 1),
]
_BEST_FIRST = [
    """c0 AS (SELECT x, w * (0.5::DOUBLE - y) AS g, w * 0.25::DOUBLE AS h FROM (SELECT *, (SELECT COUNT(*) FROM tree_rows) / (2.0::DOUBLE * COUNT(*) OVER (PARTITION BY y)) AS w FROM tree_rows))""",
    _best_split("r0", "c0", 0.0, 0.001, 20),
    "cl AS (SELECT c0.* FROM c0, r0 WHERE c0.x[r0.f] <= r0.t)",
    "cr AS (SELECT c0.* FROM c0, r0 WHERE c0.x[r0.f] > r0.t)",
    _best_split("rl", "cl", 0.0, 0.001, 20),
    _best_split("rr", "cr", 0.0, 0.001, 20),
    "r1 AS (SELECT * FROM (SELECT *, 0 AS side FROM rl UNION ALL SELECT *, 1 FROM rr) ORDER BY gain DESC, side LIMIT 1)",
]
_STUMP_NODES = " UNION ALL ".join(
    f"""SELECT {_node("second_order", str(i), "0", "gain", "g", "h", "n", "f", "t")} FROM b{i}
    UNION ALL SELECT {_node("second_order", str(i), "1", "-gl / (hl + 1)", "gl", "hl", "nl")} FROM b{i}
    UNION ALL SELECT {_node("second_order", str(i), "1", "-gr / (hr + 1)", "gr", "hr", "nr")} FROM b{i}"""
    for i in (0, 1)
)


@query(
    v.with_views(
        f"""{_STUMP_NODES}
        UNION ALL SELECT {_node("best_first", "0", "0", "gain", "g", "h", "n", "f", "t")} FROM r0
        UNION ALL SELECT {_node("best_first", "0", "1", "gain", "g", "h", "n", "f", "t")} FROM r1
        UNION ALL SELECT {_node("best_first", "0", "2", "-gl / hl", "gl", "hl", "nl")} FROM r1
        UNION ALL SELECT {_node("best_first", "0", "2", "-gr / hr", "gr", "hr", "nr")} FROM r1
        UNION ALL SELECT {_node("best_first", "0", "1", "-go / ho", "go", "ho", "no")}
          FROM (SELECT CASE side WHEN 0 THEN r0.gr ELSE r0.gl END AS go, CASE side WHEN 0 THEN r0.hr ELSE r0.hl END AS ho,
            CASE side WHEN 0 THEN r0.nr ELSE r0.nl END AS no FROM r0, r1)""",
        v.CLAIMS, _TREE_ROWS, *_STUMPS, *_BEST_FIRST,
    )
)
def boosted_tree_nodes(spark, base):
    """Every node of two Newton stumps and of a best-first tree of three leaves, grown on all claims."""
    claims = fx.claims(spark, base).withColumn("amount_class", F.floor(F.col("claim_amount") / 20000))
    binned = boosting.bin_matrix(claims, _TREE_COLUMNS, "is_fraud")
    rules = {
        "second_order": boosting.Growth(rounds=2, step=0.3, max_depth=1, l2=1.0, min_hessian=1.0, positive_weight=19.0),
        "best_first": boosting.Growth(rounds=1, policy="loss", max_depth=None, max_leaves=3, l2=0.0, min_hessian=1e-3, min_rows=20, positive_weight=None),
    }
    parts = []
    for name, booster in zip(rules, boosting.train(binned, list(rules.values()))):
        value = F.coalesce("gain", "weight").alias("value")
        parts.append(booster.nodes(spark).select(
            F.lit(name).alias("model"), "tree", "depth", "feature", "threshold", value, "gradient", "hessian", "n_rows"
        ))
    return rounded(parts[0].unionByName(parts[1]))


def fraud_facts(scored):
    """Keys, and whether scores, clusters, the combined score and the alert agree."""
    score, combined = F.col("anomaly_score"), F.col("combined_fraud_score")
    weighed = 0.5 * score + 0.3 * F.col("high_fraud_cluster") + 0.2 * F.col("is_anomaly")
    return scored.select(
        "claim_id",
        score.between(0, 1).alias("score_ok"),
        (F.col("cluster_id").between(0, 4) & (F.col("cluster_distance") >= 0)).alias("cluster_ok"),
        (F.abs(combined - weighed) < 0.00011).alias("combined_ok"),
        (F.col("alert_level") == F.expr("CASE WHEN combined_fraud_score > 0.75 THEN 'HIGH' WHEN combined_fraud_score > 0.5 THEN 'MEDIUM' ELSE 'LOW' END")).alias("alert_ok"),
    )


FRAUD_FACTS = "claim_id, true AS score_ok, true AS cluster_ok, true AS combined_ok, true AS alert_ok"


@query(v.with_views(f"SELECT {FRAUD_FACTS}, true AS share_ok, true AS auc_ok FROM claims", v.CLAIMS))
def fraud_model_scores(spark, base):
    """Forest, clusters, classifier and their combination, trained on all claims at the default settings."""
    claims = stage(fx.claims(spark, base), "claims")
    _, features = fraud_features.FraudFeatures().fit_transform(claims)
    model = fraud_models.train_fraud(features)
    scored = stage(model.predict(features), "fraud-scores")
    row = scored.agg(F.sum("is_anomaly").alias("flagged"), F.count("*").alias("n")).first()
    share = abs(row["flagged"] - C.CONTAMINATION * row["n"]) <= 1 + 0.002 * row["n"]
    auc = model.metrics["supervised"]["auc_roc"]
    return fraud_facts(scored).withColumns({"share_ok": F.lit(bool(share)), "auc_ok": F.lit(bool(0.5 < auc <= 1))})


# --- recommendation -----------------------------------------------------------------------------

_RAREST = "(SELECT plan_type FROM members GROUP BY 1 ORDER BY COUNT(*), plan_type DESC LIMIT 1)"
_PLANS = "plans AS (SELECT unnest(['Bronze','Silver','Gold','Platinum']) AS plan, unnest([1,2,3,4]) AS premium, unnest([2,3,4,5]) AS coverage, unnest([4,3,2,1]) AS deductible_score)"
_COLLAB = f"""collab AS (SELECT member_id, plan, score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
 SELECT member_id, plan, CASE WHEN plan = plan_type AND plan <> {_RAREST} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM members, plans))"""


@query(v.with_views("SELECT member_id, plan, RND(score, 4) AS score, CAST(rank AS INT) AS rank FROM collab WHERE rank <= 3", v.MEMBERS, _PLANS, _COLLAB))
def collaborative_plans(spark, base):
    interactions = reports.interactions(fx.members(spark, base))
    return rounded(R.recommend_collab(R.fit_collab(interactions), interactions))


def _content_sql(source: str, income: str) -> str:
    return f"""content AS (SELECT member_id, plan, ROUND(score, 4) AS score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
 SELECT member_id, plan, (r * a + (1 - i) * b + i * c) / (sqrt(r * r + (1 - i) * (1 - i) + i * i) * sqrt(a * a + b * b + c * c)) AS score FROM (
 SELECT member_id, plan, age / 85.0::DOUBLE * 0.3::DOUBLE + num_chronic_conditions / 5.0::DOUBLE * 0.4::DOUBLE
   + (COALESCE(bmi, 25.0::DOUBLE) - 15) / 40.0::DOUBLE * 0.2::DOUBLE + 0.1::DOUBLE AS r, {income} AS i,
   coverage / 5.0::DOUBLE AS a, (5 - deductible_score) / 5.0::DOUBLE AS b, premium / 5.0::DOUBLE AS c FROM {source}, plans)))"""


@query(
    v.with_views(
        "SELECT member_id, plan, RND(score, 4) AS score, CAST(rank AS INT) AS rank FROM content WHERE rank <= 3",
        v.MEMBERS, v.PLAN_REQUESTS, _PLANS, _content_sql("plan_requests", "COALESCE(income_score, 0.5::DOUBLE)"),
    )
)
def content_plans(spark, base):
    return rounded(R.recommend_content(fx.plan_requests(spark, base)))


_Z = ", ".join(
    f"(COALESCE({c}, 0) - (SELECT AVG(COALESCE({c}, 0)) FROM members)) / (SELECT STDDEV_POP(COALESCE({c}, 0)) FROM members)"
    for c in C.PROFILE_COLUMNS
)
_NEIGHBOURS = f"""vectors AS (SELECT member_id, plan_type, [{_Z}] AS v FROM members),
neighbours AS (SELECT q.member_id, p.member_id AS neighbour, p.plan_type, GREATEST(0, 1 - list_cosine_similarity(q.v, p.v)) AS distance,
 row_number() OVER (PARTITION BY q.member_id ORDER BY GREATEST(0, 1 - list_cosine_similarity(q.v, p.v)), p.member_id) AS rank FROM vectors q, vectors p)"""
_KNN = """knn AS (SELECT member_id, plan, score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
 SELECT member_id, plan_type AS plan, SUM(1 / (distance + 1e-9::DOUBLE)) AS score FROM neighbours WHERE rank BETWEEN 2 AND 11 GROUP BY 1, 2))"""


@query(
    v.with_views(
        "SELECT member_id, CAST(rank AS INT) AS rank, neighbour, RND(distance, 4) AS distance FROM neighbours WHERE rank <= 5",
        v.MEMBERS, _NEIGHBOURS,
    )
)
def member_neighbours(spark, base):
    members = fx.members(spark, base)
    vectors = R.profile_vectors(members, R.fit_profile_scaler(members))
    return rounded(neighbours.knn_join(vectors, vectors, "member_id", "member_id", "vec", 5))


@query(
    """SELECT vec_id, CAST(rank AS INT) AS rank, neighbour, RND(distance, 4) AS distance FROM (SELECT q.vec_id, p.vec_id AS neighbour,
      1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])) AS distance,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])), p.vec_id) AS rank
      FROM embeddings q, embeddings p) WHERE rank <= 4""".replace("RND(", f"ROUND({v.ROUND_OFFSET:.7f}::DOUBLE + ")
)
def embedding_neighbours(spark, base):
    vectors = fx.table(spark, base, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return rounded(neighbours.knn_join(vectors, vectors, "vec_id", "vec_id", "v", 4))


@query(
    v.with_views(
        "SELECT member_id, plan, RND(ROUND(score, 4), 4) AS score, CAST(rank AS INT) AS rank FROM knn WHERE rank <= 3",
        v.MEMBERS, _NEIGHBOURS, _KNN,
    )
)
def knn_plans(spark, base):
    members = fx.members(spark, base)
    return rounded(R.recommend_knn(members, members))


@query(
    v.with_views(
        """SELECT member_id, plan, RND(score, 4) AS score, CAST(rank AS INT) AS rank FROM (
        SELECT member_id, plan, score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
        SELECT member_id, plan, SUM(s) AS score FROM (SELECT member_id, plan, 0.4::DOUBLE * score AS s FROM collab WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.35::DOUBLE * ROUND(score, 4) FROM knn WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.25::DOUBLE * score FROM content WHERE rank <= 4) GROUP BY 1, 2)) WHERE rank <= 3""",
        v.MEMBERS, v.PLAN_REQUESTS, _PLANS, _COLLAB, _NEIGHBOURS, _KNN,
        _content_sql("plan_requests", "COALESCE(income_score, 0.5::DOUBLE)"),
    )
)
def hybrid_plans(spark, base):
    members = fx.members(spark, base)
    return rounded(R.HybridRecommender.fit(members).recommend(fx.plan_requests(spark, base), digits=None))


# Requests that ask again: every third member a second time with another income, every fifth one twice alike, and
# people without a membership, some of them twice.
_REPEATED = """asked AS (SELECT member_id AS m, age, bmi, num_chronic_conditions, CAST(substr(member_id, 4) AS BIGINT) AS k, income_score FROM plan_requests),
repeated AS (SELECT * FROM asked UNION SELECT m, age, bmi, num_chronic_conditions, k, 0.95::DOUBLE FROM asked WHERE k % 3 = 0
  UNION SELECT 'NEW' || m, age, bmi, num_chronic_conditions, k, income_score FROM asked WHERE k % 7 = 0
  UNION SELECT 'NEW' || m, age, bmi, num_chronic_conditions, k, 0.95::DOUBLE FROM asked WHERE k % 14 = 0),
keyed AS (SELECT m || '/' || COALESCE(CAST(income_score AS VARCHAR), '') AS member_id, * FROM repeated)"""
_TIERS = """CASE WHEN age > 60 OR num_chronic_conditions >= 3 THEN ['Platinum','Gold','Silver']
 WHEN age > 40 OR num_chronic_conditions >= 1 THEN ['Gold','Silver','Platinum'] ELSE ['Silver','Bronze','Gold'] END AS p,
 CASE WHEN age > 60 OR num_chronic_conditions >= 3 THEN [0.90::DOUBLE, 0.75, 0.55]
 WHEN age > 40 OR num_chronic_conditions >= 1 THEN [0.85::DOUBLE, 0.72, 0.60] ELSE [0.88::DOUBLE, 0.70, 0.55] END AS s"""


@query(
    v.with_views(
        f"""SELECT m AS member_id, income_score, plan, RND(score, 4) AS score, CAST(rank AS INT) AS rank FROM (
        SELECT m, income_score, plan, score, row_number() OVER (PARTITION BY m, income_score ORDER BY score DESC, plan) AS rank FROM (
        SELECT m, income_score, plan, SUM(s) AS score FROM (
          SELECT m, income_score, plan, 0.4::DOUBLE * score AS s FROM keyed JOIN collab ON m = collab.member_id WHERE rank <= 4
          UNION ALL SELECT m, income_score, plan, 0.35::DOUBLE * ROUND(score, 4) FROM keyed JOIN knn ON m = knn.member_id WHERE rank <= 4
          UNION ALL SELECT m, income_score, plan, 0.25::DOUBLE * score FROM keyed JOIN content USING (member_id) WHERE rank <= 4 AND NOT starts_with(m, 'NEW'))
        GROUP BY 1, 2, 3)) WHERE rank <= 3
        UNION ALL SELECT m, income_score, plan, RND(score, 4), CAST(rank AS INT) FROM (
          SELECT m, income_score, unnest(p) AS plan, unnest(s) AS score, unnest([1, 2, 3]) AS rank FROM (SELECT m, income_score, {_TIERS} FROM keyed WHERE starts_with(m, 'NEW')))""",
        v.MEMBERS, v.PLAN_REQUESTS, _PLANS, _COLLAB, _NEIGHBOURS, _KNN, _REPEATED,
        _content_sql("keyed", "COALESCE(income_score, 0.5::DOUBLE)"),
    )
)
def hybrid_plans_repeated(spark, base):
    """Members that ask more than once, alike or not, and askers without a membership: every request by itself."""
    members, asked = fx.members(spark, base), fx.plan_requests(spark, base)
    key = F.substring("member_id", 4, 20).cast("long")
    new = F.concat(F.lit("NEW"), "member_id")
    again = [
        asked.where(key % 3 == 0).withColumn("income_score", F.lit(0.95)),
        asked.where(key % 5 == 0),
        asked.where(key % 7 == 0).withColumn("member_id", new),
        asked.where(key % 21 == 0).withColumn("member_id", new),
        asked.where(key % 14 == 0).withColumns({"member_id": new, "income_score": F.lit(0.95)}),
    ]
    requests = reduce(lambda a, b: a.unionByName(b), again, asked)
    incomes = R.with_request_id(requests).select("request_id", "income_score").distinct()
    answers = R.HybridRecommender.fit(members).answers(requests, digits=None)
    return rounded(answers.join(incomes, "request_id").drop("request_id"), "income_score")


@query(
    v.with_views(
        """SELECT member_id, plan, score, CAST(rank AS INT) AS rank FROM (SELECT member_id, unnest(p) AS plan, unnest(s) AS score, unnest([1, 2, 3]) AS rank FROM (
        SELECT member_id, CASE WHEN age > 60 OR num_chronic_conditions >= 3 THEN ['Platinum','Gold','Silver']
          WHEN age > 40 OR num_chronic_conditions >= 1 THEN ['Gold','Silver','Platinum'] ELSE ['Silver','Bronze','Gold'] END AS p,
        CASE WHEN age > 60 OR num_chronic_conditions >= 3 THEN [0.90::DOUBLE, 0.75, 0.55]
          WHEN age > 40 OR num_chronic_conditions >= 1 THEN [0.85::DOUBLE, 0.72, 0.60] ELSE [0.88::DOUBLE, 0.70, 0.55] END AS s FROM members))""",
        v.MEMBERS,
    )
)
def fallback_plans(spark, base):
    return R.recommend_fallback(fx.members(spark, base))


@query(
    v.with_views(
        """SELECT member_id, 'Based on your profile (age ' || age || ', ' || num_chronic_conditions || ' chronic conditions), the ' ||
        plan_type || ' plan offers the best balance of coverage and cost.' AS explanation,
        'CLM' || upper(substr(md5(member_id || '|' || plan_type), 1, 8)) AS request_id FROM members""",
        v.MEMBERS,
    )
)
def plan_explanations(spark, base):
    return fx.members(spark, base).select(
        "member_id",
        plan_explanation(F.col("age"), F.col("num_chronic_conditions"), F.col("plan_type")).alias("explanation"),
        S.request_claim_id(F.col("member_id"), F.col("plan_type")).alias("request_id"),
    )
