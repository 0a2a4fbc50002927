"""Trained models on few columns, so that SQL can train them too and every value is compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import fixtures as fx
from claimlens.operators.claim_features import FEATURES
from claimlens.plans import claim_models, jobs
from verification import fixture_sql as v
from verification.q_features import claim_feature_matrix, fraud_feature_matrix
from verification.registry import REGISTRY, query, rounded

_COLUMNS = ("procedures", "prior_auth")
_GBM_ROUNDS = 3

_ROWS = """model_rows AS (SELECT claim_id, y, x1, x2, CASE WHEN rn <= round(n * 0.2::DOUBLE) THEN 1 ELSE 0 END AS is_test, (rn - 1) % 5 AS fold FROM (
 SELECT claim_id, is_fraud AS y, CAST(least(num_procedures, 4) AS DOUBLE) AS x1, CAST(prior_auth AS DOUBLE) AS x2,
 row_number() OVER (PARTITION BY is_fraud ORDER BY md5(claim_id || '|42'), claim_id) AS rn, COUNT(*) OVER (PARTITION BY is_fraud) AS n FROM claims))"""


def _model_rows(spark, base):
    return fx.claims(spark, base).select(
        "claim_id", "member_id", "is_fraud", F.least("num_procedures", F.lit(4)).cast("double").alias("procedures"),
        F.col("prior_auth").cast("double").alias("prior_auth"),
    )


# --- logistic: weighted and penalised Newton steps in SQL, for the training rows (m = -1) and without each fold ----

_STEPS = 12


def _newton(step: int) -> str:
    """Coefficients after ``step`` steps: the 3 x 3 system of each model by Cramer's rule."""
    if step == 0:
        return "t0 AS MATERIALIZED (SELECT DISTINCT m, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM cells)"
    return f"""t{step} AS MATERIALIZED (SELECT m,
 b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS b0,
 b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS b1,
 b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS b2
 FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM (
  SELECT m, b0, b1, b2, SUM(r) AS g0, SUM(r * x1) + MAX(lam) * b1 AS g1, SUM(r * x2) + MAX(lam) * b2 AS g2,
   SUM(s) AS h00, SUM(s * x1) AS h01, SUM(s * x2) AS h02, SUM(s * x1 * x1) + MAX(lam) AS h11, SUM(s * x1 * x2) AS h12, SUM(s * x2 * x2) + MAX(lam) AS h22
  FROM (SELECT *, w * (p - y) AS r, w * p * (1 - p) AS s FROM (
   SELECT cells.*, b0, b1, b2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM cells JOIN t{step - 1} USING (m)))
  GROUP BY m, b0, b1, b2)))"""


_LOGISTIC = [
    _ROWS,
    """weights AS (SELECT y, COUNT(*) AS n_all, COUNT(*) FILTER (is_test = 0) AS n_train FROM model_rows GROUP BY y)""",
    """class_weights AS (SELECT y, SUM(n_all) OVER () / (2.0::DOUBLE * n_all) AS w_all, SUM(n_train) OVER () / (2.0::DOUBLE * n_train) AS w_train,
 SUM(n_all) OVER () AS n_rows FROM weights)""",
    """cells AS MATERIALIZED (SELECT m, y, x1, x2, w, CASE WHEN m = -1 THEN 1.0::DOUBLE ELSE SUM(w) OVER (PARTITION BY m) / floor(n_rows * 0.8::DOUBLE) END AS lam FROM (
 SELECT -1 AS m, y, x1, x2, SUM(w_train) AS w, MAX(n_rows) AS n_rows FROM model_rows JOIN class_weights USING (y) WHERE is_test = 0 GROUP BY ALL
 UNION ALL SELECT f.m, y, x1, x2, SUM(w_all), MAX(n_rows) FROM model_rows JOIN class_weights USING (y) JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS m) f ON fold <> f.m GROUP BY ALL))""",
    *[_newton(i) for i in range(_STEPS + 1)],
]

_LOGISTIC_AUC = f"""aucs AS (SELECT m, SUM(pos * (below + neg / 2)) / (SUM(pos) * SUM(neg)) AS auc FROM (
 SELECT *, SUM(neg) OVER (PARTITION BY m ORDER BY z ROWS UNBOUNDED PRECEDING) - neg AS below FROM (
  SELECT m, b0 + b1 * x1 + b2 * x2 AS z, CAST(SUM(y) AS DOUBLE) AS pos, CAST(SUM(1 - y) AS DOUBLE) AS neg
  FROM model_rows JOIN t{_STEPS} ON (m = -1 AND is_test = 1) OR m = fold GROUP BY 1, 2)) GROUP BY m)"""


def _logistic(spark, base, folds=0):
    rows = _model_rows(spark, base)
    return claim_models.train_claim(rows, "logistic", "is_fraud", columns=_COLUMNS, folds=folds), rows


def _three_digits(column: str):
    return F.round(F.col(column) + 0.000123, 3).alias(column)


@query(
    v.with_views(
        f"""SELECT claim_id, ROUND(p + 0.000123::DOUBLE, 3) AS probability, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INT) AS prediction
        FROM (SELECT claim_id, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM model_rows, (SELECT * FROM t{_STEPS} WHERE m = -1))""",
        v.CLAIMS, *_LOGISTIC,
    )
)
def logistic_values(spark, base):
    """Fraud probability of every claim by the logistic model of two columns, trained on 80 % of either class."""
    model, rows = _logistic(spark, base)
    return model.predict(rows).select("claim_id", _three_digits("probability"), "prediction")


@query(
    v.with_views(
        f"""SELECT 'auc_roc' AS metric, RND(auc, 4) AS value FROM aucs WHERE m = -1
        UNION ALL SELECT 'cv_auc_mean', RND(AVG(auc), 4) FROM aucs WHERE m >= 0
        UNION ALL SELECT 'cv_auc_std', RND(STDDEV_POP(auc), 4) FROM aucs WHERE m >= 0
        UNION ALL SELECT 'training_rows', CAST(COUNT(*) AS DOUBLE) FROM model_rows WHERE is_test = 0
        UNION ALL SELECT 'importance_procedures', ROUND(abs(b1) + 0.000123::DOUBLE, 3) FROM t{_STEPS} WHERE m = -1
        UNION ALL SELECT 'importance_prior_auth', ROUND(abs(b2) + 0.000123::DOUBLE, 3) FROM t{_STEPS} WHERE m = -1""",
        v.CLAIMS, *_LOGISTIC, _LOGISTIC_AUC,
    )
)
def logistic_metrics(spark, base):
    """AUC of the test rows, mean and deviation over five folds, and the importance of both columns."""
    model, _ = _logistic(spark, base, folds=5)
    values = [(k, float(model.metrics[k])) for k in ("auc_roc", "cv_auc_mean", "cv_auc_std")]
    measured = rounded(spark.createDataFrame(values, "metric string, value double"))
    n_rows = spark.createDataFrame([("training_rows", float(model.metrics["training_rows"]))], "metric string, value double")
    ranked = model.feature_importance(spark, _COLUMNS).select(
        F.concat(F.lit("importance_"), "feature").alias("metric"), F.round(F.col("importance") + 0.000123, 3).alias("value")
    )
    return measured.unionByName(n_rows).unionByName(ranked)


# --- trees: with few values in two columns a tree of the family's depth ends in one leaf per pair of values ----------


def _boosted_margin(step: int) -> str:
    """Margin of each pair of values after ``step`` further trees; a tree's leaf is the mean negative gradient."""
    if step == 0:
        return "f0 AS (SELECT x1, x2, AVG(2.0::DOUBLE * y - 1) AS f, AVG(CAST(y AS DOUBLE)) AS share FROM model_rows WHERE is_test = 0 GROUP BY 1, 2)"
    return f"""f{step} AS (SELECT x1, x2, share, f + 0.05::DOUBLE * (share * 4 / (1 + exp(2 * f)) - (1 - share) * 4 / (1 + exp(-2 * f))) AS f FROM f{step - 1})"""


@query(
    v.with_views(
        f"""SELECT claim_id, RND(1 / (1 + exp(-2 * f)), 4) AS probability, CAST(CASE WHEN f >= 0 THEN 1 ELSE 0 END AS INT) AS prediction
        FROM model_rows JOIN f{_GBM_ROUNDS - 1} USING (x1, x2)""",
        v.CLAIMS, _ROWS, *[_boosted_margin(i) for i in range(_GBM_ROUNDS)],
    )
)
def gbm_values(spark, base):
    """Fraud probability of every claim by three boosted trees over two columns."""
    rows = _model_rows(spark, base)
    model = claim_models.train_claim(rows, "gbm", "is_fraud", columns=_COLUMNS, rounds=_GBM_ROUNDS)
    return rounded(model.predict(rows).select("claim_id", "probability", "prediction"))


@query(
    v.with_views(
        """SELECT claim_id, prediction FROM model_rows JOIN (
          SELECT x1, x2, CAST(CASE WHEN SUM(CASE WHEN y = 1 THEN w ELSE -w END) >= 0 THEN 1 ELSE 0 END AS INT) AS prediction
          FROM (SELECT *, 1.0::DOUBLE / COUNT(*) OVER (PARTITION BY y) AS w FROM model_rows WHERE is_test = 0) GROUP BY 1, 2) USING (x1, x2)""",
        v.CLAIMS, _ROWS,
    )
)
def one_tree_forest_predictions(spark, base):
    """Fraud prediction of every claim by a forest of one balanced tree over two columns."""
    rows = _model_rows(spark, base)
    model = claim_models.train_claim(rows, "rf", "is_fraud", columns=_COLUMNS, rounds=1)
    return model.predict(rows).select("claim_id", "prediction")


# --- the combined preprocessing, column by column ---------------------------------------------------------------

_CLAIM_NUMBER = "CAST(substr(claim_id, 4) AS BIGINT) % 97"


def _units(column: str) -> str:
    """The fourth digit's units of a rounded value: their sums are exact."""
    return f"CAST(ROUND({column} * 10000) AS BIGINT)"


def _column_sums(matrix: str, names, source: str) -> str:
    parts = [
        f"SELECT '{matrix}' AS matrix, '{c}' AS part, CAST(SUM({_units(c)}) AS BIGINT) AS total, CAST(SUM({_units(c)} * ({_CLAIM_NUMBER})) AS BIGINT) AS mixed, MIN({c}) AS low, MAX({c}) AS high FROM {source}"
        for c in names
    ]
    return " UNION ALL ".join(parts)


@query(
    f"""WITH claim_matrix AS ({REGISTRY[claim_feature_matrix.__name__][1]}), fraud_matrix AS ({REGISTRY[fraud_feature_matrix.__name__][1]})
    {_column_sums("claim_features", FEATURES, "claim_matrix")} UNION ALL {_column_sums("fraud_features", C.FRAUD_FEATURES, "fraud_matrix")}"""
)
def preprocessed_columns(spark, base):
    """Sum, sum weighted by the claim's number, minimum and maximum of every column of both matrices of one preprocessing."""
    ready = jobs.preprocess_all({"claims": fx.claims(spark, base), "members": fx.members(spark, base)})
    number = F.expr(_CLAIM_NUMBER)
    out = None
    for matrix, df, names in (("claim_features", ready.claim_features, FEATURES), ("fraud_features", ready.fraud_features, C.FRAUD_FEATURES)):
        sums = rounded(df.select("claim_id", *names)).agg(F.array(*[
            F.struct(F.lit(c).alias("part"), F.sum(F.expr(_units(c))).alias("total"), F.sum(F.expr(_units(c)) * number).alias("mixed"),
                     F.min(c).alias("low"), F.max(c).alias("high"))
            for c in names
        ]).alias("columns"))
        rows = sums.select(F.lit(matrix).alias("matrix"), F.inline("columns"))
        out = rows if out is None else out.unionByName(rows)
    return out
