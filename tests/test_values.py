"""Worked values of single functions."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions import scalars as S
from claimlens.functions import text as X
from claimlens.functions import vectors as V
from claimlens.operators import columns, evaluation, notes, quality, recommend, reports


def one(spark, column, **values):
    names = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], names).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("New PT, no hx of cad; hr 70 & bp low.", "new patient, no history of coronary artery disease heart rate 70 blood pressure low."),
        ("sob with cp", "shortness of breath with chest pain"),
        ("PT pt,pt.n/v  (N/V)", "patient patient,patient.nausea vomiting nausea vomiting"),
        ("apt dmx épt", "apt dmx pt"),
        ("  tabs\tand\nlines!! ", "tabs and lines"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_text(spark, text, expected):
    assert one(spark, X.clean_text(F.col("t")), t=("string", text)) == expected


def test_short_cleaner_leaves_other_abbreviations(spark):
    cleaned = one(spark, X.clean_text(F.col("t"), C.ABBREVIATIONS_SHORT), t=("string", "Pt CKD hr dx"))
    assert cleaned == "patient ckd hr diagnosis"


@pytest.mark.parametrize(
    "text, code, confidence",
    [
        ("seen for hypertension", "I10", 0.85),
        ("diabetes with chest pain", "E11", 0.82),
        ("chest pain, coronary artery disease", "M54", 0.70),
        ("wound healing well", "J06", 0.60),
    ],
)
def test_keyword_diagnosis(spark, text, code, confidence):
    got = one(spark, X.keyword_diagnosis(F.col("t")), t=("string", text))
    assert (got["code"], got["confidence"]) == (code, confidence)


FEEDBACK = [
    ("smooth words and great ones", "POSITIVE", "POSITIVE"),
    ("rejected, then a slow answer", "NEGATIVE", "NEGATIVE"),
    ("helpful clerk, form confusing.", "POSITIVE", "NEUTRAL"),
    ("fast! fast! and frustrating", "NEUTRAL", "NEUTRAL"),
    ("awful and terrible but smoothly done", "NEGATIVE", "POSITIVE"),
]


@pytest.mark.parametrize("text, by_token, by_substring", FEEDBACK)
def test_sentiment(spark, text, by_token, by_substring):
    assert one(spark, X.keyword_sentiment(F.col("t"), "token"), t=("string", text)) == by_token
    assert one(spark, X.keyword_sentiment(F.col("t"), "substring"), t=("string", text)) == by_substring


@pytest.mark.parametrize(
    "risk, band",
    [(0.0, None), (0.2, "Very Low"), (0.2001, "Low"), (0.4, "Low"), (0.6, "Medium"), (1.0, "Very High"), (None, None)],
)
def test_risk_band(spark, risk, band):
    assert one(spark, S.risk_band(F.col("r")), r=("double", risk)) == band


@pytest.mark.parametrize("score, level", [(0.75, "MEDIUM"), (0.76, "HIGH"), (0.5, "LOW"), (0.51, "MEDIUM")])
def test_alert_level(spark, score, level):
    assert one(spark, S.alert_level(F.col("s")), s=("double", score)) == level


def test_clip_keeps_null_and_bounds(spark):
    assert one(spark, S.clip(F.col("x"), 0, 1), x=("double", None)) is None
    assert one(spark, S.clip(F.col("x"), 0, 1), x=("double", 1.5)) == 1.0
    assert one(spark, S.at_least_one(F.col("x")), x=("int", 0)) == 1


CONTENT = [
    ((65, 30.0, 3, 0.3), [("Platinum", 0.9589), ("Gold", 0.9588), ("Silver", 0.9562), ("Bronze", 0.9366)]),
    ((25, 22.0, 0, 0.7), [("Platinum", 0.8539), ("Gold", 0.8413), ("Silver", 0.8159), ("Bronze", 0.7441)]),
    ((45, 28.0, 1, 0.5), [("Platinum", 0.9791), ("Gold", 0.9720), ("Silver", 0.9565), ("Bronze", 0.9063)]),
]


@pytest.mark.parametrize("profile, expected", CONTENT)
def test_content_recommender(spark, profile, expected):
    df = spark.createDataFrame([("m", *profile)], "member_id string, age int, bmi double, num_chronic_conditions int, income_score double")
    rows = recommend.recommend_content(df, 4).orderBy("rank").collect()
    assert [(r["plan"], r["score"]) for r in rows] == expected


@pytest.mark.parametrize(
    "age, chronic, plans",
    [
        (61, 0, [("Platinum", 0.90), ("Gold", 0.75), ("Silver", 0.55)]),
        (41, 0, [("Gold", 0.85), ("Silver", 0.72), ("Platinum", 0.60)]),
        (30, 0, [("Silver", 0.88), ("Bronze", 0.70), ("Gold", 0.55)]),
        (30, 3, [("Platinum", 0.90), ("Gold", 0.75), ("Silver", 0.55)]),
        (30, 1, [("Gold", 0.85), ("Silver", 0.72), ("Platinum", 0.60)]),
    ],
)
def test_fallback_plans(spark, age, chronic, plans):
    df = spark.createDataFrame([("m", age, chronic)], "member_id string, age int, num_chronic_conditions int")
    rows = recommend.recommend_fallback(df).orderBy("rank").collect()
    assert [(r["plan"], r["score"]) for r in rows] == plans


def test_explanation_defaults_to_silver(spark):
    text = one(spark, X.plan_explanation(F.col("a"), F.col("c"), F.col("p")), a=("int", 50), c=("int", 2), p=("string", None))
    assert text == (
        "Based on your profile (age 50, 2 chronic conditions), "
        "the Silver plan offers the best balance of coverage and cost."
    )


def test_vector_functions(spark):
    sql = "a array<double>, b array<double>"
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], sql)
    assert [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [0.96, 0.0]
    assert one(spark, V.argmax(F.col("p")), p=("array<double>", [0.1, 0.7, 0.7])) == 1


def test_vocabulary_and_encoding(spark):
    df = spark.createDataFrame([("b a a",), ("c b a",), ("",)], "clean_text string")
    vocab = notes.build_vocab(df, "clean_text", 4)
    assert [(r["word"], r["word_id"]) for r in vocab.orderBy("word_id").collect()] == [("a", 2), ("b", 3)]
    encoded = notes.encode_notes(df, notes.Vocabulary.of(vocab), max_len=2).collect()
    assert [r["token_ids"] for r in encoded] == [[3, 2], [1, 3], [0, 0]]


def test_request_id_is_stable(spark):
    a = one(spark, S.request_claim_id(F.col("k")), k=("string", "M1"))
    assert a == one(spark, S.request_claim_id(F.col("k")), k=("string", "M1"))
    assert a.startswith("CLM") and len(a) == 11 and a[3:] == a[3:].upper()


def test_validation_names_every_broken_rule(spark):
    df = spark.createDataFrame(
        [("C1", None, "Dental", -1.0, "Approved"), ("C2", datetime.date(2024, 1, 1), None, None, None)],
        "claim_id string, claim_date date, claim_type string, claim_amount double, claim_status string",
    )
    ok, bad = quality.validate(df, quality.CLAIM_RULES)
    assert [r["claim_id"] for r in ok.collect()] == ["C2"]
    assert bad.first()["broken_rules"] == ["date_present", "type_known", "amount_positive"]


def test_normalise_and_defaults(spark):
    df = spark.createDataFrame([(1, 2)], "age int, member_age int")
    assert columns.normalise_columns(df).columns == ["age", "member_age"]
    out = columns.with_defaults(df.drop("age"), C.ENRICHED_DEFAULTS).first()
    assert (out["member_age"], out["member_plan"], out["member_bmi"]) == (2, "Silver", 25.0)


def test_provider_without_claims(spark):
    providers = spark.createDataFrame([("P1", "n", "t", "s"), ("P2", "n", "t", "s")], "provider_id string, provider_name string, provider_type string, state string")
    claims = spark.createDataFrame([("C1", "P1", 10.0, 1)], "claim_id string, provider_id string, claim_amount double, is_fraud int")
    rows = {r["provider_id"]: r for r in reports.provider_fraud_risk(providers, claims).collect()}
    assert rows["P1"]["fraud_rate_pct"] == 100.0
    assert (rows["P2"]["total_claims"], rows["P2"]["fraud_claims"], rows["P2"]["fraud_rate_pct"]) == (0, None, None)


def test_best_model_takes_first_of_equal(spark):
    metrics = evaluation.metrics_frame(spark, {"b": 0.7, "a": 0.9, "c": 0.9})
    assert evaluation.best_model(metrics).first()["model"] == "a"
    with pytest.raises(ValueError, match="b"):
        evaluation.enforce_gate(metrics, 0.75)
    assert evaluation.enforce_gate(metrics, 0.5).count() == 3


def test_roc_auc_edges(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "label int, score double")
    assert evaluation.roc_auc(df).first()["auc"] == pytest.approx(0.875)
    assert evaluation.roc_auc(df.where("label = 1")).first()["auc"] is None


def test_report_with_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert (rows["1"]["precision"], rows["1"]["recall"], rows["1"]["f1_score"]) == (0.0, 0.0, 0.0)
    assert rows["accuracy"]["precision"] == pytest.approx(2 / 3)
    assert rows["weighted avg"]["recall"] == pytest.approx(2 / 3)
