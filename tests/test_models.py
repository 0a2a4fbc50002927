"""Trained models: invariants, persistence, stored statistics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators import claim_features, fraud, notes, recommend, transforms
from claimlens.operators.claim_features import ClaimFeaturesModel
from claimlens.operators.fraud_features import FraudFeaturesModel
from claimlens.operators.ranking import plain_split
from claimlens.plans import claim_models, fraud_models
from claimlens.session import new_stage_path, stage


@pytest.fixture(scope="module")
def logistic(ready):
    return claim_models.train_claim(ready.claim_features, "logistic", folds=2)


@pytest.fixture(scope="module")
def fraud_model(ready):
    return fraud_models.train_fraud(ready.fraud_features, trees=40, restarts=2, rounds=5)


def test_feature_matrices_are_complete(ready, claims):
    n = claims.count()
    for df, names in ((ready.claim_features, claim_features.FEATURES), (ready.fraud_features, C.FRAUD_FEATURES)):
        nulls = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in names]).first()
        assert df.count() == n and sum(nulls) == 0
    assert {r[0] for r in ready.claim_features.select("claim_approved").distinct().collect()} == {0, 1}


def test_logistic_model(logistic, ready):
    assert 0 < logistic.metrics["auc_roc"] <= 1
    assert 0 < logistic.metrics["cv_auc_mean"] <= 1 and logistic.metrics["cv_auc_std"] >= 0
    scored = logistic.risk_score(ready.claim_features)
    assert scored.count() == ready.claim_features.count()
    assert scored.where("approval_probability NOT BETWEEN 0 AND 1").count() == 0
    assert {r[0] for r in scored.select("decision").distinct().collect()} <= {"Approve", "Review"}


@pytest.mark.parametrize("family", ["rf", "gbm", "xgboost", "lightgbm"])
def test_tree_families(ready, spark, family):
    model = claim_models.train_claim(ready.claim_features, family, rounds=3)
    assert 0 <= model.metrics["auc_roc"] <= 1
    importance = model.feature_importance(spark).collect()
    assert len(importance) == 20
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)


def test_claim_model_round_trip(logistic, ready, spark):
    path = new_stage_path(spark, "model")
    logistic.save(path)
    again = claim_models.ClaimModel.load("logistic", path)
    a, b = (m.risk_score(ready.claim_features) for m in (logistic, again))
    assert a.exceptAll(b).count() == 0


def test_feature_model_round_trip(ready, spark):
    path = new_stage_path(spark, "features")
    ready.claim_model.write().overwrite().save(path)
    again = ClaimFeaturesModel.load(path)
    assert again.transform(ready.claims).exceptAll(ready.claim_model.transform(ready.claims)).count() == 0
    ready.fraud_model.save_to(f"{path}-fraud")
    fraud_again = FraudFeaturesModel.load_from(spark, f"{path}-fraud")
    assert fraud_again.fitted == ready.fraud_model.fitted
    assert fraud_again.members.count() == ready.fraud_model.members.count()


def test_threshold_comes_from_the_fit(ready):
    one = ready.claims.orderBy(F.desc("claim_amount")).limit(1)
    flag = lambda df: df.select("high_cost_flag").first()[0]
    assert flag(ready.claim_model.transform(one)) > 0
    # a batch of one never exceeds its own 90th percentile
    assert flag(ready.claim_model.transform_with_batch_threshold(one)) < 0


def test_unseen_category_gets_its_own_code(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    model = transforms.LabelIndexer(columns=["c"]).fit(df)
    new = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "c string")
    assert [r["c"] for r in model.transform(new).collect()] == [1.0, 2.0, 0.0, 3.0]


def test_indexer_refuses_a_column_of_too_many_values(spark, monkeypatch):
    df = spark.range(8).selectExpr("cast(id as string) as c", "'x' as d")
    assert len(transforms.LabelIndexer(columns=["c"]).fit(df).fitted["c"]) == 8
    monkeypatch.setattr(transforms, "MAX_CODES", 8)
    assert len(transforms.LabelIndexer(columns=["c"]).fit(df).fitted["c"]) == 8
    with pytest.raises(ValueError, match="value_codes"):
        transforms.LabelIndexer(columns=["c", "d"]).fit(df)


def test_scalers_on_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "k double, x double")
    z = transforms.ZScaler(columns=["k", "x"]).fit(df).transform(df).collect()
    r = transforms.RangeScaler(columns=["k", "x"]).fit(df).transform(df).collect()
    assert [tuple(row) for row in z] == [(0.0, -1.0), (0.0, 1.0)]
    assert [tuple(row) for row in r] == [(0.0, 0.0), (0.0, 1.0)]


def test_fraud_model(fraud_model, ready, spark):
    assert len(fraud_model.metrics["clusters"]) == 5
    assert 0 < fraud_model.metrics["isolation_forest"]["anomaly_rate"] < 0.5
    scored = stage(fraud_model.predict(ready.fraud_features), "scored")
    assert scored.count() == ready.fraud_features.count()
    for name in ("anomaly_score", "combined_fraud_score"):
        assert scored.where(f"{name} NOT BETWEEN 0 AND 1").count() == 0
    path = new_stage_path(spark, "fraud")
    fraud_model.save_to(spark, path)
    again = fraud_models.FraudModel.load_from(spark, path, supervised=True)
    assert again.predict(ready.fraud_features).exceptAll(scored).count() == 0


def test_forest_finds_the_outlier(spark):
    rows = [(f"C{i}", float(i % 10), float(i % 7)) for i in range(600)] + [("far", 500.0, -300.0)]
    df = spark.createDataFrame(rows, "claim_id string, a double, b double")
    model = fraud.fit_forest(df, ["a", "b"], trees=50, sample=64)
    out = {r["claim_id"]: r for r in model.transform(df).collect()}
    assert out["far"]["anomaly_score"] == 1.0 and out["far"]["is_anomaly"] == 1
    assert sum(r["is_anomaly"] for r in out.values()) <= 0.06 * len(out)
    assert all(len(t["feature"]) <= 2 * 64 for t in model.trees)


def test_forest_is_repeatable(spark, ready):
    runs = [fraud.fit_forest(ready.fraud_features, list(C.FRAUD_FEATURES), trees=5) for _ in range(2)]
    assert runs[0].trees == runs[1].trees and runs[0].offset == runs[1].offset


def test_rows_of_one_claim_share_a_basket(spark):
    rows = [("a", "X", "P"), ("a", "Y", "P"), ("a", None, None), ("b", "X", "P"), ("c", None, None), (None, "X", "Q"), (None, "Y", "Q")]
    claims = spark.createDataFrame(rows, "claim_id string, diagnosis_code string, procedure_code string")
    found = sorted(((r["claim_id"] or "", r["items"]) for r in fraud.baskets(claims).collect()))
    assert found == [("", ["Q", "X"]), ("", ["Q", "Y"]), ("a", ["P", "X", "Y"]), ("b", ["P", "X"]), ("c", [])]
    claims = claims.where("claim_id IN ('a', 'b')")
    rules = {(r["antecedent"], r["consequent"]): r["support"] for r in fraud.association_rules(claims, 0.01, 0.5).collect()}
    assert rules[("Y", "X")] == 0.5 and rules[("P", "X")] == 1.0


def test_association_rules_measure_whole_baskets(spark):
    rows = [("c1", "d1", "p1"), ("c2", "d1", "p1"), ("c3", "d2", "p1"), ("c4", None, None)]
    claims = spark.createDataFrame(rows, "claim_id string, diagnosis_code string, procedure_code string")
    rules = {(r["antecedent"], r["consequent"]): r for r in fraud.association_rules(claims, 0.01, 0.5).collect()}
    sure = rules["d1", "p1"]
    assert (sure["support"], sure["confidence"], sure["antecedent_support"]) == (0.5, 1.0, 0.5)
    assert sure["lift"] == pytest.approx(4 / 3) and sure["conviction"] == float("inf")
    assert sure["leverage"] == pytest.approx(0.5 - 0.5 * 0.75)


def test_note_classifier_learns_rules(spark):
    texts = ["patient has hypertension", "type 2 diabetes mellitus", "asthma attack", "knee pain"]
    rows = [(f"N{i}", texts[i % 4] + f" visit {i % 9}", f"D{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "note_id string, clean_text string, diagnosis_code string")
    classifier = notes.train_note_classifier(df)
    assert classifier.holdout_accuracy > 0.95
    out = classifier.predict(df)
    assert out.where("confidence NOT BETWEEN 0 AND 1").count() == 0
    assert out.where("predicted_label = diagnosis_code").count() > 190


def test_text_classifier_predicts_trained_labels_only(spark):
    """More classes than texts can tell apart, a rare one, one that only held-out rows have, and rows without a label."""
    rows = [(f"N{i}", f"common words all over visit {i % 13}", f"D{i % 9}" if i % 3 else f"D{i % 2}") for i in range(400)]
    rows += [(f"X{i}", "", None) for i in range(20)]
    df = spark.createDataFrame(rows, "note_id string, clean_text string, diagnosis_code string")
    split = plain_split(df.where("diagnosis_code IS NOT NULL"), "note_id").collect()
    held_out = next(r["note_id"] for r in split if r["is_test"] == 1)
    df = df.withColumn("diagnosis_code", F.when(F.col("note_id") == held_out, "ONLY HELD OUT").otherwise(F.col("diagnosis_code")))
    classifier = notes.train_note_classifier(df)
    trained = {r["diagnosis_code"] for r in split if r["is_test"] == 0}
    assert set(classifier.labels) == trained and classifier.unseen == 1
    predicted = {r["predicted_label"] for r in classifier.predict(df).collect()}
    assert predicted <= trained and len(trained) == 7


def test_hybrid_recommender(members, spark):
    recommender = recommend.HybridRecommender.fit(members)
    strangers = spark.createDataFrame([("NEW", 65, 30.0, 3, 12, 5000.0, 1000)],
        "member_id string, age int, bmi double, num_chronic_conditions int, tenure_months int, annual_premium double, deductible int")
    profiles = members.limit(20).select(*strangers.columns).unionByName(strangers)
    out = recommender.recommend(profiles, 3)
    assert out.select("member_id").distinct().count() == 21
    rules = [r["plan"] for r in out.where("member_id = 'NEW'").orderBy("rank").collect()]
    assert rules == ["Platinum", "Gold", "Silver"]
    path = new_stage_path(spark, "recommender")
    recommender.save_to(path)
    again = recommend.HybridRecommender.load_from(spark, path).recommend(profiles, 3)
    columns = ["member_id", "plan", "rank"]
    assert again.select(columns).exceptAll(out.select(columns)).count() == 0
