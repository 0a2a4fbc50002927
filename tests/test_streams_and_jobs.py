"""Streams give what the batch gives; jobs write every declared output; sources repair and fall back."""

from __future__ import annotations

import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from claimlens import fixtures as fx
from claimlens import schemas
from claimlens.operators import recommend
from claimlens.plans import claim_models, fraud_models, jobs
from claimlens.session import new_stage_path, stage, stage_dir, staging
from claimlens.sources import readers, writers
from claimlens.streaming import scoring
from verification.harness import connect, differences, oracle_rows, spark_rows
from verification.load import REGISTRY


def as_stream(spark, df, name):
    path = new_stage_path(spark, name)
    writers.append_documents(df.repartition(3), path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(path), spark.read.schema(df.schema).json(path)


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    assert a.count() == b.count()
    assert a.select(columns).exceptAll(b.select(columns)).count() == 0


def outputs(spark, name):
    return new_stage_path(spark, f"{name}-out"), new_stage_path(spark, f"{name}-checkpoint")


def test_claim_stream_equals_batch(spark, base, ready):
    model = claim_models.train_claim(ready.claim_features, "logistic", rounds=20)
    stream, batch = as_stream(spark, fx.claim_requests(spark, base), "claim-requests")
    out, checkpoint = outputs(spark, "claims")
    scoring.stream_claims(stream, ready.claim_model, model, out, checkpoint).awaitTermination()
    want = scoring.score_claims(batch, ready.claim_model, model)
    same(spark.read.parquet(f"{out}/scored").drop("batch_id"), want["scored"])
    same(spark.read.parquet(f"{out}/quarantine").drop("batch_id"), want["quarantine"])


def test_fraud_stream_equals_batch(spark, claims, ready):
    model = fraud_models.train_fraud(ready.fraud_features, trees=20, restarts=1, supervised=False)
    requests = claims.select(*[F.col(n) if n in claims.columns else F.lit(None).cast(schemas.FRAUD_REQUEST[n].dataType).alias(n) for n in schemas.FRAUD_REQUEST.names])
    stream, batch = as_stream(spark, requests, "fraud-requests")
    out, checkpoint = outputs(spark, "fraud")
    scoring.stream_fraud(stream, ready.fraud_model, model, out, checkpoint).awaitTermination()
    want = scoring.score_fraud(batch, ready.fraud_model, model)
    same(spark.read.parquet(f"{out}/scored").drop("batch_id"), want["scored"])
    assert want["quarantine"].count() == claims.where("provider_id IS NULL").count()


def test_note_stream_equals_batch(spark, base):
    stream, batch = as_stream(spark, fx.notes(spark, base).select("note_id", "clinical_note"), "note-requests")
    out, checkpoint = outputs(spark, "notes")
    scoring.stream_notes(stream, out, checkpoint).awaitTermination()
    want = scoring.analyze_requests(batch)
    same(spark.read.parquet(f"{out}/analysed").drop("batch_id"), want["analysed"])
    same(spark.read.parquet(f"{out}/quarantine").drop("batch_id"), want["quarantine"])


def test_short_note_is_rejected(spark):
    rows = spark.createDataFrame([(None, "long enough note"), ("N2", "short"), ("N3", None)], schemas.NOTE_REQUEST)
    parts = scoring.analyze_requests(rows)
    assert [r["note_id"] for r in parts["analysed"].collect()] == ["NOTE000001"]
    assert sorted(r["note_id"] for r in parts["quarantine"].collect()) == ["N2", "N3"]


def test_recommendation_stream_equals_batch(spark, base, members):
    recommender = recommend.HybridRecommender.fit(members)
    stream, batch = as_stream(spark, fx.plan_requests(spark, base), "plan-requests")
    out, checkpoint = outputs(spark, "plans")
    scoring.stream_recommendations(stream, recommender, out, checkpoint).awaitTermination()
    want = scoring.recommend_requests(batch, recommender)
    got = spark.read.parquet(f"{out}/recommended").drop("batch_id")
    assert got.count() == want["recommended"].count() == members.where("bmi IS NOT NULL").count()
    plans = lambda df: df.select("member_id", F.col("recommendations.plan").alias("p"), "explanation")
    assert plans(got).exceptAll(plans(want["recommended"])).count() == 0


def test_full_job(spark, base, claims, members):
    out = new_stage_path(spark, "job")
    tables = {"claims": claims, "members": members, "providers": fx.providers(spark, base), "notes": fx.notes(spark, base)}
    gated = jobs.run(
        tables, out, families=("logistic", "xgboost"), rounds={"logistic": 20, "xgboost": 3}, fraud_rounds=3,
        restarts=1, folds=0, min_auc=0.0,
    )
    assert {r["model"] for r in gated.collect()} == {"claim_logistic", "claim_xgboost", "fraud_auc"}
    n = claims.count()
    assert spark.read.parquet(f"{out}/claim_predictions").count() == n
    assert spark.read.parquet(f"{out}/fraud_predictions").count() == n
    assert spark.read.parquet(f"{out}/plan_recommendations").select("member_id").distinct().count() == members.count()
    results = spark.read.schema(schemas.RUN_RESULTS).json(f"{out}/run_results").first()
    assert results["passed"] and results["best_claim"] in ("logistic", "xgboost") and len(results["results"]) == 3
    registry = spark.read.parquet(f"{out}/registry")
    assert registry.count() == 3 and registry.where("is_active").count() == 2


def test_registered_jobs_name_every_module_and_family(spark, base, monkeypatch):
    asked = set()

    class Asked(Exception):
        pass

    def note(*a, module, families=()):
        asked.add((module, tuple(families) if module == "claim" else ()))
        raise Asked

    monkeypatch.setattr(jobs, "run", note)
    for name in (n for n in REGISTRY if n.startswith("full_job_")):
        with pytest.raises(Asked):
            REGISTRY[name][0](spark, base)
    families = ("logistic", "rf", "xgboost", "lightgbm")
    assert asked == {("fraud", ()), ("recommend", ())} | {("claim", (f,)) for f in families}


def test_a_registered_job_with_short_training(spark, base, monkeypatch):
    run = jobs.run
    monkeypatch.setattr(jobs, "run", lambda *a, **b: run(*a, **b | {"rounds": {"xgboost": 2}, "folds": 0}))
    query, sql = REGISTRY["full_job_claim_xgboost"]
    assert differences(spark_rows(query(spark, base)), oracle_rows(connect(base), sql)) == []


def test_gate_stops_a_weak_run(spark, claims, members):
    out = new_stage_path(spark, "weak")
    with pytest.raises(ValueError, match="below AUC"):
        jobs.run({"claims": claims, "members": members}, out, "claim", families=("logistic",), rounds={"logistic": 5}, folds=0, min_auc=1.01, enforce=True)
    assert spark.read.parquet(f"{out}/claim_predictions").count() == claims.count()


def test_lake_job(spark, claims, members):
    raw, out = new_stage_path(spark, "raw"), new_stage_path(spark, "lake")
    writers.write_parquet(claims, f"{raw}/claims")
    writers.write_parquet(members, f"{raw}/members")
    auc = jobs.run_lake(spark, raw, out, rounds=3, threshold=450000)
    assert 0 <= auc <= 1
    assert spark.read.parquet(f"{out}/analytics/provider_risk").count() == 11
    predictions = spark.read.parquet(f"{out}/claim_predictions")
    assert set(predictions.columns) == {"claim_id", "member_id", "approval_probability", "predicted_approved", "predicted_at"}


def test_text_job(spark, base):
    out = new_stage_path(spark, "text")
    # few words and many notes, so that the classifier can learn the code from the word
    words = ["asthma", "kidney", "wellness"]
    rows = [(f"N{i:03d}", f"Visit {i % 7}, {words[i % 3]} again", f"D{i % 3}") for i in range(240)]
    table = spark.createDataFrame(rows, "note_id string, clinical_note string, diagnosis_code string")
    feedback = spark.createDataFrame([("great and fast",)], "text string")
    classifier = jobs.run_text(table, feedback, out, max_iter=10)
    assert classifier.holdout_accuracy > 0.9
    assert spark.read.parquet(f"{out}/feedback_sentiment").first()["sentiment"] == "POSITIVE"
    assert spark.read.option("header", True).csv(f"{out}/cleaned_notes").count() == table.count()


def test_claims_that_carry_member_columns_are_not_joined(claims, members, enriched):
    assert jobs.prepare_claims(enriched, members).columns == enriched.columns
    bare = jobs.prepare_claims(claims, None)
    assert bare.select("member_plan", "member_age", "state").distinct().collect()[0].asDict() == {
        "member_plan": "Silver", "member_age": 40, "state": "Unknown"
    }


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    updates = spark.createDataFrame([("b", 1, None, 9), ("b", 2, "z", None), ("c", 1, "w", 7)], "k string, at int, s string, extra int")
    rows = {r["k"]: (r["n"], r["s"], r["extra"]) for r in writers.upsert(target, updates, "k", order="at").collect()}
    assert rows == {"a": (1, "x", None), "b": (2, "z", 9), "c": (None, "w", 7)}


def test_csv_none_is_null_and_quotes_survive(spark):
    path = new_stage_path(spark, "csv")
    df = spark.createDataFrame([("N1", 'says "hi", twice\nnew line'), ("N2", None)], "note_id string, clinical_note string")
    writers.write_csv(df, path)
    got = readers.read_csv(spark, path, df.schema, multi_line=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    single = readers.read_csv(spark, path, df.schema)
    assert single.where("note_id = 'N2'").first()["clinical_note"] is None


def test_source_choice():
    assert readers.resolve_source({}) == "local"
    assert readers.resolve_source({"database.url": "jdbc:x", "object_store.path": "s3a://b"}) == "object_store"
    assert readers.resolve_source({"lake.path": "abfss://c", "object_store.path": "s3a://b"}) == "lake"


def test_document_limit(spark):
    path = new_stage_path(spark, "docs")
    writers.append_documents(spark.range(10).selectExpr("id", "id AS _id"), path)
    assert readers.read_documents(spark, path, "id long, _id long", "id > 2").columns == ["id"]
    assert readers.read_documents(spark, path, "id long, _id long", limit=0).count() == 10
    assert readers.read_documents(spark, path, "id long, _id long", limit=4).count() == 4


def test_stage_folder_is_the_configured_one():
    def session(master, configured=None, own=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: own)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))

    assert stage_dir(session("spark://host", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    assert stage_dir(session("local[2]", None, "/own")) == "/own"
    with pytest.raises(RuntimeError):
        stage_dir(session("local-cluster[2,1,1024]"))  # its executors have folders of their own
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stage_dir(session("spark://host"))


def test_staging_removes_its_tables(spark):
    with staging(spark):
        staged = stage(spark.range(5), "numbers")
        path = staged.inputFiles()[0]
        assert staged.count() == 5 and readers.path_exists(spark, path)
    assert not readers.path_exists(spark, path)


def test_nested_staging(spark):
    with staging(spark):
        outer = new_stage_path(spark, "outer")
        spark.range(3).write.parquet(outer)
        with staging(spark):
            inner, kept = new_stage_path(spark, "inner"), new_stage_path(spark, "kept", outlive=True)
            for path in (inner, kept):
                spark.range(3).write.parquet(path)
        with staging(spark):
            pass  # an empty block equals any other empty one
        assert [readers.path_exists(spark, p) for p in (inner, outer, kept)] == [False, True, True]
    assert not readers.path_exists(spark, outer) and not readers.path_exists(spark, kept)
    after = new_stage_path(spark, "after")
    spark.range(3).write.parquet(after)
    assert readers.path_exists(spark, after)


def test_staging_of_two_threads(spark):
    """A block removes what its own thread staged, while another thread's tables stay."""
    staged, opened, closed, paths = threading.Event(), threading.Event(), threading.Event(), {}

    def other():
        with staging(spark):
            opened.wait(60)
            paths["other"] = new_stage_path(spark, "other")
            spark.range(3).write.parquet(paths["other"])
            staged.set()
            closed.wait(60)
            paths["kept"] = readers.path_exists(spark, paths["other"])

    thread = threading.Thread(target=other)
    thread.start()
    with staging(spark):
        opened.set()
        assert staged.wait(60)
    closed.set()
    thread.join(60)
    assert paths["kept"] and not readers.path_exists(spark, paths["other"])
