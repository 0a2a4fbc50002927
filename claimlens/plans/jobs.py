"""End-to-end jobs: preprocessing, training, the lake job, the text job and the recommendation job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions.text import keyword_sentiment
from claimlens.operators import evaluation, joins, notes, recommend, reports
from claimlens.operators.claim_features import ClaimFeatures, ClaimFeaturesModel, lake_features
from claimlens.operators.columns import normalise_columns, prediction_view, with_defaults
from claimlens.operators.fraud_features import FraudFeatures, FraudFeaturesModel
from claimlens.plans import claim_models, fraud_models
from claimlens.session import stage, staging
from claimlens.sources import readers, writers

MODULES = ("all", "claim", "fraud", "recommend", "ingest")


@dataclass
class Preprocessed:
    """Enriched claims, both feature matrices with their labels, and the fitted models."""

    claims: DataFrame
    claim_features: DataFrame
    fraud_features: DataFrame
    claim_model: ClaimFeaturesModel
    fraud_model: FraudFeaturesModel


def prepare_claims(claims: DataFrame, members: DataFrame | None) -> DataFrame:
    """Claims with unified names, member attributes and defaults for what is still absent."""
    enriched = joins.enrich_claims(normalise_columns(claims), members)
    return with_defaults(enriched, {**C.ENRICHED_DEFAULTS, "state": C.UNKNOWN_CATEGORY, "is_fraud": 0})


def preprocess_all(tables: Mapping[str, DataFrame], approx: bool = False) -> Preprocessed:
    """Both feature matrices from one staged table of enriched claims."""
    claims = stage(prepare_claims(tables["claims"], tables.get("members")), "enriched-claims")
    claim_model = ClaimFeatures(approx=approx).fit(claims)
    fraud_model, fraud_features = FraudFeatures().fit_transform(claims)
    return Preprocessed(
        claims,
        stage(claim_model.transform(claims), "claim-features"),
        fraud_features,
        claim_model,
        fraud_model,
    )


def run(
    tables: Mapping[str, DataFrame],
    out: str,
    module: str = "all",
    families: Sequence[str] = ("logistic", "rf", "xgboost", "lightgbm"),
    rounds: Mapping[str, int] | None = None,
    fraud_rounds: int = 300,
    restarts: int = C.KMEANS_RESTARTS,
    folds: int = 5,
    min_auc: float = 0.75,
    enforce: bool = False,
) -> DataFrame:
    """Preprocess, train the chosen modules, gate and register; returns the gated metrics.

    With ``enforce`` a metric below ``min_auc`` raises after the results have been written.
    """
    if module not in MODULES:
        raise ValueError(f"module is one of {', '.join(MODULES)}")
    spark = tables["claims"].sparkSession
    with staging(spark):
        aucs, best = _train(tables, out, module, families, rounds, fraud_rounds, restarts, folds)
    metrics = evaluation.metrics_frame(spark, aucs)
    passed = all(auc >= min_auc for auc in aucs.values())
    writers.write_run_results(spark, f"{out}/run_results", best, aucs, passed)
    return evaluation.enforce_gate(metrics, min_auc) if enforce else evaluation.quality_gate(metrics, min_auc)


def _train(tables, out, module, families, rounds, fraud_rounds, restarts, folds) -> tuple[dict[str, float], str | None]:
    """AUC per trained model and the best claim family; models and predictions are written."""
    spark = tables["claims"].sparkSession
    writers.write_json(reports.dataset_stats(dict(tables)), f"{out}/dataset_stats")
    ready = preprocess_all(tables)
    ready.claim_model.write().overwrite().save(f"{out}/models/claim_features")
    ready.fraud_model.save_to(f"{out}/models/fraud_features")
    aucs: dict[str, float] = {}
    best = None
    if module in ("all", "claim"):
        models, metrics = claim_models.train_all(ready.claim_features, families, rounds, folds)
        best = evaluation.best_model(metrics).first()["model"]
        for family, model in models.items():
            aucs[f"claim_{family}"] = model.metrics["auc_roc"]
            path = f"{out}/models/claim"
            model.save(path)
            report = {row["class"]: row for row in model.metrics["report"]}
            approved = report.get("1", {})
            writers.register_model(
                spark,
                f"{out}/registry",
                {
                    "model_name": f"claim_{family}", "model_type": family, "version": "1",
                    "auc_roc": model.metrics["auc_roc"], "precision_score": approved.get("precision"),
                    "recall_score": approved.get("recall"), "f1_score": approved.get("f1_score"),
                    "training_rows": model.metrics["training_rows"], "artifact_path": f"{path}/{family}",
                    "is_active": family == best,
                },
            )
        writers.write_predictions(models[best].risk_score(ready.claim_features), f"{out}/claim_predictions", best)
    if module in ("all", "fraud"):
        fraud = fraud_models.train_fraud(ready.fraud_features, rounds=fraud_rounds, restarts=restarts)
        fraud.save_to(spark, f"{out}/models/fraud")
        aucs["fraud_auc"] = fraud.metrics["supervised"]["auc_roc"]
        writers.write_predictions(fraud.predict(ready.fraud_features), f"{out}/fraud_predictions", "1")
        writers.register_model(
            spark,
            f"{out}/registry",
            {"model_name": "fraud", "model_type": "combined", "version": "1", "auc_roc": aucs["fraud_auc"],
             "artifact_path": f"{out}/models/fraud", "is_active": True},
        )
    if module in ("all", "recommend"):
        run_recommend(tables["members"], out)
    return aucs, best


def run_lake(
    spark: SparkSession, raw: str, out: str, rounds: int = 100, threshold: float = C.HIGH_COST_AMOUNT
) -> float:
    """Read the lake's Parquet tables, train, write predictions and both reports; returns the AUC."""
    with staging(spark):
        claims = readers.read_parquet(spark, f"{raw}/claims")
        members = readers.read_parquet(spark, f"{raw}/members")
        wanted = ["member_id", "age", "bmi", "smoker", "plan_type", "num_chronic_conditions"]
        wanted += [c for c in ("state",) if c not in claims.columns]
        joined = joins.skew_join(claims, members.select(*wanted), "member_id", F.col("claim_id"))
        frame = stage(lake_features(joined, threshold), "lake-features")
        model, auc = claim_models.train_claim_lake(frame, rounds)
        model.write().overwrite().save(f"{out}/models/claim_approval")
        writers.write_report(prediction_view(model.transform(frame)), f"{out}/claim_predictions")
        writers.write_report(reports.monthly_trend(frame), f"{out}/analytics/monthly_trends")
        writers.write_report(reports.provider_risk_top(frame), f"{out}/analytics/provider_risk")
        return auc


def run_text(note_table: DataFrame, feedback: DataFrame, out: str, **options) -> notes.TextClassifier:
    """Clean notes, save them, train the diagnosis classifier and rate the feedback (column ``text``)."""
    with staging(note_table.sparkSession):
        cleaned = stage(notes.clean_notes(note_table), "cleaned-notes")
        writers.write_csv(cleaned, f"{out}/cleaned_notes")
        classifier = notes.train_note_classifier(cleaned, **options)
    classifier.model.write().overwrite().save(f"{out}/models/diagnosis")
    rated = feedback.withColumn("sentiment", keyword_sentiment(F.col("text"), "token"))
    writers.write_report(rated, f"{out}/feedback_sentiment")
    return classifier


def run_recommend(members: DataFrame, out: str, n: int = 3) -> DataFrame:
    """Fit the hybrid on enrolments, save it, and write every member's plans."""
    with staging(members.sparkSession):
        recommender = recommend.HybridRecommender.fit(members)
        recommender.save_to(f"{out}/models/recommender")
        plans = recommender.recommend(members, n).select(
            "member_id", F.col("plan").alias("recommended_plan"), F.col("score").alias("recommendation_score")
        )
        writers.write_predictions(plans, f"{out}/plan_recommendations", "1")
    return members.sparkSession.read.parquet(f"{out}/plan_recommendations")
