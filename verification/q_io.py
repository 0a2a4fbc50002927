"""Sources, sinks, document upsert and streams, each over whole fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import fixtures as fx
from claimlens import schemas
from claimlens.functions.text import clean_text, keyword_diagnosis
from claimlens.functions.vectors import argmax, cosine
from claimlens.operators import evaluation, joins, recommend, reports
from claimlens.operators.claim_features import ClaimFeatures
from claimlens.operators.fraud_features import FraudFeatures
from claimlens.plans import claim_models, fraud_models, jobs
from claimlens.session import new_stage_path, stage
from claimlens.sources import readers, writers
from claimlens.streaming import scoring
from verification import fixture_sql as v
from verification.q_models import _COLLAB, _KNN, _NEIGHBOURS, _PLANS, FRAUD_FACTS, RISK_FACTS, _content_sql, fraud_facts, risk_facts
from verification.q_text import _CONFIDENCE, _RULES, clean_sql, sentiment_case
from verification.registry import ROUND_OFFSET, query, rounded

_CLAIM_COLUMNS = (
    "claim_id, member_id, provider_id, claim_date, claim_type, diagnosis_code, procedure_code, "
    "RND(claim_amount, 4) AS claim_amount, RND(approved_amount, 4) AS approved_amount, claim_status, days_in_hospital, "
    "num_procedures, prior_auth, is_fraud"
)


@query(v.with_views(f"SELECT {_CLAIM_COLUMNS} FROM claims", v.CLAIMS))
def csv_round_trip(spark, base):
    path = new_stage_path(spark, "claims-csv")
    writers.write_csv(fx.claims(spark, base), path)
    return rounded(readers.read_csv(spark, path, schemas.CLAIMS))


@query(v.with_views(f"SELECT {_CLAIM_COLUMNS} FROM claims WHERE claim_date >= DATE '1998-01-01'", v.CLAIMS))
def parquet_round_trip(spark, base):
    path = new_stage_path(spark, "claims-parquet")
    writers.write_parquet(fx.claims(spark, base), path)
    return rounded(readers.read_parquet(spark, path, schemas.CLAIMS).where("claim_date >= DATE '1998-01-01'"))


@query(v.with_views(f"SELECT {_CLAIM_COLUMNS} FROM claims WHERE claim_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'", v.CLAIMS))
def claims_of_one_month(spark, base):
    """Claims laid out by month: the scan reads one partition."""
    path = new_stage_path(spark, "claims-by-month")
    writers.write_claims(fx.claims(spark, base), path)
    month = readers.read_parquet(spark, path).where("claim_month = '1997-03'").drop("claim_month")
    return rounded(month)


def _write_dataset(spark, base, path, names):
    tables = {
        "members": fx.members, "claims": fx.claims, "providers": fx.providers, "notes": fx.notes,
    }
    for name in names:
        schema = schemas.TABLES[name]
        df = tables[name](spark, base)
        columns = [
            F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        writers.write_csv(df.select(*columns), f"{path}/{schemas.TABLE_FILES[name]}.csv")


_COUNTS = """SELECT 'claims' AS table_name, COUNT(*) AS n_rows FROM claims UNION ALL SELECT 'members', COUNT(*) FROM members
  UNION ALL SELECT 'notes', COUNT(*) FROM notes"""


@query(v.with_views(_COUNTS, v.CLAIMS, v.MEMBERS, v.NOTES))
def loaded_dataset(spark, base):
    """The providers table is missing and left out."""
    path = new_stage_path(spark, "dataset")
    _write_dataset(spark, base, path, ["members", "claims", "notes"])
    return reports.row_counts(readers.load_dataset(spark, path))


@query(v.with_views(_COUNTS + " UNION ALL SELECT 'providers', COUNT(*) FROM providers", v.CLAIMS, v.MEMBERS, v.NOTES, v.PROVIDERS))
def fallback_dataset(spark, base):
    """Claims and members in the first place, notes and providers only in the second."""
    first, second = new_stage_path(spark, "primary"), new_stage_path(spark, "fallback")
    _write_dataset(spark, base, first, ["claims", "members"])
    _write_dataset(spark, base, second, ["notes", "providers"])
    return reports.row_counts(readers.load_with_fallback(spark, first, second))


@query(v.with_views(_COUNTS, v.CLAIMS, v.MEMBERS, v.NOTES))
def configured_dataset(spark, base):
    """Source chosen by settings: nothing but a local folder is configured."""
    path = new_stage_path(spark, "local")
    _write_dataset(spark, base, path, ["members", "claims", "notes"])
    return reports.row_counts(readers.get_data(spark, {"local.path": path}))


@query(v.with_views("SELECT claim_type, COUNT(*) AS n_claims, true AS listed FROM claims GROUP BY 1", v.CLAIMS))
def listed_files(spark, base):
    """Files of a table written by claim type, listed, and met with the rows read from them."""
    path = new_stage_path(spark, "claims-by-type")
    fx.claims(spark, base).write.partitionBy("claim_type").parquet(path)
    files = readers.list_files(spark, path).where("length > 0").select("path", F.lit(True).alias("listed"))
    rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("path"), "claim_type").agg(F.count("*").alias("n"))
    same = F.regexp_replace("path", "^file:/+", "/")
    met = rows.withColumn("path", same).join(files.withColumn("path", same), "path", "left")
    return met.groupBy("claim_type").agg(F.sum("n").alias("n_claims"), F.every(F.coalesce("listed", F.lit(False))).alias("listed"))


@query(
    v.with_views(
        """SELECT note_id, clinical_note FROM notes WHERE note_date >= DATE '1998-01-01'""", v.NOTES
    )
)
def filtered_documents(spark, base):
    path = new_stage_path(spark, "documents")
    notes = fx.notes(spark, base).withColumn("_id", F.md5("note_id"))
    writers.append_documents(notes, path)
    schema = notes.schema
    return readers.read_documents(spark, path, schema, "note_date >= DATE '1998-01-01'").select("note_id", "clinical_note")


@query(
    v.with_views(
        """SELECT COALESCE(t.member_id, u.member_id) AS member_id, COALESCE(u.plan_type, t.plan_type) AS plan_type, t.age,
        COALESCE(u.tenure_months, t.tenure_months) AS tenure_months
        FROM (SELECT * FROM members WHERE age % 4 <> 0) t FULL JOIN (SELECT member_id, CASE WHEN age % 2 = 0 THEN 'Gold' END AS plan_type,
          tenure_months + 1 AS tenure_months FROM members WHERE age % 3 = 0) u ON t.member_id = u.member_id""",
        v.MEMBERS,
    )
)
def upserted_members(spark, base):
    """Some updates meet a stored member, some insert one, some supply only part of the fields."""
    members = fx.members(spark, base)
    target = members.where("age % 4 <> 0").select("member_id", "plan_type", "age", "tenure_months")
    updates = members.where("age % 3 = 0").select(
        "member_id",
        F.when(F.col("age") % 2 == 0, "Gold").alias("plan_type"),
        (F.col("tenure_months") + 1).alias("tenure_months"),
    )
    return writers.upsert(target, updates, "member_id")


@query(
    v.with_views(
        """SELECT COALESCE(p.provider_id, c.provider_id) AS provider_id, COALESCE(claim_status, 'None') AS last_status, claim_amount AS last_amount
        FROM providers p FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER
        (PARTITION BY provider_id ORDER BY claim_id DESC) AS rn FROM claims WHERE provider_id IS NOT NULL) WHERE rn = 1) c ON p.provider_id = c.provider_id""",
        v.CLAIMS, v.PROVIDERS,
    )
)
def upserted_provider_state(spark, base):
    """Every claim updates its provider's record; the last one wins."""
    claims = fx.claims(spark, base).where("provider_id IS NOT NULL")
    updates = claims.select(
        "provider_id", "claim_id", F.col("claim_status").alias("last_status"), F.col("claim_amount").alias("last_amount")
    )
    stored = {"last_status": F.lit("None"), "last_amount": F.lit(None).cast("double")}
    target = fx.providers(spark, base).select("provider_id").withColumns(stored)
    return writers.upsert(target, updates, "provider_id", order="claim_id")


@query(
    v.with_views(
        """SELECT claim_id, member_id, model_version, ROUND(risk_score, 4) AS approval_probability, ROUND(1 - risk_score, 4) AS risk_score,
        CASE WHEN 1 - risk_score <= 0 THEN NULL WHEN 1 - risk_score <= 0.2 THEN 'Very Low' WHEN 1 - risk_score <= 0.4 THEN 'Low'
          WHEN 1 - risk_score <= 0.6 THEN 'Medium' WHEN 1 - risk_score <= 0.8 THEN 'High' ELSE 'Very High' END AS risk_band,
        CASE WHEN risk_score >= 0.5 THEN 'Approve' ELSE 'Review' END AS decision, true AS stamped FROM claim_predictions""",
        v.CLAIM_PREDICTIONS,
    )
)
def written_predictions(spark, base):
    """Both model versions through the prediction sink, each to its own folder."""
    paths = {version: new_stage_path(spark, f"predictions-{version}") for version in ("v1", "v2")}
    predictions = fx.claim_predictions(spark, base)
    for version, path in paths.items():
        scored = predictions.where(F.col("model_version") == version).drop("model_version")
        writers.write_predictions(evaluation.risk_scores(scored, "risk_score"), path, version)
    written = spark.read.parquet(*paths.values())
    return written.withColumn("stamped", F.col("created_at") <= F.current_timestamp()).drop("created_at")


@query(
    v.with_views(
        """SELECT model_name, RND(auc, 4) AS auc_roc, n AS training_rows FROM (SELECT 'rate_' || claim_type AS model_name, AVG(is_fraud) AS auc,
        COUNT(*) AS n FROM claims GROUP BY 1)""",
        v.CLAIMS,
    )
)
def active_models(spark, base):
    """Registry with one retired and one active entry per claim type."""
    path = new_stage_path(spark, "registry")
    rates = fx.claims(spark, base).groupBy("claim_type").agg(F.avg("is_fraud").alias("auc"), F.count("*").alias("n"))
    for row in rates.collect():
        for version, active in (("1", False), ("2", True)):
            writers.register_model(
                spark, path,
                {"model_name": f"rate_{row['claim_type']}", "version": version, "auc_roc": row["auc"] if active else 1.0,
                 "training_rows": row["n"], "is_active": active},
            )
    registry = spark.read.schema(schemas.MODEL_REGISTRY).parquet(path)
    return rounded(evaluation.latest_active(registry).select("model_name", "auc_roc", "training_rows"))


@query(v.with_views("SELECT 'fraud_rate' AS metric, RND(AVG(is_fraud), 4) AS value FROM claims UNION ALL SELECT 'n_claims', RND(CAST(COUNT(*) AS DOUBLE), 4) FROM claims", v.CLAIMS))
def run_results(spark, base):
    """Metrics written as one JSON document with a map, read back by its declared schema."""
    row = fx.claims(spark, base).agg(F.avg("is_fraud").alias("r"), F.count("*").alias("n")).first()
    path = new_stage_path(spark, "run-results")
    saved = writers.write_run_results(spark, path, None, {"fraud_rate": row["r"], "n_claims": float(row["n"])}, True)
    return rounded(saved.select(F.explode("results").alias("metric", "value")))


# --- jobs and streams ---------------------------------------------------------------------------


def _lake(spark, base):
    raw, out = new_stage_path(spark, "lake-raw"), new_stage_path(spark, "lake-out")
    writers.write_parquet(fx.claims(spark, base), f"{raw}/claims")
    writers.write_parquet(fx.members(spark, base), f"{raw}/members")
    jobs.run_lake(spark, raw, out, threshold=450000)
    return out


@query(
    v.with_views(
        """SELECT 'trend' AS report, strftime(DATE_TRUNC('month', claim_date), '%Y-%m') || ' ' || claim_type AS part, COUNT(*) AS n_claims,
          RND(SUM(claim_amount), 4) AS amount, CAST(SUM(is_fraud) AS BIGINT) AS n_fraud FROM claims GROUP BY 1, 2
        UNION ALL SELECT 'predictions', c.member_id, COUNT(*), NULL, NULL FROM claims c JOIN members m ON c.member_id = m.member_id
          GROUP BY 1, 2
        UNION ALL SELECT * FROM (SELECT 'providers', COALESCE(provider_id, ''), COUNT(*) AS n, RND(AVG(claim_amount), 4), CAST(SUM(is_fraud) AS BIGINT)
          FROM claims GROUP BY provider_id ORDER BY ROUND(SUM(is_fraud) * 100.0::DOUBLE / COUNT(*), 2) DESC, provider_id NULLS FIRST LIMIT 50)""",
        v.CLAIMS, v.MEMBERS,
    )
)
def lake_job_trends(spark, base):
    """The whole lake job at its default rounds: both written reports, and the predictions counted by member."""
    out = _lake(spark, base)
    trends = spark.read.parquet(f"{out}/analytics/monthly_trends")
    part = F.concat(F.date_format("month", "yyyy-MM"), F.lit(" "), "claim_type")
    trend = trends.select(
        F.lit("trend").alias("report"), part.alias("part"), F.col("num_claims").alias("n_claims"),
        F.col("total_amount").alias("amount"), F.col("fraud_count").alias("n_fraud"),
    )
    by_member = spark.read.parquet(f"{out}/claim_predictions").groupBy("member_id").agg(F.count("*").alias("n_claims"))
    none = {"amount": F.lit(None).cast("double"), "n_fraud": F.lit(None).cast("long")}
    predictions = by_member.select(F.lit("predictions").alias("report"), F.col("member_id").alias("part"), "n_claims").withColumns(none)
    providers = spark.read.parquet(f"{out}/analytics/provider_risk").select(
        F.lit("providers").alias("report"), F.coalesce("provider_id", F.lit("")).alias("part"),
        F.col("total_claims").alias("n_claims"), F.col("avg_claim").alias("amount"), F.col("fraud_claims").alias("n_fraud"),
    )
    return rounded(trend.unionByName(predictions).unionByName(providers))


def _tables(spark, base):
    return {"claims": fx.claims(spark, base), "members": fx.members(spark, base), "providers": fx.providers(spark, base), "notes": fx.notes(spark, base)}


@query(
    v.with_views(
        """SELECT 'claims' AS matrix, COUNT(*) AS n_rows, COUNT(DISTINCT claim_id) AS n_claims FROM claims
        UNION ALL SELECT 'claim_features', COUNT(*), COUNT(DISTINCT claim_id) FROM claims
        UNION ALL SELECT 'fraud_features', COUNT(*), COUNT(DISTINCT claim_id) FROM claims""",
        v.CLAIMS,
    )
)
def preprocessed_rows(spark, base):
    """The combined preprocessing keeps every claim once in each of its tables."""
    ready = jobs.preprocess_all(_tables(spark, base))
    parts = {"claims": ready.claims, "claim_features": ready.claim_features, "fraud_features": ready.fraud_features}
    rows = [
        df.agg(F.lit(name).alias("matrix"), F.count("*").alias("n_rows"), F.countDistinct("claim_id").alias("n_claims"))
        for name, df in parts.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _job_results(spark, base, module, families=("logistic", "rf", "xgboost", "lightgbm")):
    """What a run of the whole job for one module wrote: AUC, registry entry, and its predictions that are consistent."""
    out = new_stage_path(spark, f"full-job-{module}")
    gated = jobs.run(_tables(spark, base), out, module=module, families=families)
    results = spark.read.schema(schemas.RUN_RESULTS).json(f"{out}/run_results").select(F.explode("results").alias("name", "auc"))
    registry = spark.read.schema(schemas.MODEL_REGISTRY).parquet(f"{out}/registry")
    registered_as = F.when(F.col("model_name") == "fraud", "fraud_auc").otherwise(F.col("model_name"))
    known = registry.groupBy(registered_as.alias("name")).agg(F.bool_or("is_active").alias("registered"))
    table, facts, key = {"claim": ("claim_predictions", risk_facts, "claim_id"), "fraud": ("fraud_predictions", fraud_facts, "claim_id")}[module]
    written = facts(spark.read.parquet(f"{out}/{table}"))
    right = F.lit(True)
    for c in written.columns:
        right = right & F.col(c) if c.endswith("_ok") else right
    row = written.agg(F.count("*").alias("n"), F.countDistinct(F.when(right, F.col(key))).alias("right")).first()
    return results.join(known, "name", "left").join(gated.select(F.col("model").alias("name")), "name").select(
        "name", F.col("auc").between(0.4, 1).alias("auc_ok"), F.coalesce("registered", F.lit(False)).alias("registered"),
        F.lit(row["n"]).alias("n_predictions"), F.lit(row["right"]).alias("n_right"),
    )


def _job_sql(name):
    return v.with_views(
        f"SELECT '{name}' AS name, true AS auc_ok, true AS registered, COUNT(*) AS n_predictions, COUNT(DISTINCT claim_id) AS n_right FROM claims",
        v.CLAIMS,
    )


# The whole job at its defaults, one query for each module and claim family: all of them in one run take longer than a
# query may.


@query(_job_sql("claim_logistic"))
def full_job_claim_logistic(spark, base):
    return _job_results(spark, base, "claim", ("logistic",))


@query(_job_sql("claim_rf"))
def full_job_claim_rf(spark, base):
    return _job_results(spark, base, "claim", ("rf",))


@query(_job_sql("claim_xgboost"))
def full_job_claim_xgboost(spark, base):
    return _job_results(spark, base, "claim", ("xgboost",))


@query(_job_sql("claim_lightgbm"))
def full_job_claim_lightgbm(spark, base):
    return _job_results(spark, base, "claim", ("lightgbm",))


@query(_job_sql("fraud_auc"))
def full_job_fraud(spark, base):
    return _job_results(spark, base, "fraud")


@query(
    v.with_views(
        """SELECT 'recommend' AS name, COUNT(*) * 3 AS n_predictions, COUNT(DISTINCT member_id) * 3 AS n_right,
        (SELECT COUNT(*) FROM claims) AS n_claims FROM members""",
        v.CLAIMS, v.MEMBERS,
    )
)
def full_job_recommend(spark, base):
    """The whole job for the recommendations: plans per member, and the dataset statistics it writes."""
    out = new_stage_path(spark, "full-job-recommend")
    jobs.run(_tables(spark, base), out, module="recommend")
    stats = spark.read.json(f"{out}/dataset_stats").first()
    return spark.read.parquet(f"{out}/plan_recommendations").agg(
        F.lit("recommend").alias("name"), F.count("*").alias("n_predictions"),
        F.countDistinct("member_id", "recommended_plan").alias("n_right"), F.lit(stats["n_claims"]).cast("long").alias("n_claims"),
    )


@query(
    v.with_views(
        f"""SELECT 'notes' AS output, {_RULES} AS value, COUNT(*) AS n FROM cleaned GROUP BY 1, 2
        UNION ALL SELECT 'feedback', {sentiment_case("token")}, COUNT(*) FROM feedback GROUP BY 1, 2""",
        v.NOTES, v.FEEDBACK,
        f"cleaned AS (SELECT note_id, {clean_sql('clinical_note', C.ABBREVIATIONS)} AS t FROM notes)",
    )
)
def text_job_outputs(spark, base):
    """The text job: written clean notes, counted by the diagnosis their text shows, and rated feedback."""
    out = new_stage_path(spark, "text-job")
    notes = fx.notes(spark, base)
    labelled = notes.withColumn("diagnosis_code", keyword_diagnosis(clean_text(F.col("clinical_note")))["code"])
    jobs.run_text(labelled, fx.feedback(spark, base), out)
    written = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/cleaned_notes")
    shown = written.select(F.lit("notes").alias("output"), keyword_diagnosis(F.col("clean_text"))["code"].alias("value"))
    rated = spark.read.parquet(f"{out}/feedback_sentiment").select(F.lit("feedback").alias("output"), F.col("sentiment").alias("value"))
    return shown.unionByName(rated).groupBy("output", "value").agg(F.count("*").alias("n"))


@query(
    v.with_views(
        """SELECT member_id, plan AS recommended_plan, RND(ROUND(score + 1e-9::DOUBLE, 4), 4) AS recommendation_score, '1' AS model_version FROM (
        SELECT member_id, plan, score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
        SELECT member_id, plan, SUM(s) AS score FROM (SELECT member_id, plan, 0.4::DOUBLE * score AS s FROM collab WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.35::DOUBLE * ROUND(score, 4) FROM knn WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.25::DOUBLE * score FROM content WHERE rank <= 4) GROUP BY 1, 2)) WHERE rank <= 3""",
        v.MEMBERS, _PLANS, _COLLAB, _NEIGHBOURS, _KNN, _content_sql("members", "0.5::DOUBLE"),
    )
)
def recommendation_job_plans(spark, base):
    """The recommendation job's written table."""
    written = jobs.run_recommend(stage(fx.members(spark, base), "members"), new_stage_path(spark, "recommendation-job"))
    return rounded(written.drop("created_at"))


@query("SELECT least(25, COUNT(*)) AS n_rows, true AS known FROM documents")
def limited_documents(spark, base):
    """A document read with a limit: so many rows, all of them stored ones."""
    path = new_stage_path(spark, "documents")
    notes = fx.notes(spark, base)
    writers.append_documents(notes, path)
    some = readers.read_documents(spark, path, notes.schema, limit=25)
    known = some.select("note_id").distinct().join(notes.select("note_id"), "note_id", "left_semi")
    counts = some.agg(F.count("*").alias("n_rows")).crossJoin(known.agg(F.count("*").alias("n_known")))
    return counts.select("n_rows", (F.col("n_known") == F.col("n_rows")).alias("known"))


@query(v.with_views("SELECT DISTINCT plan_type FROM members WHERE plan_type IS NOT NULL", v.MEMBERS))
def distinct_plans(spark, base):
    return reports.distinct_values(fx.members(spark, base), "plan_type")


@query(
    """SELECT a.vec_id, CAST(list_position(a.embedding, list_max(a.embedding)) - 1 AS INT) AS peak,
    ROUND(0.0000123::DOUBLE + list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def embedding_facts(spark, base):
    """Position of a vector's maximum, and its similarity to the next vector."""
    vectors = fx.table(spark, base, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    both = vectors.join(following, "vec_id")
    return rounded(both.select("vec_id", argmax(F.col("v")).alias("peak"), cosine(F.col("v"), F.col("w")).alias("similarity")))


_NOTE_REQUESTS = """note_requests AS (SELECT CASE WHEN doc_id % 19 <> 0 THEN note_id END AS note_id,
 CASE WHEN doc_id % 23 = 0 THEN '' ELSE clinical_note END AS clinical_note
 FROM (SELECT *, CAST(substr(note_id, 5) AS BIGINT) AS doc_id FROM notes))"""


def _streamed_notes(spark, base, folder):
    """Note requests arriving as JSON files, analysed by a stream; some lack an id or a text."""
    source, out, checkpoint = (new_stage_path(spark, n) for n in ("note-requests", "note-analysis", "note-checkpoint"))
    key = F.substring("note_id", 5, 20).cast("long")
    requests = fx.notes(spark, base).select(
        F.when(key % 19 != 0, F.col("note_id")).alias("note_id"),
        F.when(key % 23 == 0, "").otherwise(F.col("clinical_note")).alias("clinical_note"),
    )
    writers.append_documents(requests, source)
    stream = spark.readStream.schema(schemas.NOTE_REQUEST).json(source)
    scoring.stream_notes(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(f"{out}/{folder}")


@query(
    v.with_views(
        f"""SELECT COALESCE(note_id, 'NOTE000001') AS note_id, substr(t, 1, 200) AS cleaned_text, {_RULES} AS predicted_diagnosis,
        {_CONFIDENCE} AS confidence, 'neutral' AS sentiment
        FROM (SELECT note_id, {clean_sql("clinical_note", C.ABBREVIATIONS_SHORT)} AS t FROM note_requests WHERE length(clinical_note) >= 10)""",
        v.NOTES, _NOTE_REQUESTS,
    )
)
def streamed_note_analysis(spark, base):
    return _streamed_notes(spark, base, "analysed").drop("batch_id")


@query(
    v.with_views(
        """SELECT COALESCE(note_id, 'NOTE000001') AS note_id, clinical_note, 'note_length' AS broken_rules
        FROM note_requests WHERE length(clinical_note) < 10""",
        v.NOTES, _NOTE_REQUESTS,
    )
)
def streamed_note_quarantine(spark, base):
    rejected = _streamed_notes(spark, base, "quarantine")
    return rejected.select("note_id", "clinical_note", F.concat_ws(",", "broken_rules").alias("broken_rules"))


def _claim_request_stream(spark, base):
    source = new_stage_path(spark, "claim-requests")
    requests = fx.claim_requests(spark, base)
    writers.append_documents(requests, source)
    return spark.readStream.schema(requests.schema).json(source)


_VALID = "NOT (claim_amount <= 0 OR COALESCE(member_age, 0) > 100 OR member_bmi IS NULL)"


def _claim_scorer(spark, base):
    claims = stage(joins.enrich_claims(fx.claims(spark, base), fx.members(spark, base)), "enriched")
    features = ClaimFeatures().fit(claims)
    return features, claim_models.train_claim(stage(features.transform(claims), "features"), "logistic")


@query(v.with_views(f"SELECT {RISK_FACTS}, true AS batch_ok FROM claim_requests WHERE {_VALID}", v.CLAIMS, v.MEMBERS, v.CLAIM_REQUESTS))
def streamed_claim_scores(spark, base):
    """Streamed scores: consistent, and equal to those of the batch job."""
    features, model = _claim_scorer(spark, base)
    out, checkpoint = new_stage_path(spark, "claim-scores"), new_stage_path(spark, "claim-checkpoint")
    scoring.stream_claims(_claim_request_stream(spark, base), features, model, out, checkpoint).awaitTermination()
    streamed = spark.read.parquet(f"{out}/scored").drop("batch_id")
    batch, _ = scoring.score_batch(fx.claim_requests(spark, base), features, model)
    both = streamed.join(batch.select("claim_id", F.col("risk_score").alias("_batch")), "claim_id", "left")
    same = both.select("claim_id", (F.abs(F.col("_batch") - F.col("risk_score")) < 0.00015).alias("batch_ok"))
    return risk_facts(streamed).join(same, "claim_id")


@query(
    v.with_views(
        f"SELECT COUNT(*) AS total, true AS parts_ok, COUNT(DISTINCT claim_id) AS n_ids FROM claim_requests WHERE {_VALID}",
        v.CLAIMS, v.MEMBERS, v.CLAIM_REQUESTS,
    )
)
def scored_batch_summary(spark, base):
    """The batch job's totals; its requests come without a claim id and get one each."""
    features, model = _claim_scorer(spark, base)
    results, totals = scoring.score_batch(fx.claim_requests(spark, base).drop("claim_id"), features, model)
    row = totals.select("total", (F.col("approved") + F.col("review") == F.col("total")).alias("parts_ok"))
    return row.crossJoin(results.agg(F.countDistinct("claim_id").alias("n_ids")))


@query(
    v.with_views(
        """SELECT claim_id, concat_ws(',', CASE WHEN claim_amount <= 0 THEN 'amount_positive' END, CASE WHEN member_age > 100 THEN 'age_range' END,
        CASE WHEN member_bmi IS NULL THEN 'bmi_present' END) AS broken_rules
        FROM claim_requests WHERE claim_amount <= 0 OR member_age > 100 OR member_bmi IS NULL""",
        v.CLAIMS, v.MEMBERS, v.CLAIM_REQUESTS,
    )
)
def streamed_claim_quarantine(spark, base):
    features, model = _claim_scorer(spark, base)
    out, checkpoint = new_stage_path(spark, "claim-scores"), new_stage_path(spark, "claim-checkpoint")
    scoring.stream_claims(_claim_request_stream(spark, base), features, model, out, checkpoint).awaitTermination()
    bad = spark.read.parquet(f"{out}/quarantine")
    return bad.select("claim_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query(v.with_views(f"SELECT {FRAUD_FACTS}, true AS batch_ok FROM claims WHERE provider_id IS NOT NULL", v.CLAIMS))
def streamed_fraud_scores(spark, base):
    """Fraud requests scored from stored statistics: consistent, and equal to the batch job's scores."""
    claims = stage(fx.claims(spark, base), "claims")
    features, matrix = FraudFeatures().fit_transform(claims)
    model = fraud_models.train_fraud(matrix, supervised=False)  # scoring uses forest and clusters
    source, out, checkpoint = (new_stage_path(spark, n) for n in ("fraud-requests", "fraud-scores", "fraud-checkpoint"))
    names = [f for f in schemas.FRAUD_REQUEST.names if f in claims.columns]
    writers.append_documents(claims.select(*names), source)
    requests = spark.readStream.schema(schemas.FRAUD_REQUEST).json(source)
    scoring.stream_fraud(requests, features, model, out, checkpoint).awaitTermination()
    streamed = stage(spark.read.parquet(f"{out}/scored").drop("batch_id"), "streamed-fraud")
    batch = scoring.score_fraud(spark.read.schema(schemas.FRAUD_REQUEST).json(source), features, model)["scored"]
    both = streamed.join(batch.select("claim_id", F.col("combined_fraud_score").alias("_batch")), "claim_id", "left")
    same = both.select("claim_id", (F.abs(F.col("_batch") - F.col("combined_fraud_score")) < 0.00015).alias("batch_ok"))
    return fraud_facts(streamed).join(same, "claim_id")


@query(
    v.with_views(
        """SELECT member_id, list(plan ORDER BY rank) AS plans, list(RND(ROUND(score + 1e-9::DOUBLE, 4), 4) ORDER BY rank) AS scores FROM (SELECT member_id, plan, score, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, plan) AS rank FROM (
        SELECT member_id, plan, SUM(s) AS score FROM (SELECT member_id, plan, 0.4::DOUBLE * score AS s FROM collab WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.35::DOUBLE * ROUND(score, 4) FROM knn WHERE rank <= 4
          UNION ALL SELECT member_id, plan, 0.25::DOUBLE * score FROM content WHERE rank <= 4) GROUP BY 1, 2)) JOIN
        (SELECT member_id AS m FROM members WHERE bmi IS NOT NULL) ON member_id = m WHERE rank <= 3 GROUP BY 1""",
        v.MEMBERS, v.PLAN_REQUESTS, _PLANS, _COLLAB, _NEIGHBOURS, _KNN,
        _content_sql("plan_requests", "COALESCE(income_score, 0.5::DOUBLE)"),
    )
)
def streamed_recommendations(spark, base):
    """Plan requests through a saved hybrid and its neighbour index; requests without bmi go to quarantine."""
    source, out, checkpoint, saved = (new_stage_path(spark, n) for n in ("plan-requests", "plans", "plan-checkpoint", "hybrid"))
    writers.append_documents(fx.plan_requests(spark, base), source)
    requests = spark.readStream.schema(schemas.PLAN_REQUEST).json(source)
    recommend.HybridRecommender.fit(stage(fx.members(spark, base), "members")).save_to(saved)
    recommender = recommend.HybridRecommender.load_from(spark, saved)
    scoring.stream_recommendations(requests, recommender, out, checkpoint).awaitTermination()
    plans = spark.read.parquet(f"{out}/recommended")
    rounded_score = lambda r: F.round(r["score"] + ROUND_OFFSET, 4)
    return plans.select("member_id", F.col("recommendations.plan").alias("plans"), F.transform("recommendations", rounded_score).alias("scores"))
