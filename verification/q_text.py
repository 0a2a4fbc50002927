"""Text cleaning, vocabulary, encoding, keyword rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import fixtures as fx
from claimlens.functions import text as X
from claimlens.operators import notes as N
from claimlens.session import stage
from verification import fixture_sql as v
from verification.registry import query


# Word edges that know accented letters, which DuckDB's \b does not: every word is fenced by two control
# characters, whole fenced words are replaced, and the fences are taken back afterwards.
def clean_sql(column: str, abbreviations) -> str:
    word = "[\\p{L}\\p{N}_]"
    out = f"regexp_replace(lower({column}), '({word}+)', chr(2) || '\\1' || chr(3), 'g')"
    for short, full in abbreviations.items():
        parts = short.split("/")
        pattern = " || '/' || ".join(f"chr(2) || '{p}' || chr(3)" for p in parts)
        out = f"replace({out}, {pattern}, chr(2) || '{full}' || chr(3))"
    out = f"replace(replace({out}, chr(2), ''), chr(3), '')"
    return f"trim(regexp_replace({out}, '[^a-z0-9.,\\-/]+', ' ', 'g'))"


@query(v.with_views(f"SELECT note_id, {clean_sql('clinical_note', C.ABBREVIATIONS)} AS clean_text FROM notes", v.NOTES))
def clean_notes(spark, base):
    return N.clean_notes(fx.notes(spark, base)).select("note_id", "clean_text")


@query(v.with_views(f"SELECT note_id, {clean_sql('clinical_note', C.ABBREVIATIONS_SHORT)} AS clean_text FROM notes", v.NOTES))
def clean_notes_short(spark, base):
    cleaned = X.clean_text(F.col("clinical_note"), C.ABBREVIATIONS_SHORT)
    return fx.notes(spark, base).select("note_id", cleaned.alias("clean_text"))


@query(f"SELECT doc_id, md5({clean_sql('text', C.ABBREVIATIONS)}) AS clean_md5 FROM documents")
def clean_documents(spark, base):
    """Whole documents in four languages through the clinical cleaner."""
    return fx.table(spark, base, "documents").select("doc_id", F.md5(X.clean_text(F.col("text"))).alias("clean_md5"))


_RULES = "CASE " + " ".join(
    f"WHEN contains(t, '{word}') THEN '{code}'" for word, code, _ in C.DIAGNOSIS_RULES
) + " ELSE 'J06' END"
_CONFIDENCE = "CASE " + " ".join(
    f"WHEN contains(t, '{word}') THEN {confidence}::DOUBLE" for word, _, confidence in C.DIAGNOSIS_RULES
) + " ELSE 0.6::DOUBLE END"


@query(
    v.with_views(
        f"""SELECT note_id, substr(t, 1, 200) AS cleaned_text, {_RULES} AS predicted_diagnosis, {_CONFIDENCE} AS confidence,
        'neutral' AS sentiment FROM cleaned""",
        v.NOTES,
        f"cleaned AS (SELECT note_id, {clean_sql('clinical_note', C.ABBREVIATIONS_SHORT)} AS t FROM notes)",
    )
)
def note_analysis(spark, base):
    return N.analyze_notes(fx.notes(spark, base))


_WORDS = "list_filter(string_split_regex(lower(text), '[\\s\\x{85}\\p{Z}]+'), lambda w: w <> '')"


def sentiment_case(match: str) -> str:
    """Sentiment of a column ``text``."""
    if match == "token":
        words, pos, neg = "string_split_regex(lower(text), '\\s+')", C.TOKEN_POSITIVE, C.TOKEN_NEGATIVE
        count = lambda listed: " + ".join(f"CAST(list_contains({words}, '{x}') AS INT)" for x in listed)
    else:
        words, pos, neg = "lower(text)", C.SUBSTRING_POSITIVE, C.SUBSTRING_NEGATIVE
        count = lambda listed: " + ".join(f"CAST(contains({words}, '{x}') AS INT)" for x in listed)
    return f"CASE WHEN {count(pos)} > {count(neg)} THEN 'POSITIVE' WHEN {count(neg)} > {count(pos)} THEN 'NEGATIVE' ELSE 'NEUTRAL' END"


def _sentiment_sql(match: str) -> str:
    return v.with_views(f"SELECT conv_id, turn, {sentiment_case(match)} AS sentiment FROM feedback", v.FEEDBACK)


@query(_sentiment_sql("token"))
def token_sentiment(spark, base):
    return fx.feedback(spark, base).select("conv_id", "turn", X.keyword_sentiment(F.col("text"), "token").alias("sentiment"))


@query(_sentiment_sql("substring"))
def substring_sentiment(spark, base):
    return fx.feedback(spark, base).select("conv_id", "turn", X.keyword_sentiment(F.col("text"), "substring").alias("sentiment"))


@query("SELECT w AS word, COUNT(*) AS n_uses FROM (SELECT unnest(" + _WORDS + ") AS w FROM documents) GROUP BY 1")
def document_token_counts(spark, base):
    documents = fx.table(spark, base, "documents").select(F.lower("text").alias("text"))
    return N.token_counts(documents, "text")


_VOCAB = """vocab AS (SELECT word, n_uses, CAST(row_number() OVER (ORDER BY n_uses DESC, word) + 1 AS INT) AS word_id
 FROM (SELECT w AS word, COUNT(*) AS n_uses FROM (SELECT unnest(""" + _WORDS + """) AS w FROM documents) GROUP BY 1)
 ORDER BY n_uses DESC, word LIMIT 9998)"""


@query(v.with_views("SELECT word, n_uses, word_id FROM vocab", _VOCAB))
def document_vocabulary(spark, base):
    documents = fx.table(spark, base, "documents").select(F.lower("text").alias("text"))
    return N.build_vocab(documents, "text", 10_000)


@query(
    v.with_views(
        f"""SELECT d.doc_id, array_to_string(list_resize(list(CAST(COALESCE(vocab.word_id, 1) AS VARCHAR) ORDER BY pos), 32, '0'), ' ') AS token_ids
        FROM (SELECT doc_id, unnest(ws[:32]) AS w, generate_subscripts(ws[:32], 1) AS pos FROM (SELECT doc_id, {_WORDS} AS ws FROM documents)) d
        LEFT JOIN vocab ON d.w = vocab.word GROUP BY d.doc_id
        UNION ALL SELECT doc_id, repeat('0 ', 31) || '0' FROM documents WHERE len({_WORDS}) = 0""",
        _VOCAB,
    )
)
def encoded_documents(spark, base):
    documents = fx.table(spark, base, "documents").select("doc_id", F.lower("text").alias("text"))
    vocabulary = N.Vocabulary.of(N.build_vocab(documents, "text", 10_000))
    encoded = N.encode_notes(documents, vocabulary, "text", 32)
    return encoded.select("doc_id", F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("token_ids"))


def _facts(classifier, predicted, key, label, labels, floor):
    """Each row's key and label, and whether its prediction is a label with a possible confidence."""
    possible = F.col("confidence").between(F.round(F.lit(1 / (len(labels) + 1)), 4), 1)
    return predicted.select(
        key, label, F.col("predicted_label").isin(labels).alias("label_ok"), possible.alias("confidence_ok"),
        F.lit(bool(classifier.holdout_accuracy >= floor)).alias("accuracy_ok"),
    )


@query(
    v.with_views(
        f"""SELECT note_id, {_RULES} AS diagnosis_code, true AS label_ok, true AS confidence_ok, true AS accuracy_ok FROM cleaned""",
        v.NOTES,
        f"cleaned AS (SELECT note_id, {clean_sql('clinical_note', C.ABBREVIATIONS)} AS t FROM notes)",
    )
)
def note_classifier_predictions(spark, base):
    """Diagnosis learned from cleaned notes, labelled by the keyword rules, at the default settings."""
    cleaned = N.clean_notes(fx.notes(spark, base))
    labelled = stage(cleaned.withColumn("diagnosis_code", X.keyword_diagnosis(F.col("clean_text"))["code"]), "labelled-notes")
    classifier = N.train_note_classifier(labelled)
    codes = sorted({code for _, code, _ in C.DIAGNOSIS_RULES} | {C.DEFAULT_DIAGNOSIS[0]})
    return _facts(classifier, classifier.predict(labelled), "note_id", "diagnosis_code", codes, 0.1)


@query(
    """SELECT doc_id, CAST(quality AS VARCHAR) AS quality, true AS label_ok, true AS confidence_ok, true AS accuracy_ok
    FROM documents LEFT JOIN labels USING (doc_id)"""
)
def document_quality_predictions(spark, base):
    """Sentiment-style classifier trained on the labelled documents, at the default settings."""
    documents = fx.table(spark, base, "documents").select("doc_id", F.lower("text").alias("text"))
    labels = fx.table(spark, base, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    labelled = documents.join(labels, "doc_id")
    classifier = N.train_sentiment(labelled, "text", "quality", "doc_id")
    predicted = classifier.predict(documents).join(labels, "doc_id", "left")
    return _facts(classifier, predicted, "doc_id", "quality", ["0", "1"], 0.6)
