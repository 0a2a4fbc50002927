"""Note tables: cleaning, vocabulary, encoding, keyword analysis and trained text classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions import text as X
from claimlens.functions.lookup import bucketed
from claimlens.functions.vectors import padded_ids
from claimlens.operators.ranking import wide_split
from claimlens.session import stage


def clean_notes(notes: DataFrame, column: str = "clinical_note") -> DataFrame:
    return notes.withColumn("clean_text", X.clean_text(F.col(column)))


def token_counts(texts: DataFrame, column: str) -> DataFrame:
    """Occurrences of every token; counted within each partition before words are exchanged."""
    # the outer form, because Spark splits every text twice to skip empty ones early
    words = texts.select(F.explode_outer(X.tokens(F.col(column))).alias("word")).where("word IS NOT NULL")
    return words.groupBy("word").agg(F.count("*").alias("n_uses"))


def build_vocab(texts: DataFrame, column: str, max_vocab: int = 10_000) -> DataFrame:
    """Ids 2.. for the most used words, ties alphabetical; 0 is padding and 1 the unknown word."""
    top = token_counts(texts, column).orderBy(F.desc("n_uses"), "word").limit(max_vocab - 2)
    # the window sees at most max_vocab - 2 rows
    order = Window.orderBy(F.desc("n_uses"), "word")
    return top.withColumn("word_id", F.row_number().over(order) + 1)


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary ready to be used inside expressions; its size is bounded by ``max_vocab``."""

    buckets: str
    size: int

    @classmethod
    def of(cls, vocab: DataFrame) -> Vocabulary:
        codes = {row["word"]: row["word_id"] for row in vocab.select("word", "word_id").collect()}
        return cls(bucketed(vocab.sparkSession, {"words": codes})["words"], max(1, len(codes)))


def encode_notes(
    notes: DataFrame, vocabulary: Vocabulary, column: str = "clean_text", max_len: int = 64
) -> DataFrame:
    """Add ``token_ids``: exactly ``max_len`` ids per note, without a shuffle."""
    ids = padded_ids(X.tokens(F.col(column), max_len), vocabulary.buckets, vocabulary.size, max_len)
    return notes.withColumn("token_ids", ids)


def analyze_notes(notes: DataFrame) -> DataFrame:
    """Analysis record of each note by the keyword rules."""
    cleaned = notes.select("note_id", X.clean_text(F.col("clinical_note"), C.ABBREVIATIONS_SHORT).alias("_text"))
    return cleaned.withColumn("_rule", X.keyword_diagnosis(F.col("_text"))).select(
        "note_id",
        F.substring("_text", 1, 200).alias("cleaned_text"),
        F.col("_rule.code").alias("predicted_diagnosis"),
        F.col("_rule.confidence").alias("confidence"),
        F.lit("neutral").alias("sentiment"),
    )


@dataclass
class TextClassifier:
    """Fitted classifier, its labels, its accuracy on the held-out rows and how many of their labels it never saw."""

    model: PipelineModel
    holdout_accuracy: float
    labels: tuple[str, ...] = ()
    unseen: int = 0

    def predict(self, texts: DataFrame) -> DataFrame:
        """Add ``predicted_label`` and ``confidence``: the largest probability to 4 digits."""
        out = self.model.transform(texts)
        confidence = F.round(F.array_max(vector_to_array("probability")), 4)
        dropped = ["_words", "_counts", "_tfidf", "rawPrediction", "probability", "prediction", "_label"]
        return out.withColumn("confidence", confidence).drop(*dropped)


def train_text_classifier(
    texts: DataFrame,
    text: str,
    label: str,
    key: str,
    test_fraction: float = 0.2,
    stratified: bool = False,
    max_vocab: int = 10_000,
    max_iter: int = 50,
    seed: int = 42,
) -> TextClassifier:
    """Multinomial logistic regression on TF-IDF of the words of whole texts.

    Learns the labels of the training rows and predicts no other.  Rows without a label are neither learnt from nor
    evaluated; a held-out row whose label training has not met counts as a miss and in ``unseen``.
    """
    labelled = texts.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("string"))
    columns = list(dict.fromkeys([key, text, label]))
    split = wide_split(labelled.select(*columns), label if stratified else None, key, test_fraction, seed)
    split = stage(split.select(text, label, "is_test"), "text-split")  # its words are taken twice
    indexer = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(split.where("is_test = 0").select(label))
    words = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\s+")
    counter = CountVectorizer(inputCol="_words", outputCol="_counts", vocabSize=max_vocab)
    counter = counter.fit(words.transform(split.where("is_test = 0")))
    # what follows needs the counts only
    counted = stage(counter.transform(words.transform(split)).select(label, "is_test", "_counts"), "text-counts")
    train, held_out = counted.where("is_test = 0"), counted.where("is_test = 1")
    idf = IDF(inputCol="_counts", outputCol="_tfidf").fit(train)
    learner = LogisticRegression(featuresCol="_tfidf", labelCol="_label", family="multinomial", maxIter=max_iter, regParam=1e-4)
    learnt = learner.fit(indexer.transform(idf.transform(train)))
    named = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer.labels)
    fitted = PipelineModel([words, counter, idf, learnt, named])
    hit = (F.col("predicted_label") == F.col(label)).cast("double")
    accuracy, unseen = PipelineModel([idf, learnt, named]).transform(held_out).agg(F.avg(hit), F.count_if(~F.col(label).isin(list(indexer.labels)))).first()
    return TextClassifier(fitted, accuracy if accuracy is not None else float("nan"), tuple(indexer.labels), unseen)


def train_note_classifier(notes: DataFrame, **options) -> TextClassifier:
    """Diagnosis code from the cleaned note."""
    return train_text_classifier(notes, "clean_text", "diagnosis_code", "note_id", **options)


def train_sentiment(texts: DataFrame, text: str, label: str, key: str, **options) -> TextClassifier:
    """Feedback sentiment learned from labelled texts."""
    return train_text_classifier(texts, text, label, key, stratified=True, **options)
