"""Training-data pipeline over ``documents``: quality, exact copies, near copies, benchmark passages, packing.

Every stage reads all rows that its predecessor kept and returns the columns of ``documents``, the last one the packed
pieces.  A row that reaches a stage is kept unless the stage's own decision is against it:

* quality: rows that the classifier predicts bad go;
* exact copies: of equal texts the row with the largest id stays;
* near copies: of a component of linked documents the one with the smallest id stays;
* benchmark: documents with a benchmark window go;
* packing: all that is left is tokenised and packed into sequences of 2048.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlens.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from claimlens.llm.common import table
from claimlens.session import new_stage_path, remove, staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", best_fit_packing),
]

# SQL states neither the trained classifier nor the packing; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again as the next one's input.

    What a stage wrote on its way, and the input it has read, are removed as soon as its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, apply in STAGES:
        path = new_stage_path(spark, name)
        with staging(spark):
            result = apply(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        remove(spark, before)
        before = [path]
    return docs
