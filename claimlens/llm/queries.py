"""Registered queries of the corpus operators: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (
    decontaminate,
    exact_dedup,
    graph_index,
    hard_negatives,
    jaccard_join,
    langid,
    licenses,
    line_dedup,
    main_text,
    packing,
    quality,
    toxicity,
    whitening,
)
from claimlens.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("version", "blocks")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "languages"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=shifted)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan,
        op2_main_text,
        op3_exact_dedup,
        op4_toxicity,
        op5_language_id,
        op6_decontamination,
        op7_line_dedup,
        op8_packing,
        op9_quality,
        op10_jaccard_join,
        op11_nearest_neighbours,
        op12_hard_negatives,
        op13_whitening,
    )
}
