"""Texts are cleaned as before by faster patterns, and split without being sent."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions.text import clean_text
from claimlens.operators import notes
from claimlens.operators.ranking import plain_split, stratified_split, wide_split
from claimlens.session import stage


@pytest.mark.parametrize("abbreviations", [C.ABBREVIATIONS, C.ABBREVIATIONS_SHORT])
def test_cleaning_is_that_of_the_plain_patterns(spark, abbreviations):
    draw = random.Random(3)
    pieces = [*abbreviations, "Pt", "apt", "pt.", "é", "pté", "N/V", "n/", " ", "  ", "\t", "\n", "-", "/", "\\", ",", ".", "!", "?[", "^]", "_", "9", "ab"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 25))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["c"] for r in df.orderBy("i").select(clean_text(F.col("t"), abbreviations).alias("c")).collect()]
    words = "|".join(map(re.escape, abbreviations))
    for text, clean in zip(texts, got):
        full = re.sub(rf"\b({words})\b", lambda m: abbreviations[m[1]], text.lower())
        assert clean == re.sub(r"[^a-z0-9.,\-/]+", " ", full).strip(" "), text


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"N{i:04d}", "abc"[i % 3 if i % 7 else 0], f"word{i % 5} other{i % 3} text") for i in range(700)]
    return stage(spark.createDataFrame([*rows, (None, "a", "no key")], "key string, label string, text string"), "labelled")


def test_wide_split_is_the_split(labelled):
    for wide, ranked in (
        (wide_split(labelled, "label", "key"), stratified_split(labelled, "label", "key")),
        (wide_split(labelled, None, "key", 0.3, 7), plain_split(labelled, "key", 0.3, 7)),
    ):
        columns = ["key", "label", "text", "is_test"]
        assert sorted(map(tuple, wide.select(*columns).collect())) == sorted(map(tuple, ranked.select(*columns).collect()))
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan


def test_wide_split_with_repeated_keys(labelled):
    repeated = stage(labelled.select("label", "text", F.substring("key", 1, 3).alias("key")), "repeated")
    wide, ranked = wide_split(repeated, None, "key", 0.23), plain_split(repeated, "key", 0.23)
    assert wide.count() == ranked.count() and wide.agg(F.sum("is_test")).first()[0] == ranked.agg(F.sum("is_test")).first()[0]


@pytest.mark.parametrize("stratified", [False, True])
def test_classifier_learns_from_the_counts(spark, stratified):
    rows = [(f"N{i}", "xy"[i % 2], f"{'left' if i % 2 else 'right'} note {i % 11}") for i in range(300)]
    df = spark.createDataFrame(rows, "note_id string, diagnosis_code string, clean_text string")
    found = notes.train_text_classifier(df, "clean_text", "diagnosis_code", "note_id", stratified=stratified)
    assert found.holdout_accuracy == 1.0 and found.unseen == 0
    assert found.predict(df).where("predicted_label <> diagnosis_code").isEmpty()
