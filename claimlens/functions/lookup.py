"""Constant-time lookup of a bounded dictionary inside a column expression."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucketed(spark: SparkSession, dictionaries: Mapping[str, Mapping[str, int]]) -> dict[str, str]:
    """Each dictionary as a JSON array of small maps, placed by Spark's own ``hash`` of the word.

    Spark searches a map literal from its first entry; one map per hash bucket keeps that search to a
    few entries however many words there are.
    """
    rows = [(name, word, code, len(codes)) for name, codes in dictionaries.items() for word, code in codes.items()]
    placed = spark.createDataFrame(rows, "name string, word string, code int, size int").select(
        "name", "word", "code", F.pmod(F.hash("word"), F.col("size")).alias("bucket")
    )
    buckets = {name: [{} for _ in range(max(1, len(codes)))] for name, codes in dictionaries.items()}
    for row in placed.collect():
        buckets[row["name"]][row["bucket"]][row["word"]] = row["code"]
    return {name: json.dumps(maps) for name, maps in buckets.items()}


def lookup(word: Column, buckets: str, missing: int, size: int) -> Column:
    """Code of ``word``; ``buckets`` folds to one literal when the plan is optimised."""
    table = F.from_json(F.lit(buckets), T.ArrayType(T.MapType(T.StringType(), T.IntegerType())))
    entry = F.get(table, F.pmod(F.hash(word), F.lit(size)))
    return F.coalesce(F.try_element_at(entry, word), F.lit(missing))
