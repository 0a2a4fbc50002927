"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition is one run of (digest, row) entries.  In each round groups of ``2 ** FAN_BITS`` neighbouring
runs exchange entries so that equal digests of a group meet, are merged in digest order and shrink to one entry: the
identifier that survives, verified by a second fingerprint and the length, and the number of copies.  After
``log(runs)`` rounds one run is left, spread over many tasks by digest.  A text that fills a third of all rows is one
entry per run after the first round, so no task ever sees its rows together.  Texts are read, never shuffled.

Defined results: null text is empty text; a null ``doc_id`` is smaller than every number, so such a row stays only
if all its copies lack an id; of rows repeating both id and text exactly one stays; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import ascii_lower, fresh, whole
from claimlens.session import stage

FAN_BITS = 4  # 16 runs meet in a round

KEY = ("digest", "bytes", "check")


def digest_runs(docs: DataFrame) -> DataFrame:
    """One entry per row, written once: run, place in the run, id, and what identifies the text.

    ``bytes`` and ``check`` verify the digest: entries merge only if all three agree.
    """
    text = docs.select("doc_id", ascii_lower(whole("text")).alias("text"))
    return stage(
        text.select(
            "doc_id",
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("entry"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.octet_length("text").alias("bytes"),
            F.xxhash64("text").alias("check"),
        ),
        "digest-runs",
    )


def merge_runs(entries: DataFrame) -> DataFrame:
    """Survivor (largest id, then first entry) and number of copies of every distinct text."""
    order = F.struct(F.col("doc_id").alias("doc_id"), (-F.col("entry")).alias("rank"))
    runs = entries.select(*KEY, F.col("run"), order.alias("keep"), F.lit(1).cast("long").alias("group_size"))
    left = (entries.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        runs = (
            runs.withColumn("run", F.shiftright("run", FAN_BITS))
            .groupBy(*KEY, "run")
            .agg(F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
        left = (left - 1 >> FAN_BITS) + 1
        if left == 1:
            return runs.drop("run")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row with the id that stays, its group's size and whether the row itself stays."""
    entries = digest_runs(docs)
    # Both sides are plain exchanges by digest: a digest with very many rows is split by AQE, its other side is one row.
    joined = entries.join(merge_runs(entries), list(KEY))
    return joined.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("entry") == -F.col("keep.rank")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows are matched by id and text; where a row repeats another one wholly in id and text, one of them passes.
    """
    stay = exact_groups(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, F.sha2(ascii_lower(whole("text")), 256))
    found = keyed.join(stay, keyed["doc_id"].eqNullSafe(stay["_id"]) & (keyed[key] == stay["_sha"]), "left_semi")
    return found.dropDuplicates(["doc_id", key]).drop(key)
