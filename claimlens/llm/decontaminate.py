"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training token window.

The benchmark's windows are broadcast in blocks of a stated size, however large the benchmark is and whatever its items
share: blocks are cut by a hash of the whole window and hold no item ids.  Each block meets every token window of every
document inside the scan, so nothing is shuffled but hits and one count row per document; the ids of the items are
joined to the hits afterwards.  The first three words of a window are its hash key; a hit is verified word for word.

Defined results: null text has no words; an item of no words has no window, one of fewer than ``size`` words is one
window; a null ``item_id`` is listed as an empty string; rows repeating id and text give one row each; rows sharing
an id but not the text are judged apart; empty tables give no rows or no hits.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import ascii_lower, fresh, whole, word_list
from claimlens.session import new_stage_path, stage

WINDOW = 10
ANCHOR = 3  # leading words that make the hash key
BLOCK = 400_000  # windows in a broadcast
BYTES = 200  # of text that a window may have on average in a broadcast; longer ones make more blocks


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def _anchor(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, start + i) for i in range(length)])


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Windows (anchor, lead, length, window) of every item, once each."""
    words = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        word_list(ascii_lower(whole("text"))).alias("words"),
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    starts = words.withColumn("length", length).withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length")))
    )
    lead = F.least(F.col("length"), F.lit(ANCHOR))
    anchor = reduce(
        lambda rest, n: F.when(lead == n, _anchor(F.col("words"), F.col("start"), n)).otherwise(rest),
        range(1, ANCHOR),
        _anchor(F.col("words"), F.col("start"), ANCHOR),
    )
    return starts.select(
        anchor.alias("anchor"),
        lead.alias("lead"),
        "length",
        _joined(F.col("words"), F.col("start"), F.col("length")).alias("window"),
        "item",
    ).distinct()


def _scan(docs: DataFrame, windows: DataFrame, leads: list[int]) -> DataFrame:
    """Hits of one block of windows, and for each row of ``docs`` one row that counts it."""
    words = docs.select(
        "doc_id", F.xxhash64("text").alias("version"), word_list(ascii_lower(whole("text"))).alias("words")
    )
    tokens = words.select(
        "doc_id", "version", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "_")
    ).withColumn("pos", F.coalesce("pos", F.lit(0)))
    anchors = [_anchor(F.col("words"), F.col("pos"), n) for n in leads]
    if len(anchors) == 1:
        tokens = tokens.withColumn("at", F.lit(0)).withColumn("_anchor", anchors[0])
    else:  # a benchmark with items of one or two words looks every place up by each length of key
        tokens = tokens.select("*", F.posexplode(F.array(*anchors)).alias("at", "_anchor"))
    met = (
        (F.col("_anchor") == F.col("anchor"))
        & (F.col("pos") + F.col("length") <= F.col("n_words"))
        & (F.col("window") == _joined(F.col("words"), F.col("pos"), F.col("length")))
    )
    counts = (F.col("pos") == 0) & (F.col("at") == 0)
    return (
        tokens.join(F.broadcast(windows), met, "left")
        .where(counts | F.col("window").isNotNull())
        .select(
            "doc_id",
            "version",
            F.col("n_words").cast("long").alias("n_words"),
            counts.alias("counts"),
            F.when(F.col("window").isNotNull(), F.struct("pos", "length")).alias("span"),
            "window",
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: n_words, n_hit, n_items, items (sorted as strings), spans and version of its text."""
    of_items = stage(item_windows(benchmark, size), "item-windows")
    windows = stage(of_items.drop("item").distinct(), "test-windows")
    facts = windows.agg(F.count("*"), F.sort_array(F.collect_set("lead")), F.sum(F.octet_length("window"))).first()
    blocks, leads = max(1, math.ceil(max(facts[0], (facts[2] or 0) / BYTES) / block)), facts[1] or [ANCHOR]
    path = new_stage_path(docs.sparkSession, "window-hits")
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b) if blocks > 1 else windows
        scan = _scan(docs, part, leads)
        scan = scan if b == 0 else scan.where("window IS NOT NULL").withColumn("counts", F.lit(False))
        # written before the next block begins, so that one broadcast is held at a time
        scan.write.mode("append").parquet(path)
    found = docs.sparkSession.read.schema(scan.schema).parquet(path)
    hits = found.where("window IS NOT NULL").select("doc_id", "version", "window").distinct()
    items = (
        hits.join(of_items.select("window", "item"), "window")
        .groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
        .agg(F.collect_set("item").alias("items"))
    )
    per_doc = found.groupBy("doc_id", "version").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("span").alias("spans"),
        # The counting row, at place 0, comes once for every window of the block that begins there.
        F.count_if("counts").alias("count_rows"),
        F.size(F.collect_set(F.when(F.col("counts"), F.coalesce("window", F.lit(""))))).alias("at_start"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    per_doc = per_doc.join(items, same, "left").drop("_id", "_version")
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["length"] - 1)))
    rows = (F.col("count_rows") / F.col("at_start")).cast("int")
    return per_doc.select(
        "doc_id",
        "version",
        "n_words",
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.sort_array(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
        "spans",
        F.explode(F.sequence(F.lit(1), rows)).alias("_copy"),
    ).drop("_copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, remove: str = "documents") -> DataFrame:
    """``docs`` without what overlaps the benchmark: whole documents, or (``spans``) only the words hit.

    With ``spans`` a hit word goes together with the gap after it; everything else stays as written.
    """
    hit = contamination(docs, benchmark, size).where("n_hit > 0")
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "spans").dropDuplicates(
        ["_id", "_version"]
    )
    hit = hit.withColumn(
        "spans",
        F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["length"] - 1)))),
    )
    same = docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_version"])
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all("text", F.lit(f"({word}{gap}*)"), F.lit(1))
    head = F.regexp_extract("text", f"^({gap}*)", 1)
    covered = fresh(docs, "covered")
    rest = F.filter(pieces, lambda _, i: ~F.array_contains(F.col(covered), i))
    joined = docs.join(hit, same, "left").select(*[docs[c] for c in docs.columns], hit["spans"].alias(covered))
    left = F.concat(head, F.array_join(rest, ""))
    return joined.withColumn("text", F.when(F.col(covered).isNull(), F.col("text")).otherwise(left)).drop(covered)
