"""Line deduplication: lines repeated across documents stay only in the last document that holds them.

Lines become 128-bit keys; no text is shuffled to find the repeated ones.  Occurrences are dealt into slices by a hash
of their document and range-partitioned by (key, slice), so that even a line that stands in every document is spread
over many tasks.  Inside a range they are sorted by document, last first, and position, and a window streams over them:
an occurrence whose predecessor lies in another document is that document's first one.  What a slice knows of a key
(its documents, the last of them) then meets by key.  What stays comes back as a compressed keep bitmap per document
that loses lines: 64 positions to a word, words whose lines all stay are left out.  It is applied to the text in the end.

Defined results: null or empty text is one empty line; rows without ``doc_id`` keep every line and count for none;
rows sharing an id are one document; repeated rows are treated alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import ascii_lower, fresh, whole
from claimlens.session import stage

MIN_CHARS = 40
MIN_DOCS = 5
SLICE_ROWS = 4096  # occurrences for which there is one more slice
BLANK = " \t\n\x0b\x0c\r"  # 20 and 09 to 0D


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, document, text version, position) of every line long enough."""
    lines = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode_outer(_lines(whole("text"))).alias("pos", "line")
    )
    key = lines.withColumn("line", F.btrim("line", F.lit(BLANK))).where(F.char_length("line") >= min_chars)
    return key.select(F.unhex(F.md5(ascii_lower(F.col("line")))).alias("key"), "doc_id", "version", "pos")


def repeated_keys(runs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, last_doc) of every key that at least ``min_docs`` documents hold; ``runs``: stored occurrences."""
    slices = 1 + runs.count() // SLICE_ROWS
    dealt = runs.select("key", "doc_id", "pos", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).alias("slice"))
    ranged = dealt.repartitionByRange("key", "slice").sortWithinPartitions("key", "slice", F.desc("doc_id"), "pos")
    order = Window.partitionBy("key", "slice").orderBy(F.desc("doc_id"), "pos")
    streamed = ranged.withColumn("before", F.lag("doc_id").over(order))
    first = streamed.where(F.col("before").isNull() | (F.col("before") != F.col("doc_id")))
    # the ranges hold every slice of a key whole, so this level needs no further exchange
    edges = first.groupBy("key", "slice").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    met = edges.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
    return met.where(F.col("n_docs") >= min_docs).select("key", "last_doc")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, bits: word -> 64 positions, 1 for a line that stays; n_dropped) of documents that lose lines."""
    runs = stage(occurrences(docs, min_chars), "line-keys")
    # Written once, so that the join has two plain exchanges: AQE then splits a key that very many lines share.
    repeated = stage(repeated_keys(runs, min_docs), "repeated-lines")
    dropped = runs.join(repeated, "key").where(F.col("doc_id") < F.col("last_doc"))
    words = dropped.groupBy("doc_id", "version", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits")
    )
    return words.groupBy("doc_id", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("bits"),
        F.sum(F.bit_count("bits")).alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs``, with ``text`` cut to its kept lines, and n_lines, n_dropped, keep_bits.

    Where ``docs`` has columns of these three names, the new ones get underscores in front.
    """
    n_lines, n_dropped, keep_bits = (fresh(docs, name) for name in ("n_lines", "n_dropped", "keep_bits"))
    maps = keep_bitmaps(docs, min_chars, min_docs)
    maps = maps.select(F.col("doc_id").alias("_id"), "version", F.col("bits").alias(keep_bits), F.col("n_dropped").alias(n_dropped))
    same = (docs["doc_id"] == maps["_id"]) & (F.xxhash64(docs["text"]) == maps["version"])
    joined = docs.join(maps, same, "left").select(*[docs[c] for c in docs.columns], maps[keep_bits], maps[n_dropped])
    kept = F.array_join(
        F.filter(
            _lines(whole("text")),
            lambda line, i: F.getbit(F.coalesce(F.col(keep_bits)[F.shiftright(i, 6)], F.lit(-1)), i.bitwiseAND(63)) == 1,
        ),
        "\n",
    )
    return joined.withColumns(
        {
            "text": F.when(F.col(keep_bits).isNull(), whole("text")).otherwise(kept),
            n_lines: F.size(_lines(whole("text"))).cast("long"),
            n_dropped: F.coalesce(n_dropped, F.lit(0)).cast("long"),
        }
    )
