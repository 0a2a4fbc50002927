"""Dictionaries of any size: codes are tables, and values meet them by exchange instead of a literal in the plan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from claimlens.functions import text as X
from claimlens.operators.joins import heavy, skew_join
from claimlens.operators.notes import token_counts
from claimlens.session import stage

CHUNK_BYTES = (8 << 20, 64 << 20)  # least and most text that asks for its words together


def with_position(df: DataFrame, name: str, *order) -> DataFrame:
    """Add ``name``: each row's 0-based place in the total order of ``order``, which must tell all rows apart.

    Rows are range-partitioned, sorted and written with their place in their range; the sizes of the ranges before it are
    added to that.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn("_row", F.monotonically_increasing_id()), "ranged")  # (range, place in it)
    row_range, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(2**33 - 1)
    sizes = ranged.groupBy(row_range.alias("_range")).agg(F.count("*").alias("_n"))  # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.join(F.broadcast(offsets), row_range == F.col("_range"))
    return placed.withColumn(name, F.col("_before") + place).drop("_range", "_row", "_before")


def value_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code, n_rows): the distinct values of ``column`` as text, numbered from 0 in code-point order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n_rows"))
    return with_position(counts, "code", "value")


def with_code(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the code of ``column``; null for null, for a value without code the next one after all codes.

    Rows of frequent values are dealt over several tasks, as the codes' row counts ask for.
    """
    codes = stage(codes, "codes")
    unseen = codes.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0]
    known = codes.select(F.col("value").alias("_value"), F.col("code").alias(name))
    hot = heavy(codes, "value", "n_rows").withColumnRenamed("value", "_value")
    keyed = df.withColumn("_value", F.col(column).cast("string"))
    joined = skew_join(keyed, known, "_value", F.struct(*df.columns), hot)
    code = F.when(F.col("_value").isNotNull(), F.coalesce(F.col(name), F.lit(unseen)))
    return joined.withColumn(name, code).select(*df.columns, name)


def whole_vocabulary(texts: DataFrame, column: str) -> DataFrame:
    """(word, n_uses, word_id) of every word: ids from 2 by falling use, ties alphabetical; 0 pads and 1 is unknown."""
    counted = stage(token_counts(texts, column), "word-counts")
    return with_position(counted, "word_id", F.desc("n_uses"), F.asc("word")).withColumn("word_id", F.col("word_id") + 2)


def encode_by_exchange(texts: DataFrame, vocabulary: DataFrame, key: str, column: str, max_len: int | None = None) -> DataFrame:
    """Add ``token_ids`` to ``texts``; with ``max_len`` cut or filled up with 0 to that length.

    Texts are written once in chunks of neighbouring rows, of ``CHUNK_BYTES`` of text each.  A chunk asks for each of
    its distinct words once, words that very many chunks ask for are dealt over several tasks, and the answers meet the
    chunk's texts.  Texts of the same ``key`` share their ids, in order of their places; without a key a text has none.
    """
    numbered = stage(texts.withColumn("_row", F.monotonically_increasing_id()), "texts")  # by task and place in it
    size = numbered.agg(F.count("*"), F.sum(F.octet_length(column))).first()
    tasks = texts.sparkSession.sparkContext.defaultParallelism
    wanted = min(max((size[1] or 0) // (2 * tasks), CHUNK_BYTES[0]), CHUNK_BYTES[1])
    rows = max(1, wanted * size[0] // max(size[1] or 0, 1))
    chunk = F.col("_row") - F.col("_row").bitwiseAND(2**33 - 1) % rows
    keyed = numbered.withColumn("_chunk", chunk).drop("_row")
    repeated = stage(keyed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated")
    alone = keyed
    if not repeated.isEmpty():
        alone = keyed.join(repeated, key, "left_anti").select(*keyed.columns)
    words = X.tokens(F.when(F.col(key).isNotNull(), F.col(column)), max_len)
    asked = alone.select("_chunk", F.explode(F.array_distinct(words)).alias("word")).distinct()
    found = skew_join(asked, vocabulary.select("word", "word_id"), "word", F.col("_chunk"), heavy(vocabulary, "word", "n_uses"))
    found = found.where(F.col("word_id").isNotNull()).select(F.col("_chunk").alias("_asked"), "word", "word_id")
    encoded = alone.repartition("_chunk").withColumn("_words", words).groupBy("_chunk").cogroup(found.groupBy("_asked")).applyInArrow(
        _chunk_ids, StructType([*texts.schema.fields, StructField("token_ids", ArrayType(LongType()))])
    )
    if not repeated.isEmpty():
        together = keyed.join(repeated, key, "left_semi").select(*texts.columns)
        encoded = encoded.unionByName(_encode_together(together, vocabulary, key, column, max_len))
    if max_len is None:
        return encoded
    ids = F.concat("token_ids", F.array_repeat(F.lit(0).cast("long"), F.lit(max_len) - F.size("token_ids")))
    return encoded.withColumn("token_ids", ids)


def _chunk_ids(texts: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of a chunk with the ids of their words; 1 for a word without id."""
    words = texts.column("_words").combine_chunks()
    place = pc.index_in(words.flatten(), value_set=found.column("word").combine_chunks())
    ids = pc.fill_null(found.column("word_id").combine_chunks().cast(pa.int64()).take(place), 1)
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return texts.drop_columns(["_chunk", "_words"]).append_column("token_ids", pa.ListArray.from_arrays(ends, ids))


def _encode_together(texts: DataFrame, vocabulary: DataFrame, key: str, column: str, max_len: int | None) -> DataFrame:
    """``token_ids`` of texts that share keys, word by word: ids go back by key and are put in order there."""
    placed = texts.select(F.col(key).alias("_key"), F.posexplode(X.tokens(F.col(column), max_len)).alias("pos", "word"))
    sent = placed.groupBy("_key", "word").agg(F.collect_list("pos").alias("places"))
    met = skew_join(sent, vocabulary.select("word", "word_id"), "word", F.col("_key"), heavy(vocabulary, "word", "n_uses"))
    entries = F.transform("places", lambda p: F.struct(p.alias("pos"), F.coalesce("word_id", F.lit(1)).alias("id")))
    back = met.groupBy("_key").agg(F.sort_array(F.flatten(F.collect_list(entries)))["id"].alias("_ids"))
    joined = texts.join(back, F.col(key) == F.col("_key"), "left").drop("_key")
    ids = F.coalesce("_ids", F.array().cast("array<long>"))
    return joined.withColumn("token_ids", ids).drop("_ids")
