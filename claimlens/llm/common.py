"""Text helpers shared by the corpus operators; all of them are built-in column functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Everything that is not a digit, an ASCII lower-case letter or a non-ASCII character.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole(text: Column | str) -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that for pure ASCII texts and is the faster of the two."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_list(lowered: Column) -> Column:
    """Words of an ASCII-lower-cased text: maximal runs of 0-9, a-z and non-ASCII characters."""
    return F.array_remove(F.split(lowered, WORD_GAP), "")


def learn_row(doc_id: Column | str) -> Column:
    """True for rows whose labels may be learnt from: crc32 of the id as text, mod 3, is not 1."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 3 != 1, F.lit(True))
