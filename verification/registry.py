"""Registered queries: name -> (callable on (spark, table folder), SQL over the same tables or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name; ``sql`` is the independent statement of its result."""

    def add(fn: Query) -> Query:
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__} is registered twice")
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return add


# Sums of doubles depend on the order of addition, so both sides round to 4 digits.  Averages of cents
# often lie exactly between two such values; the offset keeps them off that edge on both sides.
ROUND_OFFSET = 0.0000123


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(c) + ROUND_OFFSET, 4).alias(c) if t == "double" and c not in keep else F.col(c)
            for c, t in df.dtypes
        ]
    )
