"""Rows of embedding tables as the vector operators use them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite entries; false for a null one."""
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(inside, F.lit(False))


def usable(df: DataFrame, key: str, vector: str, **more: Column) -> DataFrame:
    """``key``, ``vec`` (array<double>) and ``more`` of the rows with an id and a finite, not empty vector."""
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vec"), *[c.alias(n) for n, c in more.items()])
    return rows.where(F.col("key").isNotNull() & finite(F.col("vec")) & (F.size("vec") > 0))


def dimension(rows: DataFrame) -> int:
    """The longest vector's size; 0 for no rows.  Rows of another size take no part."""
    return rows.agg(F.max(F.size("vec"))).first()[0] or 0


def matrix(lists: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """List column of ``d`` doubles each as a float64 matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def best_of(group: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores of each group, ties by smaller key, ordered by group."""
    order = np.lexsort((key, -score, group))
    sorted_group = group[order]
    first = np.searchsorted(sorted_group, sorted_group, side="left")
    return order[np.arange(len(order)) - first < k]
