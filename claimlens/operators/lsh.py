"""Approximate nearest neighbours by cosine: random-hyperplane buckets, several tables, multi-probe, exact re-ranking.

A table's bucket is the sides of ``bits`` random hyperplanes a vector lies on.  A query looks into the ``probes`` buckets
whose planes it would have to cross least (the sum of squared distances to the planes it is on the wrong side of), its
own first.  Everything in these buckets is measured exactly, so the distances are true and only a neighbour that shares
no probed bucket in any table can be missed.  Vectors that lie in no particular direction need many probes; clustered
ones few.

Work is dealt as in the exact search: a (table, bucket) is a cell, and cells are cut into units of bounded size on both
sides, so that a vector which a third of all rows share makes more units, not a longer one.  Each unit returns at most
``k`` hits per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.operators.joins import skew_join
from claimlens.operators.neighbours import FARTHEST, _best, _matrix, _search, unit_vector
from claimlens.session import stage

TABLES = 3
BITS = 8
PROBES = 76  # of 2^BITS buckets of a table
SLICE = 1 << 22  # bucket costs held at once


@dataclass(frozen=True)
class Planes:
    """Hyperplanes of all tables: (table, bit, dimension)."""

    normals: np.ndarray

    @classmethod
    def draw(cls, d: int, tables: int = TABLES, bits: int = BITS, seed: int = 13) -> Planes:
        return cls(np.random.default_rng(seed).standard_normal((tables, bits, d)))

    @property
    def buckets(self) -> int:
        return 1 << self.normals.shape[1]

    def own(self, vectors: np.ndarray) -> np.ndarray:
        """Cell of each vector in each table, (row, table); a table's cells follow those of the one before."""
        tables, bits, _ = self.normals.shape
        sides = np.einsum("nd,tbd->ntb", vectors, self.normals) > 0
        return (sides << np.arange(bits)).sum(axis=2) + np.arange(tables) * self.buckets

    def probed(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """Cells each query looks into, (row, table * probes)."""
        tables, bits, _ = self.normals.shape
        probes = min(probes, self.buckets)
        positive = ((np.arange(self.buckets)[:, None] >> np.arange(bits)) & 1).astype(float)
        out = []
        step = max(1, SLICE // (tables * self.buckets))
        for start in range(0, len(vectors), step):
            margin = np.einsum("nd,tbd->ntb", vectors[start : start + step], self.normals)
            # a bucket on the other side of a plane costs the squared distance to it
            cost = np.square(np.maximum(margin, 0)) @ (1 - positive).T + np.square(np.minimum(margin, 0)) @ positive.T
            cells = np.argpartition(cost, probes - 1, axis=2)[:, :, :probes] + np.arange(tables)[:, None] * self.buckets
            out.append(cells.reshape(len(cells), -1))
        return np.concatenate(out) if out else np.zeros((0, tables * probes), np.int64)


def _with_cells(df: DataFrame, cells_of) -> DataFrame:
    """Rows of ``df`` once per cell that ``cells_of`` gives for their ``vec``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cells=list(cells_of(_matrix(batch["vec"])).astype("int32")))

    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes) + ", cells array<int>"
    return df.mapInPandas(run, schema).withColumn("cell", F.explode("cells")).drop("cells")


def _counts(df: DataFrame, n_cells: int) -> np.ndarray:
    counts = np.zeros(n_cells, int)
    for row in df.groupBy("cell").agg(F.count("*").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return counts


def approximate_join(
    queries: DataFrame, points: DataFrame, query_key: str, point_key: str, vector: str, k: int,
    tables: int = TABLES, bits: int = BITS, probes: int = PROBES,
) -> DataFrame:
    """About the ``k`` points nearest to each query: (query key, rank, neighbour, distance), ties by key.

    Rows whose vector is null or zero have no direction and take no part.  Of equal vectors the ``k`` lowest keys count.
    """
    asked = queries.select(query_key, unit_vector(F.col(vector)).alias("vec")).where(F.exists("vec", lambda x: x != 0))
    known = points.select(F.col(point_key).alias("key"), F.lit(None).cast("string").alias("payload"), unit_vector(F.col(vector)).alias("vec"))
    lowest = Window.partitionBy("vec").orderBy("key")
    known = known.where(F.exists("vec", lambda x: x != 0)).withColumn("_rn", F.row_number().over(lowest))
    known = known.where(F.col("_rn") <= k).drop("_rn")
    first = known.select("vec").first()
    if first is None:
        kind = dict(known.dtypes)["key"]
        return asked.select(query_key).limit(0).selectExpr("*", "1 AS rank", f"CAST(NULL AS {kind}) AS neighbour", "0D AS distance")
    planes = Planes.draw(len(first["vec"]), tables, bits)
    n_cells = tables * planes.buckets
    cells = stage(_with_cells(known, planes.own), "lsh-points")
    probed = _with_cells(asked.select("vec").distinct(), lambda v: planes.probed(v, probes))
    probed = stage(probed.withColumn("limit", F.lit(FARTHEST)), "lsh-queries")
    hits = _search(probed, cells, _counts(cells, n_cells), _counts(probed, n_cells), k)
    # a point met in several tables counts once
    once = hits.groupBy("vec", "hit.key").agg(F.min("hit").alias("hit")).select("vec", "hit")
    found = skew_join(asked, _best(once, k), "vec", F.col(query_key))
    return found.select(query_key, F.posexplode("neighbours").alias("pos", "hit")).select(
        query_key,
        (F.col("pos") + 1).alias("rank"),
        F.col("hit.key").alias("neighbour"),
        F.col("hit.distance").alias("distance"),
    )
