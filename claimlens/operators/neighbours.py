"""Exact k nearest neighbours by cosine distance, without a cross join.

Points are cut into cells around pivots drawn from the points themselves, so dense regions get more
cells.  Each query first searches its own cell; the distance of its ``k``-th hit there bounds how far it
has to look, and on unit vectors (where the chord is a metric) the triangle inequality and the bisecting
plane between two pivots tell which other cells can still hold something nearer.  Only those are
searched.  Cells lie in groups of neighbours, the work is dealt out in units of bounded size (a part of the
queries against a part of a group), and a vector is sent once per unit, however many of its cells are searched.
Each unit returns ``k`` hits per query, and a ranked merge keeps the best ``k``.  Identical vectors are collapsed
first: of any one vector only the ``k`` lowest keys can matter.

``NeighbourIndex`` keeps the cells as a table, in folders of neighbouring cell numbers, with pivots, sizes and radii
beside it.  It is fitted once and asked often: a question measures the queries against the pivots and reads only the
folders whose cells it has to search; no point is assigned again.  Pivots are held in two levels, so that a vector's
nearest pivot (an exact one) costs a look at the groups that can hold it, not at all pivots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.functions.vectors import dot
from claimlens.operators.joins import skew_join
from claimlens.session import new_stage_path, stage

PAIRS = 1 << 21  # (vector, pivot) distances computed at once
QUERY_UNIT = 16_384  # queries per work unit
POINT_UNIT = 16_384  # points per work unit
BLOCK = 256  # query rows per distance matrix
FOLDERS = 512  # folders of a stored index at most
SLACK = 1e-6  # rounding of chord lengths
FARTHEST = 2.0 + 1e-9  # no cosine distance is larger
EDGE = 1e-12  # rounding of a distance computed twice


def unit_vector(vector: Column) -> Column:
    """Vector scaled to length 1; a zero vector stays zero."""
    length = F.sqrt(dot(vector, vector))
    return F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy())


def _chords(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ pivots.T)))


def _parts(batch: pd.DataFrame, pivots: int) -> Iterator[pd.DataFrame]:
    """Slices of a batch whose distances to all pivots fit in memory."""
    step = max(1, PAIRS // pivots)
    for start in range(0, len(batch), step):
        yield batch.iloc[start : start + step]


@dataclass(frozen=True)
class _Pivots:
    """Pivots and their groups: every pivot belongs to the nearest of about root(pivots) heads."""

    centres: np.ndarray
    heads: np.ndarray  # numbers of the pivots that head a group
    group: np.ndarray  # each pivot's group
    radius: np.ndarray  # each group's largest chord from head to pivot

    @classmethod
    def of(cls, centres: np.ndarray) -> _Pivots:
        heads = np.arange(max(1, math.isqrt(len(centres))))
        chords = np.vstack([_chords(centres[at : at + 4096], centres[heads]) for at in range(0, len(centres), 4096)])
        group = chords.argmin(axis=1)
        radius = np.zeros(len(heads))
        np.maximum.at(radius, group, chords[np.arange(len(centres)), group])
        return cls(centres, heads, group, radius)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest pivot and the chord to it."""
        to_head = _chords(vectors, self.centres[self.heads])
        own = to_head.argmin(axis=1)
        cell, reach = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.inf)
        members = [np.flatnonzero(self.group == g) for g in range(len(self.heads))]
        for first in (True, False):
            for g, pivots in enumerate(members):
                rows = own == g if first else (own != g) & (to_head[:, g] - self.radius[g] <= reach + SLACK)
                rows = np.flatnonzero(rows)
                if len(rows):
                    chords = _chords(vectors[rows], self.centres[pivots])
                    best = chords.argmin(axis=1)
                    chord = chords[np.arange(len(rows)), best]
                    nearer = chord < reach[rows]
                    cell[rows[nearer]], reach[rows[nearer]] = pivots[best[nearer]], chord[nearer]
        return cell, reach


def _assign(df: DataFrame, pivots: _Pivots) -> DataFrame:
    """Add each vector's nearest pivot and the chord to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch, len(pivots.centres)):
                cell, reach = pivots.nearest(_matrix(part["vec"]))
                yield part.assign(cell=cell.astype("int32"), reach=reach)

    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes) + ", cell int, reach double"
    return df.mapInPandas(run, schema)


def _wanted(own: np.ndarray, vectors: np.ndarray, limit: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(query, cell): whether the cell may hold a point within the query's ``limit``; its own cell always may.

    No point of cell j is nearer than the chord to pivot j less the cell's radius, nor nearer than the
    plane between pivot j and the query's own pivot.
    """
    chords = _chords(vectors, pivots)
    home = chords[np.arange(len(own)), own][:, None]
    plane = (chords**2 - home**2) / np.maximum(2.0 * _chords(pivots[own], pivots), SLACK)
    floor = np.maximum(chords - radius, plane)
    reach = np.sqrt(2.0 * limit)[:, None]  # chord of the cosine distance
    wanted = (floor <= reach + SLACK) & (radius >= 0)
    wanted[np.arange(len(own)), own] = True
    return wanted


def _with_wanted(searched: DataFrame, pivots: np.ndarray, radius: np.ndarray) -> DataFrame:
    """Add each query's cells as a bitmap, ``wanted``: one row per query, however many cells it searches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch, len(pivots)):
                wanted = _wanted(part["cell"].to_numpy(), _matrix(part["vec"]), part["limit"].to_numpy(), pivots, radius)
                yield part.assign(wanted=[row.tobytes() for row in np.packbits(wanted, axis=1)])

    schema = ", ".join(f"{n} {t}" for n, t in searched.dtypes) + ", wanted binary"
    return searched.mapInPandas(run, schema)


def _bits(bitmaps: pd.Series, n: int) -> np.ndarray:
    """(row, cell) of bitmaps of ``n`` cells."""
    return np.unpackbits(np.frombuffer(b"".join(bitmaps), np.uint8).reshape(len(bitmaps), -1), axis=1, count=n).astype(bool)


def _asked(queries: DataFrame, group: np.ndarray) -> DataFrame:
    """Add ``groups``: the groups that hold a cell the query wants."""
    order = np.argsort(group, kind="stable")
    names, first = np.unique(group[order], return_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch, len(group)):
                inside = np.logical_or.reduceat(_bits(part["wanted"], len(group))[:, order], first, axis=1)
                yield part.assign(groups=[names[row].astype("int32") for row in inside])

    return queries.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in queries.dtypes) + ", groups array<int>")


def _cells_of(queries: DataFrame, n: int) -> np.ndarray:
    """Whether any query wants each of the ``n`` cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(n, bool)
        for batch in batches:
            for part in _parts(batch, n):
                found |= _bits(part["wanted"], n).any(axis=0)
        yield pd.DataFrame({"cell": np.flatnonzero(found).astype("int32")})

    asked = np.zeros(n, bool)
    asked[[row["cell"] for row in queries.select("wanted").mapInPandas(run, "cell int").distinct().collect()]] = True
    return asked


def _per_cell(values: np.ndarray, cell: Column) -> Column:
    """Value of a cell from a per-cell array (one entry per pivot, the root of the points)."""
    return F.get(F.from_json(F.lit(str([int(v) for v in values])), "array<int>"), cell)


def _nearest_in_unit(k: int):
    """Best ``k`` points of a unit for each of its queries, ties in key order, none beyond the query's limit."""

    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {"vec": [], "distance": [], "key": [], "payload": []}
        if len(queries) and len(points):
            points = points.sort_values("key", kind="stable")
            keys, payload = points["key"].to_numpy(), points["payload"].to_numpy()
            target = _matrix(points["vec"])
            vectors, limits = queries["vec"].to_numpy(), queries["limit"].to_numpy()
            for start in range(0, len(queries), BLOCK):
                block = vectors[start : start + BLOCK]
                near, length = _nearest_distances(np.maximum(0.0, 1.0 - np.vstack(block) @ target.T), k)
                hits = (length <= limits[start : start + BLOCK, None]).sum(axis=1)
                for row in np.flatnonzero(hits):
                    n = hits[row]
                    found["vec"].append(block[row])
                    found["distance"].append(length[row, :n])
                    found["key"].append(keys[near[row, :n]])
                    found["payload"].append(payload[near[row, :n]])
        return pd.DataFrame(found).astype(object)  # a unit without hits has no types of its own

    return run


def _search(asked: DataFrame, points: DataFrame, n_points: np.ndarray, n_queries: np.ndarray, k: int) -> DataFrame:
    """Best ``k`` hits of each (query, cell) in ``asked`` among the cell's points, up to its ``limit``.

    Both sides are dealt into parts of bounded size; every (query part, point part) pair is one unit.
    """
    cell = F.col("cell")
    query_parts = _per_cell(np.maximum(1, -(-n_queries // QUERY_UNIT)), cell)
    point_parts = _per_cell(np.maximum(1, -(-n_points // POINT_UNIT)), cell)

    def part(column: str, parts: Column) -> Column:
        return F.pmod(F.xxhash64(column), parts).cast("int")

    def every(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), parts - 1))

    left = asked.select("vec", "limit", "cell", part("vec", query_parts).alias("query_part"), every(point_parts).alias("point_part"))
    # a cell nobody asks for is not sent anywhere
    wanted = F.get(F.from_json(F.lit(str([int(v) for v in n_queries])), "array<int>"), cell) > 0
    right = points.where(wanted).select(
        "vec", "key", "payload", "cell", every(query_parts).alias("query_part"), part("key", point_parts).alias("point_part")
    )
    key = dict(points.dtypes)["key"]
    unit = ["cell", "query_part", "point_part"]
    schema = f"vec array<double>, distance array<double>, key array<{key}>, payload array<string>"
    hits = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(_nearest_in_unit(k), schema)
    return hits.select("vec", F.explode(F.arrays_zip("distance", "key", "payload")).alias("hit"))


def _best(hits: DataFrame, k: int, query: str = "vec") -> DataFrame:
    """One row per query with its ``k`` best hits in order."""
    order = Window.partitionBy(query).orderBy("hit")
    ranked = hits.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k)
    return ranked.groupBy(query).agg(F.array_sort(F.collect_list("hit")).alias("neighbours"))


def _nearest_distances(distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of each row's ``k`` smallest distances, and these, in order; ties in column order."""
    keep = min(k, distances.shape[1])
    near = np.argpartition(distances, keep - 1, axis=1)[:, :keep]
    last = np.take_along_axis(distances, near, axis=1).max(axis=1, keepdims=True)
    for row in np.flatnonzero((distances <= last).sum(axis=1) > keep):  # ties at the edge
        tied = np.flatnonzero(distances[row] <= last[row])
        near[row] = tied[np.argsort(distances[row, tied], kind="stable")][:keep]
    length = np.take_along_axis(distances, near, axis=1)
    order = np.lexsort((near, length), axis=-1)
    return tuple(np.take_along_axis(x, order, axis=1) for x in (near, length))


def _nearest_in_group(k: int, cells: int):
    """Best ``k`` points of a unit for each of its queries, as rows; a block of queries meets the cells it wants."""

    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(queries) and len(points):
            points = points.sort_values("key", kind="stable")
            keys, payload, cell = (points[c].to_numpy() for c in ("key", "payload", "cell"))
            target = _matrix(points["vec"])
            present, slot = np.unique(cell, return_inverse=True)
            queries = queries.sort_values("cell", kind="stable")  # of one home: they want much the same cells
            for start in range(0, len(queries), BLOCK):
                block = queries.iloc[start : start + BLOCK]
                met = np.flatnonzero(_bits(block["wanted"], cells)[:, present].any(axis=0)[slot])
                if not len(met):
                    continue
                some = target if len(met) == len(target) else target[met]
                near, length = _nearest_distances(np.maximum(0.0, 1.0 - _matrix(block["vec"]) @ some.T), k)
                row, at = np.nonzero(length <= block["limit"].to_numpy()[:, None])
                chosen = met[near[row, at]]
                found.append(pd.DataFrame({
                    "q": block["q"].to_numpy()[row], "distance": length[row, at], "key": keys[chosen], "payload": payload[chosen]
                }))
        if not found:  # a unit without hits has no types of its own
            return pd.DataFrame({"q": [], "distance": [], "key": [], "payload": []}).astype(object)
        return pd.concat(found, ignore_index=True)

    return run


@dataclass
class NeighbourIndex:
    """Points in cells, kept under ``path``: ``cells`` (by folder), ``pivots`` and ``lowest``."""

    spark: SparkSession
    path: str
    k: int  # keys kept of one vector: the largest number of neighbours that can be asked for
    pivots: _Pivots | None
    n_points: np.ndarray
    radius: np.ndarray

    @classmethod
    def build(cls, points: DataFrame, k: int, path: str | None = None, pivots: int | None = None) -> NeighbourIndex:
        """Index ``points`` (``key``, ``payload`` string, ``vec`` of length 1 or 0) under ``path``, by default a staged folder."""
        spark = points.sparkSession
        path = path or new_stage_path(spark, "neighbour-index")
        lowest = Window.partitionBy("vec").orderBy("key")
        points = points.select("key", "payload", "vec").withColumn("_rn", F.row_number().over(lowest))
        points = stage(points.where(F.col("_rn") <= k).drop("_rn"), "points")
        zero = F.forall("vec", lambda x: x == 0)
        distinct = points.where(~zero).select("vec").distinct()
        if pivots is None:
            pivots = max(1, math.isqrt(distinct.count()))  # as many cells as points in a cell
        drawn = distinct.orderBy(F.xxhash64("vec"), "vec").limit(pivots).collect()
        # a zero vector is at distance 1 from everything: its neighbours are the lowest keys of all
        points.orderBy("key").limit(k).write.mode("overwrite").parquet(f"{path}/lowest")
        points.where(zero).write.mode("overwrite").parquet(f"{path}/zero")
        held = _Pivots.of(np.array([row["vec"] for row in drawn])) if drawn else None
        per_folder = max(1, -(-len(drawn) // FOLDERS))
        if held is not None:
            cells = _assign(points.where(~zero), held).withColumn("folder", (F.col("cell") / per_folder).cast("int"))
            # a folder's rows may be many: they are dealt out over its cells and sorted for the scan to skip the others
            cells.repartition("folder", "cell").sortWithinPartitions("folder", "cell").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/cells")
            found = spark.read.parquet(f"{path}/cells").groupBy("cell").agg(F.max("reach").alias("r"), F.count("*").alias("n"))
            sizes = {row["cell"]: (row["n"], row["r"]) for row in found.collect()}
        rows = [(i, [float(x) for x in row["vec"]], *map(float, sizes.get(i, (0, -1.0)))) for i, row in enumerate(drawn)]
        spark.createDataFrame(rows, "cell int, vec array<double>, n double, radius double").write.mode("overwrite").parquet(f"{path}/pivots")
        spark.createDataFrame([(k, per_folder)], "k int, per_folder int").write.mode("overwrite").parquet(f"{path}/settings")
        return cls.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NeighbourIndex:
        rows = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()
        held = _Pivots.of(np.array([row["vec"] for row in rows])) if rows else None
        k = spark.read.parquet(f"{path}/settings").first()["k"]
        return cls(spark, path, k, held, np.array([int(r["n"]) for r in rows], int), np.array([r["radius"] for r in rows]))

    def copy_to(self, path: str) -> None:
        """Copy the index's tables to another folder, as they are."""
        for table in ("pivots", "lowest", "zero", "settings"):
            self.spark.read.parquet(f"{self.path}/{table}").write.mode("overwrite").parquet(f"{path}/{table}")
        if self.pivots is not None:
            cells = self.spark.read.parquet(f"{self.path}/cells").repartition("folder", "cell")
            cells.sortWithinPartitions("folder", "cell").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/cells")

    def _cells(self, asked: np.ndarray) -> DataFrame:
        """Points of the folders that hold a cell some query wants."""
        per_folder = self.spark.read.parquet(f"{self.path}/settings").first()["per_folder"]
        folders = sorted({int(cell) // per_folder for cell in np.flatnonzero(asked)})
        points = self.spark.read.parquet(f"{self.path}/cells").where(F.col("folder").isin(folders))
        return points.drop("folder", "reach")

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """One row per distinct query ``vec`` with ``neighbours``, (distance, key, payload) by distance, then key."""
        if k > self.k:
            raise ValueError(f"the index was built for {self.k} neighbours at most")
        asked = stage(queries.select("vec").distinct(), "asked")
        zero = F.forall("vec", lambda x: x == 0)
        lowest = self.spark.read.parquet(f"{self.path}/lowest").orderBy("key").limit(k)
        lowest_keys = lowest.select(F.lit(1.0).alias("distance"), "key", "payload")
        of_zero = lowest_keys.agg(F.array_sort(F.collect_list(F.struct("distance", "key", "payload")))).scalar()
        if self.pivots is None:
            # only zero points exist, and every query is at distance 1 from them
            return asked.withColumn("neighbours", of_zero)
        found = asked.where(zero).withColumn("neighbours", of_zero)
        centres = self.pivots.centres
        # a query's number is used only after it was written
        numbered = _assign(asked.where(~zero), self.pivots).drop("reach").withColumn("q", F.monotonically_increasing_id())
        numbered = stage(numbered.withColumn("limit", F.lit(FARTHEST)), "at-home")
        own = _with_wanted(numbered, centres, np.full(len(centres), -1.0))  # without radius no other cell is wanted
        first = _best(self._search(stage(own, "own-cells"), k), k, "q")
        if len(centres) > 1:
            kth = F.try_element_at("neighbours", F.lit(k))["distance"] + EDGE
            limit = F.least(F.coalesce(kth, F.lit(FARTHEST)), F.lit(FARTHEST))
            searched = numbered.drop("limit").join(first, "q", "left").withColumn("limit", limit).drop("neighbours")
            wanted = stage(_with_wanted(searched, centres, self.radius), "wanted-cells")
            first = _best(self._search(wanted, k), k, "q")
        return numbered.select("vec", "q").join(first, "q").select("vec", "neighbours").unionByName(found)

    def _groups(self) -> np.ndarray:
        """Each cell's group: cells whose pivots have one head follow one another, about ``POINT_UNIT`` points together."""
        order = np.argsort(self.pivots.group, kind="stable")
        before = np.cumsum(self.n_points[order]) - self.n_points[order]
        group = np.empty(len(order), int)
        group[order] = np.unique(before // POINT_UNIT, return_inverse=True)[1]
        return group

    def _search(self, asked: DataFrame, k: int) -> DataFrame:
        """Best ``k`` hits (q, hit) of each query among the points of its ``wanted`` cells, up to its ``limit``.

        Both sides are dealt into parts of bounded size; every (query part, point part) pair of a group is one unit.
        The zero vector, which no cell holds, is at distance 1 from every query.
        """
        n_cells, group_of = len(self.n_points), self._groups()
        grouped = stage(_asked(asked, group_of), "asked-groups")
        n_groups = int(group_of.max()) + 1
        n_queries, n_points = np.zeros(n_groups, int), np.bincount(group_of, self.n_points, n_groups).astype(int)
        for row in grouped.select(F.explode("groups").alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect():
            n_queries[row["g"]] = row["n"]
        group = F.col("group")
        query_parts = _per_cell(np.maximum(1, -(-n_queries // QUERY_UNIT)), group)
        point_parts = _per_cell(np.maximum(1, -(-n_points // POINT_UNIT)), group)

        def part(column: str, parts: Column) -> Column:
            return F.pmod(F.xxhash64(column), parts).cast("int")

        def every(parts: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), parts - 1))

        sent = grouped.select("q", "vec", "limit", "cell", "wanted", F.explode("groups").alias("group"))
        left = sent.withColumn("query_part", part("q", query_parts)).withColumn("point_part", every(point_parts))
        points = self._cells(_cells_of(asked, n_cells)).withColumn("group", _per_cell(group_of, F.col("cell")))
        points = points.where(_per_cell(n_queries, group) > 0)  # a group nobody asks for is not sent anywhere
        right = points.withColumn("point_part", part("key", point_parts)).withColumn("query_part", every(query_parts))
        unit, key = ["group", "query_part", "point_part"], dict(points.dtypes)["key"]
        schema = f"q long, distance double, key {key}, payload string"
        met = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(_nearest_in_group(k, n_cells), schema)
        zeros = self.spark.read.parquet(f"{self.path}/zero").select(F.lit(1.0).alias("distance"), "key", "payload")
        of_zero = asked.where("limit >= 1").select("q").join(F.broadcast(zeros))
        return met.unionByName(of_zero).select("q", F.struct("distance", "key", "payload").alias("hit"))


def nearest_vectors(queries: DataFrame, points: DataFrame, k: int, pivots: int | None = None) -> DataFrame:
    """Neighbours of every distinct query vector, from an index of ``points`` made for this call.

    ``queries``: ``vec``; ``points``: ``key``, ``payload`` (string), ``vec``; vectors of length 1 or 0.
    """
    return NeighbourIndex.build(points, k, pivots=pivots).nearest(queries, k)


def knn_join(
    queries: DataFrame, points: DataFrame, query_key: str, point_key: str, vector: str, k: int
) -> DataFrame:
    """The ``k`` points nearest to each query: (query key, rank, neighbour, distance)."""
    asked = queries.select(query_key, unit_vector(F.col(vector)).alias("vec"))
    known = points.select(
        F.col(point_key).alias("key"),
        F.lit(None).cast("string").alias("payload"),
        unit_vector(F.col(vector)).alias("vec"),
    )
    found = skew_join(asked, nearest_vectors(asked, known, k), "vec", F.col(query_key))
    return found.select(query_key, F.posexplode("neighbours").alias("pos", "hit")).select(
        query_key,
        (F.col("pos") + 1).alias("rank"),
        F.col("hit.key").alias("neighbour"),
        F.col("hit.distance").alias("distance"),
    )
