"""Hard-negative mining with rotated one-bit codes, deterministic score intervals and integer scores.

A row's vector y = floor(scale * x) has a code of several levels.  Level 1 rotates the unit vector y/|y| by a fixed
random rotation and stores its signs and their alignment (the inner product of the vector with its code vector); what the
code vector leaves over is rotated anew and coded by level 2, and so on.  An anchor is rotated once per level and cut
into bit planes, so that its inner product with a code vector is a sum of popcounts; the estimate of the score is their
sum weighted by the stored alignments.  By Cauchy-Schwarz it is off by at most the stored length of the last rest plus
what the bit planes have lost, which gives an interval that holds the score for certain.  Pairs whose interval can matter
are scored in integers in the task that has the row at hand: no pair is ever shuffled, and a task returns its best few
per anchor.

Anchors are answered in blocks of about ``block``: one block's vectors go to the tasks of two scans of all rows, the first
for positives, the second for negatives, and its answers are written before the next block begins.  Each scan starts from
floors, the exact k-th best scores among a sample of about ``SEEDS`` rows; they only save work, as a floor is never above
the result.

Rows without an id, without a label or with a vector that is null, empty, of another dimension than the table's (largest)
one or not finite take no part.  Integers are held at +-2^28, so scores fit in 64 bits.  Repeated rows count each, as
anchors too; rows with the anchor's own id are not others.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.vectors import best_of, dimension, matrix, usable
from claimlens.session import new_stage_path, stage

LEVELS = 4  # one-bit codes per row
PLANES = 6  # bits per entry of a rotated anchor
BLOCK = 4096  # anchors answered together, about
SEEDS = 8192  # rows of the sample that gives floors, about
PAIRS = 1 << 21  # (row, anchor) estimates held at once
SCORED = 1 << 16  # pairs scored at once
LARGEST = float(1 << 28)
SLACK = 1e-9  # rounding of an estimate, as a share of the largest score
LEAST = np.iinfo(np.int64).min


def rotations(d: int, levels: int = LEVELS, seed: int = 11) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(levels)]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, filled up with zeros."""
    words = -(-bits.shape[1] // 64)
    out = np.zeros((len(bits), words * 8), np.uint8)
    raw = np.packbits(bits, axis=1, bitorder="little")
    out[:, : raw.shape[1]] = raw
    return out.view("<u8")


def encode(y: np.ndarray, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, word), weights (row, level), length of the last rest as a share of |y|, and |y|."""
    length = np.sqrt(np.square(y.astype(float)).sum(axis=1))
    rest = y / np.where(length > 0, length, 1.0)[:, None]
    codes, weights = [], []
    for turn in turns:
        turned = rest @ turn.T
        bits = turned >= 0
        align = np.abs(turned).sum(axis=1) / np.sqrt(y.shape[1])
        code = np.where(bits, 1.0, -1.0) / np.sqrt(y.shape[1])
        rest = rest - align[:, None] * (code @ turn)
        codes.append(_packed(bits))
        weights.append(align)
    return np.stack(codes, axis=1), np.stack(weights, axis=1), np.sqrt(np.square(rest).sum(axis=1)), length


@dataclass(frozen=True)
class Anchors:
    """A block of anchors, with their rotated vectors as bit planes."""

    keys: np.ndarray
    labels: np.ndarray
    y: np.ndarray
    length: np.ndarray
    planes: np.ndarray  # (level, plane, anchor, word)
    low: np.ndarray  # (level, anchor): value of plane sum 0
    step: np.ndarray
    total: np.ndarray  # sum of the quantised entries
    lost: np.ndarray  # length of what the planes leave out

    @classmethod
    def of(cls, keys: np.ndarray, labels: np.ndarray, y: np.ndarray, turns: list[np.ndarray]) -> Anchors:
        length = np.sqrt(np.square(y.astype(float)).sum(axis=1))
        unit = y / np.where(length > 0, length, 1.0)[:, None]
        planes, low, step, total, lost = [], [], [], [], []
        for turn in turns:
            turned = unit @ turn.T
            least = turned.min(axis=1)
            width = np.maximum((turned.max(axis=1) - least) / ((1 << PLANES) - 1), 1e-300)
            level = np.clip(np.rint((turned - least[:, None]) / width[:, None]), 0, (1 << PLANES) - 1).astype(np.int64)
            back = least[:, None] + width[:, None] * level
            planes.append([_packed((level >> p) & 1) for p in range(PLANES)])
            low.append(least)
            step.append(width)
            total.append(back.sum(axis=1))
            lost.append(np.sqrt(np.square(turned - back).sum(axis=1)))
        return cls(keys, labels, y, length, np.array(planes), *(np.array(v) for v in (low, step, total, lost)))

    def intervals(self, codes: np.ndarray, weights: np.ndarray, rest: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of every (row, anchor)."""
        root = np.sqrt(self.y.shape[1])
        estimate = np.zeros((len(codes), len(self.y)))
        off = np.repeat(rest[:, None], len(self.y), axis=1)
        for i in range(codes.shape[1]):
            ones = sum(np.bitwise_count(codes[:, i, word]).astype(np.int32) for word in range(codes.shape[2]))
            hits = np.zeros(estimate.shape, np.int32)
            for p in range(PLANES):
                for word in range(codes.shape[2]):
                    both = np.bitwise_count(codes[:, i, word][:, None] & self.planes[i, p][:, word])
                    hits += both.astype(np.int32) << p
            product = (2.0 * (ones[:, None] * self.low[i] + hits * self.step[i]) - self.total[i]) / root
            estimate += weights[:, i, None] * product
            off += weights[:, i, None] * self.lost[i]
        scale = length[:, None] * self.length
        off = (off + SLACK) * scale
        estimate *= scale
        return estimate - off, estimate + off


def _scores(y: np.ndarray, anchors: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products of the chosen pairs."""
    out = np.empty(len(row), np.int64)
    for start in range(0, len(row), SCORED):
        part = slice(start, start + SCORED)
        out[part] = np.einsum("ij,ij->i", y[row[part]], anchors[anchor[part]])
    return out


class _Best:
    """The ``k`` best hits per group so far, and the score a new hit must reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors.copy(), k
        self.group, self.score, self.key = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        high = score >= self.floors[group]
        group, score = np.concatenate([self.group, group[high]]), np.concatenate([self.score, score[high]])
        key = np.concatenate([self.key, key[high]])
        kept = best_of(group, score, key, self.k)
        self.group, self.score, self.key = group[kept], score[kept], key[kept]
        full, n = np.unique(self.group, return_counts=True)
        last = np.cumsum(n) - 1
        full, last = full[n == self.k], last[n == self.k]
        self.floors[full] = np.maximum(self.floors[full], self.score[last])


def _index(rows: DataFrame, d: int, scale: int) -> DataFrame:
    """Staged rows with ``y``, codes, weights, rest and length."""
    turns = rotations(d)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.clip(np.floor(scale * matrix(batch.column("vec"), d)), -LARGEST, LARGEST).astype(np.int32)
            codes, weights, rest, length = encode(y, turns)
            columns = [batch.column(c) for c in ("key", "label", "is_anchor")]
            columns += [_binary(y), _binary(codes), _binary(weights), pa.array(rest), pa.array(length)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "is_anchor", "y", "codes", "weights", "rest", "length"])

    schema = f"key {kinds['key']}, label {kinds['label']}, is_anchor boolean, y binary, codes binary, weights binary, rest double, length double"
    return stage(rows.where(F.size("vec") == d).mapInArrow(run, schema), "negative-codes")


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    flat = np.ascontiguousarray(rows).reshape(len(rows), -1)
    width = flat.itemsize * flat.shape[1]
    offsets = pa.py_buffer(np.arange(len(flat) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, offsets, pa.py_buffer(flat.tobytes())])


def _numbers(column: pa.Array, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _scan(index: DataFrame, d: int, anchors: Anchors, found: Callable, floors: np.ndarray, k: int, out: Callable, schema: str) -> DataFrame:
    """Best ``k`` hits per group in each task.

    ``found(same, low, high, floors)`` marks the pairs to score; it gets the labels' equality and the intervals.
    ``out`` is the pair (groups of scored pairs, columns of the result).
    """
    grouped, columns = out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(floors, k)
        height = max(1, PAIRS // max(1, len(anchors.keys)))
        whole = anchors.y.astype(np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, height):
                part = batch.slice(start, height)
                key = part.column("key").to_numpy(zero_copy_only=False)
                label = part.column("label").to_numpy(zero_copy_only=False)
                codes = _numbers(part.column("codes"), "<u8", (LEVELS, -(-d // 64)))
                weights = _numbers(part.column("weights"), "<f8", (LEVELS,))
                rest, length = part.column("rest").to_numpy(), part.column("length").to_numpy()
                low, high = anchors.intervals(codes, weights, rest, length)
                same = label[:, None] == anchors.labels
                row, anchor = np.nonzero(found(same, low, high, best.floors) & (key[:, None] != anchors.keys))
                y = _numbers(part.column("y"), "<i4", (d,)).astype(np.int64)
                score = _scores(y, whole, row, anchor)
                for group, chosen in grouped(anchor, score):
                    best.add(group, score[chosen], key[row[chosen]])
        if len(best.group):
            yield columns(best)

    return index.mapInArrow(run, schema)


def _merged(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp").orderBy(F.desc("score"), "key")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    embeddings: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block: int = BLOCK,
) -> DataFrame:
    """For each anchor and each of its best same-label rows, the best rows of other labels within a share of that score.

    A negative counts if low * positive_score <= 100 * negative_score <= high * positive_score.  Returns ``anchor_id``,
    ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score`` and ``negative_score``.
    """
    spark = embeddings.sparkSession
    named = F.col(label) if isinstance(label, str) else label
    rows = usable(embeddings, key, vector, label=named, is_anchor=F.coalesce(anchors, F.lit(False))).where("label IS NOT NULL")
    kind = dict(rows.dtypes)["key"]
    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    d = dimension(rows)
    if not d:
        return spark.createDataFrame([], schema)
    index, turns = _index(rows, d, scale), rotations(d)
    n_rows, n_anchors = index.agg(F.count("*"), F.count_if("is_anchor")).first()
    blocks, share = max(1, -(-n_anchors // block)), max(1, n_rows // SEEDS)
    dealt = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    asked_path, path = new_stage_path(spark, "negative-anchors"), new_stage_path(spark, "negatives")
    asked = index.where("is_anchor").select("key", "label", "y", dealt.alias("block"))
    asked.write.partitionBy("block").parquet(asked_path)
    asked = spark.read.schema(f"key {kind}, label {dict(rows.dtypes)['label']}, y binary, block int").parquet(asked_path)
    seeds = stage(index.where(F.pmod(F.xxhash64("key", "y"), F.lit(share)) == 0), "negative-seeds")
    written = 0
    for number in range(blocks):
        local = asked.where(F.col("block") == number).toPandas()
        if local.empty:
            continue
        y = np.frombuffer(b"".join(local["y"]), "<i4").reshape(len(local), d)
        one = Anchors.of(local["key"].to_numpy(), local["label"].to_numpy(), y, turns)
        answers = _answers(index, seeds, d, one, kind, n_positives, n_negatives, low, high, schema)
        if answers is not None:
            answers.write.mode("append").parquet(path)
            written += 1
    return spark.read.schema(schema).parquet(path) if written else spark.createDataFrame([], schema)


def _answers(index, seeds, d, one: Anchors, kind, n_positives, n_negatives, low, high, schema) -> DataFrame | None:
    """Negatives of one block of anchors; None where no anchor has a positive."""
    m = len(one.keys)

    def positives(rows: DataFrame, floors: np.ndarray) -> list:
        def found(same, lowest, highest, floors):
            return same & (highest >= floors)

        def grouped(anchor, score):
            yield anchor, np.arange(len(anchor))

        def columns(best):
            return pa.RecordBatch.from_arrays([pa.array(best.group), pa.array(best.score), pa.array(best.key)], ["grp", "score", "key"])

        hits = _scan(rows, d, one, found, floors, n_positives, (grouped, columns), f"grp long, score long, key {kind}")
        return _merged(hits, n_positives).select("grp", "rank", "score", "key").collect()

    floors = np.full(m, LEAST)
    for row in positives(seeds, floors):
        if row["rank"] == n_positives:
            floors[row["grp"]] = row["score"]
    score, other = np.full((m, n_positives), LEAST), np.empty((m, n_positives), object)
    for row in positives(index, floors):
        score[row["grp"], row["rank"] - 1], other[row["grp"], row["rank"] - 1] = row["score"], row["key"]
    there = score >= 0  # no score lies between 30 and 90 per cent of a negative one
    if not there.any():
        return None
    # whole scores within the window of each (anchor, positive); an empty window where there is none
    least = np.where(there, -(-low * np.where(there, score, 0) // 100), 1)
    most = np.where(there, high * np.where(there, score, 0) // 100, 0)
    names = np.array([x for x in other.ravel()], object)

    def negatives(rows: DataFrame, floors: np.ndarray) -> DataFrame:
        def found(same, lowest, highest, floors):
            needed = np.maximum(floors.reshape(m, n_positives), least)
            needed = np.where(needed <= most, needed, np.iinfo(np.int64).max).min(axis=1)
            return ~same & (highest >= needed) & (lowest <= most.max(axis=1))

        def grouped(anchor, score):
            for p in range(n_positives):
                chosen = np.flatnonzero((score >= least[anchor, p]) & (score <= most[anchor, p]))
                yield anchor[chosen] * n_positives + p, chosen

        def columns(best):
            ps, anchor = score.ravel()[best.group], one.keys[best.group // n_positives]
            made = [best.group, anchor, names[best.group], best.key, ps, best.score]
            return pa.RecordBatch.from_arrays(
                [pa.array(made[0]), pa.array(made[1]), pa.array(made[2].tolist(), pa.array(made[1]).type), *map(pa.array, made[3:])],
                ["grp", "anchor_id", "positive_id", "key", "positive_score", "score"],
            )

        made = f"grp long, anchor_id {kind}, positive_id {kind}, key {kind}, positive_score long, score long"
        return _merged(_scan(rows, d, one, found, floors, n_negatives, (grouped, columns), made), n_negatives)

    floors = np.full(m * n_positives, LEAST)
    for row in negatives(seeds, floors).where(F.col("rank") == n_negatives).select("grp", "score").collect():
        floors[row["grp"]] = row["score"]
    return negatives(index, floors).select(
        "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
