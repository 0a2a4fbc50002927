"""Random forests on a binned matrix: all trees of all models grow by one level in one job.

The matrix is the one of ``boosting``, staged in blocks of up to ``SCAN_ROWS`` rows.  A task goes through its blocks tree by
tree, takes each drawn row down to the node it lies in and counts the rows of both classes by (node, column tried, bin).
Counts are whole numbers, so their order does not matter; they are exchanged by tree, and the best split of every node is
found where a tree's counts meet.  The driver sees the splits only.

A tree draws each row a Poisson(1) number of times, from a generator of (seed, tree, block), so that a row's number needs
no memory and is the same in every level and every model.  Nodes try the root of the number of columns.  A single tree
takes all rows once and all columns.  Splits lower the Gini impurity of the class weights; of equal ones the first column
and the lowest bin win.  A leaf holds the share of class 1, the forest's probability is the mean over its trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, factorial, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.boosting import LEAF, SCAN_ROWS, Binned, _bins
from claimlens.operators.transforms import StateModel
from claimlens.session import stage

MAX_BINS = 32
STAY = 255  # a cut above every bin: rows of a leaf go on to the left
# of 65,536 equally likely numbers, how often a row is drawn
_DRAWS = np.searchsorted(np.cumsum([np.exp(-1.0) / factorial(k) for k in range(8)]), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


@dataclass(frozen=True)
class Bagging:
    """Rules of one forest; classes are balanced over the rows it sees."""

    trees: int = 200
    max_depth: int = 10
    seed: int = 42
    left_out: tuple[str, int] | None = None  # (column, value) of the rows a model must not see


class _Growing:
    """A tree as a heap (the children of node i are 2i + 1 and 2i + 2) with the nodes still to be split."""

    def __init__(self, max_depth: int):
        size = 2 ** (max_depth + 1) - 1
        self.feature, self.cut = np.full(size, LEAF, np.int16), np.full(size, STAY, np.uint8)
        self.gain, self.share = np.zeros(size), np.zeros(size)
        self.open = np.array([0])

    def split(self, found: np.ndarray, weights: tuple[float, float], last: bool) -> None:
        """Apply the splits of the open nodes: (column, cut, gain, counts left and right of both classes)."""
        if self.open[0] == 0:
            self.share[0] = _share(found[:1, 3:5] + found[:1, 5:7], weights)[0]
        made = found[:, 0] != LEAF
        nodes, found = self.open[made], found[made]
        self.feature[nodes], self.cut[nodes], self.gain[nodes] = found[:, 0], found[:, 1], found[:, 2]
        mixed = []
        for child, counts in ((2 * nodes + 1, found[:, 3:5]), (2 * nodes + 2, found[:, 5:7])):
            self.share[child] = _share(counts, weights)
            mixed.append(child[(counts > 0).all(axis=1)])
        self.open = np.empty(0, int) if last else np.sort(np.concatenate(mixed))


def _share(counts: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    weighted = counts * np.array(weights)
    return weighted[:, 1] / np.maximum(weighted.sum(axis=1), 1e-300)


def _descend(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, first: np.ndarray, depth: int) -> np.ndarray:
    """Heap number at ``depth`` of the rows that begin at ``first`` of the flat ``bins``; a leaf's rows go on to the left."""
    node = np.zeros(len(first), np.int64)
    feature = np.maximum(feature, 0).astype(np.int64)
    for _ in range(depth):
        goes = bins.take(first + feature.take(node)) > cut.take(node)
        node = 2 * node + 1 + goes
    return node


def _tried(rules: Bagging, tree: int, level: int, nodes: int, columns: int) -> np.ndarray:
    """Columns tried at each open node of a level, (node, column), in column order."""
    if rules.trees == 1:
        return np.tile(np.arange(columns), (nodes, 1))
    order = np.random.default_rng([rules.seed, 1, tree, level]).random((nodes, columns)).argsort(axis=1)
    return np.sort(order[:, : ceil(sqrt(columns))], axis=1)


def _places(tried: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, int]:
    """Where the counts of each (node, column tried) begin, and their number: two classes per bin."""
    sizes = 2 * widths[tried].ravel()
    ends = np.cumsum(sizes)
    return (ends - sizes).reshape(tried.shape), int(ends[-1])


def _drawn(rules: Bagging, tree: int, block: int, rows: int) -> np.ndarray:
    if rules.trees == 1:
        return np.ones(rows, np.uint8)
    return _DRAWS[np.random.default_rng([rules.seed, 0, tree, block]).integers(0, 65_536, rows, np.uint16)]


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest whole numbers that hold them, after one byte that names their width."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or counts.max(initial=0) < 256**w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _best(counts: np.ndarray, tried: np.ndarray, widths: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """Best split of each node: column (``LEAF`` if none gains), cut, gain, and counts (class 0, class 1) left and right."""
    places, _ = _places(tried, widths)
    width = int(widths.max())
    at = places[:, :, None] + 2 * np.arange(width)
    inside = np.arange(width) < widths[tried][:, :, None]
    sums = np.stack([np.where(inside, counts[np.minimum(at + c, len(counts) - 1)], 0) for c in (0, 1)], axis=-1)
    below = np.cumsum(sums, axis=2)
    whole = below[:, :, -1:, :]
    above = whole - below

    def impurity(part: np.ndarray) -> np.ndarray:  # twice the product of both weights over their sum: sum times Gini
        zero, one = part[..., 0] * weights[0], part[..., 1] * weights[1]
        return 2 * zero * one / np.maximum(zero + one, 1e-300)

    gain = impurity(whole) - impurity(below) - impurity(above)
    gain[(below.sum(axis=-1) == 0) | (above.sum(axis=-1) == 0)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    nodes, best = np.arange(len(flat)), flat.argmax(axis=1)
    column, cut = np.divmod(best, width)
    gains = flat[nodes, best]
    split = gains > 1e-12 * np.maximum((whole[:, 0, 0] * np.array(weights)).sum(axis=-1), 1e-300)
    left = np.where(split[:, None], below[nodes, column, cut], whole[:, 0, 0])
    right = np.where(split[:, None], above[nodes, column, cut], 0)
    return np.column_stack([np.where(split, tried[nodes, column], LEAF), cut, np.where(split, gains, 0.0), left, right]).astype(float)


def _large_blocks(binned: Binned) -> DataFrame:
    """Stored blocks of up to ``SCAN_ROWS`` rows, each with a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, rows = ["bins", "label", "held"], [], 0

        def joined():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(r[n] for r in held)], pa.binary()) for n in names], names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and rows + len(row["label"]) > SCAN_ROWS:
                    yield joined()
                    held, rows = [], 0
                held.append(row)
                rows += len(row["label"])
        if held:
            yield joined()

    made = binned.blocks.mapInArrow(run, "bins binary, label binary, held binary")
    return stage(made.withColumn("block", F.monotonically_increasing_id()), "forest-blocks")


def train(binned: Binned, rules: Sequence[Bagging]) -> list[Forest]:
    """All forests side by side; one job per level, as many as the deepest tree has."""
    if not binned.n_rows:
        raise ValueError("a forest needs rows to learn from")
    blocks, columns, held = _large_blocks(binned), len(binned.columns), binned.held
    widths = np.array([len(e) + 1 for e in binned.edges])
    weights = _class_weights(blocks, held, rules)
    models = [[_Growing(r.max_depth) for _ in range(r.trees)] for r in rules]
    for level in range(max(r.max_depth for r in rules)):
        active = {
            (m, t): (tree.feature[: 2**level - 1], tree.cut[: 2**level - 1], tree.open)
            for m, trees in enumerate(models) for t, tree in enumerate(trees) if len(tree.open)
        }
        if not active:
            break
        order = sorted(active, key=lambda key: (key[1], key[0]))  # models share a tree's draws

        def count(batches):  # runs before the next level begins
            matrix = []
            for batch in batches:
                for row in batch.to_pylist():
                    label = np.frombuffer(row["label"], np.uint8)
                    own = np.frombuffer(row["held"], np.int32).reshape(len(label), len(held))
                    matrix.append((row["block"], np.frombuffer(row["bins"], np.uint8), label, own))
            if not matrix:
                return
            last, draws = None, None
            for m, t in order:
                rule, (feature, cut, open_) = rules[m], active[m, t]
                tried = _tried(rule, t, level, len(open_), columns)
                places, size = _places(tried, widths)
                slot = np.full(2**level, -1, np.int32)
                slot[open_ - (2**level - 1)] = np.arange(len(open_))
                if last != (t, rule.seed, rule.trees == 1):
                    last = (t, rule.seed, rule.trees == 1)
                    draws = [_drawn(rule, t, number, len(label)) for number, _, label, _ in matrix]
                places, tried = np.ascontiguousarray(places.T), np.ascontiguousarray(tried.T)
                total = np.zeros(size)
                for drawn, (_, bins, label, own) in zip(draws, matrix, strict=True):
                    seen = drawn > 0
                    if rule.left_out is not None:
                        seen &= own[:, held.index(rule.left_out[0])] != rule.left_out[1]
                    rows = np.flatnonzero(seen)
                    at = slot[_descend(feature, cut, bins, rows * columns, level) - (2**level - 1)]
                    if level:
                        inside = at >= 0
                        rows, at = rows[inside], at[inside]
                    first, own_label, times = rows * columns, label[rows], drawn[rows].astype(float)
                    cells = places.take(at, axis=1)  # (column tried, row)
                    for j, cell in enumerate(cells):
                        cell += 2 * bins.take(first + tried[j].take(at)) + own_label
                    total += np.bincount(cells.ravel(), np.tile(times, len(cells)), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m], pa.int32()), pa.array([t], pa.int32()), pa.array([_packed(total)], pa.binary())], ["model", "tree", "counts"]
                )

        def choose(key, table):
            m, t = (k.as_py() for k in key)
            total = sum(_unpacked(packed) for packed in table.column("counts").to_pylist())
            tried = _tried(rules[m], t, level, len(active[m, t][2]), columns)
            found = _best(total, tried, widths, weights[m])
            schema = pa.schema([("model", pa.int32()), ("tree", pa.int32()), ("found", pa.binary())])
            return pa.table({"model": [m], "tree": [t], "found": [found.tobytes()]}, schema)

        counted = blocks.mapInArrow(count, "model int, tree int, counts binary")
        splits = counted.groupBy("model", "tree").applyInArrow(choose, "model int, tree int, found binary")
        for row in splits.collect():
            m, t = row["model"], row["tree"]
            models[m][t].split(np.frombuffer(row["found"]).reshape(-1, 7), weights[m], level + 1 == rules[m].max_depth)
    return [Forest(binned.columns, binned.edges, rule, trees) for rule, trees in zip(rules, models, strict=True)]


def _class_weights(blocks: DataFrame, held: Sequence[str], rules: Sequence[Bagging]) -> list[tuple[float, float]]:
    """Balanced weights of both classes over the rows of each model."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                label = np.frombuffer(row["label"], np.uint8)
                own = np.frombuffer(row["held"], np.int32).reshape(len(label), len(held))
                for m, rule in enumerate(rules):
                    mine = label if rule.left_out is None else label[own[:, held.index(rule.left_out[0])] != rule.left_out[1]]
                    n = np.bincount(mine, minlength=2)
                    yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in (m, n[0], n[1])], ["model", "zero", "one"])

    counted = blocks.mapInArrow(run, "model long, zero long, one long").groupBy("model").agg(F.sum("zero"), F.sum("one")).collect()
    found = {row[0]: (row[1], row[2]) for row in counted}
    return [tuple((zero + one) / (2.0 * max(n, 1)) for n in (zero, one)) for zero, one in (found[m] for m in range(len(rules)))]


@dataclass
class Forest:
    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    rules: Bagging
    trees: list[_Growing]

    def model(self) -> ForestModel:
        """Scoring model: of each tree the heap numbers of its nodes with their splits and shares."""
        plain, importance = [], np.zeros(len(self.columns))
        for tree in self.trees:
            inner = np.flatnonzero(tree.feature != LEAF)
            nodes = np.unique(np.concatenate([[0], 2 * inner + 1, 2 * inner + 2]))
            plain.append([a.tolist() for a in (nodes, tree.feature[nodes], tree.cut[nodes], tree.share[nodes])])
            own = np.bincount(tree.feature[inner], tree.gain[inner], len(self.columns))
            importance += own / (own.sum() or 1.0)
        return ForestModel(
            {"columns": list(self.columns), "edges": [list(e) for e in self.edges], "depth": self.rules.max_depth, "trees": plain,
             "importance": (importance / (importance.sum() or 1.0)).tolist()}
        )


class ForestModel(StateModel):
    """Mean share of class 1 over the trees; adds ``probability`` (of both classes) as Spark's classifiers do."""

    @property
    def featureImportances(self) -> list[float]:  # noqa: N802  named as Spark's tree models name it
        return self.fitted["importance"]

    def _transform(self, df: DataFrame) -> DataFrame:
        state = self.fitted
        edges, depth = [np.array(e) for e in state["edges"]], state["depth"]
        trees = []
        for nodes, features, cuts, shares in state["trees"]:
            size = 2 ** (depth + 1) - 1
            feature, cut, share = np.full(size, LEAF, np.int16), np.full(size, STAY, np.uint8), np.zeros(size)
            feature[nodes], cut[nodes], share[nodes] = features, cuts, shares
            for node in np.flatnonzero(feature[: size // 2] == LEAF):  # in rising order: a leaf's share goes down to the left
                share[2 * node + 1] = share[node]
            trees.append((feature, cut, share))

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            matrix = _bins([c.to_numpy(float) for c in columns], edges)
            first, bins, total = np.arange(len(matrix)) * matrix.shape[1], matrix.ravel(), np.zeros(len(matrix))
            for feature, cut, share in trees:
                total += share[_descend(feature, cut, bins, first, depth)]
            return pd.Series(total / max(len(trees), 1))

        p = probability(*[F.col(c).cast("double") for c in state["columns"]])
        scored = df.withColumn("_p", p)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")
