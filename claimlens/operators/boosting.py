"""Second-order gradient boosting on a binned matrix, depth-wise or best-first, several models in one scan.

The matrix is binned once and staged in blocks; a model is a set of growth rules and the rows it leaves out, so that the
folds of a cross-validation and the families trained on the same rows share the matrix and every scan of it.  One scan
sums, for each model, the gradients, hessians and rows of the tree nodes it asks for by (node, feature, bin); sums meet
in a tree reduction, so the driver gets a few arrays whatever the number of tasks.  Only the smaller child of a split is
summed, its sibling is the parent less it.

Trees grow on the driver from these sums alone.  ``policy`` depth splits level by level; loss always splits the leaf of
the largest gain, up to ``max_leaves``.  To keep strict best-first order without a scan per leaf, growth is played
through with what is known, and a scan asks for the children of all nodes that would be split: as many scans as the tree
is deep, and a few more.  The gain of a split is GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2) and must exceed ``gamma``; of
equal gains the first feature and the lowest bin win.  A leaf's weight is -G/(H+l2).  With ``loss`` squares, trees are
fitted to the negative gradients of log(1 + exp(-2yF)), y being 1 or -1, by least squares, as Spark's boosted trees are: H is
the weight of the rows, a leaf their mean, and the first tree counts fully.

Several columns' bins are packed into one word, as many as ``GROUP_BITS`` hold; rows are summed by words, and the sums of
a column's bins are taken from those of its words.

Up to ``LOCAL_ROWS`` rows a scan costs more to start than to make.  There every model grows in one task, which gets the
packed rows the model may see: one job trains all models, side by side.  A larger matrix stays dealt out, and a scan goes
down from a tree's root only towards the nodes it asks for.

The sums use an RDD: a DataFrame aggregate would make one row per cell of every task's arrays.  Finished trees
are added to the cached margins, which are written to the shared folder every ``FLUSH`` times; that cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from claimlens.operators.transforms import StateModel
from claimlens.session import stage

MAX_BINS = 64
BLOCK_ROWS = 4096  # at most, in a stored block
SCAN_ROWS = 65_536  # at most, in a larger one
CACHED_ROWS = 524_288  # at most, in a cached one
LOCAL_ROWS = 4_000_000  # of a matrix that one task may hold, at about 60 bytes a row
GROUP_BITS = 12  # at most, of the columns counted together
CHUNK = 16_384  # rows counted at once: their words and gradients stay in the processor's cache
FEW = 2048  # rows of a node that are cheaper counted column by column
FLUSH = 32  # additions of trees after which margins are written
DIRECT = 64  # partitions whose sums go straight to the driver; more are reduced in two steps
LEAF = -1
HELD = ("is_test", "fold")  # columns a model may leave rows out by


@dataclass(frozen=True)
class Growth:
    """Rules of one booster; ``positive_weight`` None balances the classes, 1.0 leaves them as they are."""

    rounds: int = 300
    step: float = 0.05
    policy: str = "depth"
    max_depth: int | None = 6
    max_leaves: int | None = None
    l2: float = 1.0
    gamma: float = 0.0
    min_hessian: float = 1.0
    min_rows: int = 1
    positive_weight: float | None = 1.0
    left_out: tuple[str, int] | None = None  # (column, value) of the rows a model must not see
    loss: str = "newton"
    bins: int = MAX_BINS  # of a column, at most

    def steps(self) -> Iterator[float]:
        """What each tree is multiplied by; the first of squares is fitted to twice the labels."""
        yield 0.5 if self.loss == "squares" else self.step
        while True:
            yield self.step

    @property
    def slope(self) -> float:
        """Log odds per unit of the margin."""
        return 2.0 if self.loss == "squares" else 1.0


@dataclass
class Tree:
    """Nodes as parallel lists; a node without a feature is a leaf.  Rows with bin <= cut go left."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    order: list[int] = field(default_factory=lambda: [0])  # number of the split, from 1
    sums: list[tuple[float, float, float]] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def add(self, depth: int, sums: tuple[float, float, float], l2: float) -> int:
        for values, value in (
            (self.feature, LEAF), (self.cut, 0), (self.left, 0), (self.right, 0), (self.depth, depth), (self.gain, 0.0),
            (self.order, 0), (self.sums, sums), (self.weight, _weight(sums, l2)),
        ):
            values.append(value)
        return len(self.feature) - 1

    def arrays(self, scale: float = 1.0) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v, np.int32) for v in (self.feature, self.cut, self.left, self.right)) + (scale * np.array(self.weight),)


def _weight(sums: tuple[float, float, float], l2: float) -> float:
    gradient, hessian, _ = sums
    return -gradient / (hessian + l2) if hessian + l2 > 0 else 0.0


def _rows_at(
    arrays: tuple[np.ndarray, ...], bins: np.ndarray, rows: np.ndarray, needed: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """Every node without a split with those of ``rows`` of ``bins`` (column, row) that end in it; of ``needed`` nodes only."""
    feature, cut, left, right = arrays[:4]
    open_ = [(0, rows)]
    while open_:
        node, rows = open_.pop()
        if feature[node] == LEAF:
            yield node, rows
            continue
        goes = bins[feature[node]][rows] <= int(cut[node])
        for child, side in ((left[node], goes), (right[node], ~goes)):
            if needed is None or needed[child]:
                part = rows[side]
                if len(part):
                    open_.append((child, part))


def _on_the_way(arrays: tuple[np.ndarray, ...], nodes: Sequence[int]) -> np.ndarray:
    """Whether each node is one of ``nodes`` or above one; a child's number is larger than its parent's."""
    feature, _, left, right = arrays[:4]
    needed = np.zeros(len(feature), bool)
    needed[list(nodes)] = True
    for node in np.flatnonzero(feature != LEAF)[::-1]:
        needed[node] |= needed[left[node]] | needed[right[node]]
    return needed


def _add_tree(margin: np.ndarray, tree: tuple[np.ndarray, ...], bins: np.ndarray) -> None:
    for node, rows in _rows_at(tree, bins, np.arange(len(margin), dtype=np.int32)):
        margin[rows] += tree[4][node]


# A node's sums are wanted for the rows of ``node`` on one side of a split; feature LEAF asks for all of its rows.
Wanted = tuple[int, int, int, bool]


@dataclass(frozen=True)
class _Split:
    gain: float
    feature: int
    cut: int
    left: tuple[float, float, float]
    right: tuple[float, float, float]


def _best_splits(sums: np.ndarray, rules: Growth) -> list[_Split | None]:
    """Best split of each node from its sums (node, feature, bin, 3); None where no split gains."""
    below = np.cumsum(sums, axis=2)
    whole = below[:, :1, -1:, :]
    above = whole - below

    def score(part: np.ndarray) -> np.ndarray:
        return np.square(part[..., 0]) / np.maximum(part[..., 1] + rules.l2, 1e-300)

    gain = score(below) + score(above) - score(whole)
    for side in (below, above):
        gain[(side[..., 1] < rules.min_hessian) | (side[..., 2] < max(rules.min_rows, 1))] = -np.inf
    flat = gain.reshape(len(gain), -1)
    out: list[_Split | None] = []
    for node, at in enumerate(flat.argmax(axis=1)):
        feature, cut = divmod(int(at), gain.shape[2])
        if flat[node, at] <= max(rules.gamma, 1e-12):
            out.append(None)
            continue
        left, right = (tuple(map(float, side[node, feature, cut])) for side in (below, above))
        out.append(_Split(float(flat[node, at]), feature, cut, left, right))
    return out


class _Known:
    """What is known of a tree in growth: every node whose sums have been made, whether it will be split or not."""

    def __init__(self, root: np.ndarray, rules: Growth):
        self.rules = rules
        self.feature, self.cut, self.left, self.right, self.depth = [LEAF], [0], [0], [0], [0]
        self.sums, self.split = [root], _best_splits(root[None], rules)
        self.deepest = np.inf if rules.max_depth is None else rules.max_depth
        self.most = rules.max_leaves or np.inf

    def rank(self, node: int) -> tuple:
        return (-self.split[node].gain, node) if self.rules.policy == "loss" else (self.depth[node], node)

    def plan(self) -> tuple[list[int], list[int]]:
        """Nodes in the order of splitting as far as is known, and those of them whose children have no sums yet."""
        open_, order, missing = [], [], []
        if self.split[0] is not None and self.deepest > 0:
            open_.append((*self.rank(0), 0))
        while open_ and len(order) + 1 < self.most:
            node = heappop(open_)[-1]
            order.append(node)
            if self.depth[node] + 1 < self.deepest and len(order) + 1 < self.most:
                if self.feature[node] == LEAF:
                    missing.append(node)
                    continue
                for child in (self.left[node], self.right[node]):
                    if self.split[child] is not None:
                        heappush(open_, (*self.rank(child), child))
        return order, missing

    def wanted(self, missing: list[int]) -> list[Wanted]:
        """The smaller child of each node."""
        splits = [self.split[n] for n in missing]
        return [(n, s.feature, s.cut, s.left[2] <= s.right[2]) for n, s in zip(missing, splits, strict=True)]

    def learn(self, wanted: list[Wanted], found: np.ndarray) -> None:
        """Add both children of each node; the larger one is the parent less the smaller one."""
        pairs = []
        for (node, feature, cut, left), small in zip(wanted, found, strict=True):
            other = self.sums[node] - small
            self.feature[node], self.cut[node] = feature, cut
            self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
            for values, new in ((self.feature, LEAF), (self.cut, 0), (self.left, 0), (self.right, 0), (self.depth, self.depth[node] + 1)):
                values += [new, new]
            pairs += [small, other] if left else [other, small]
        self.sums += pairs
        self.split += _best_splits(np.stack(pairs), self.rules)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v, np.int32) for v in (self.feature, self.cut, self.left, self.right))

    def tree(self, order: list[int]) -> Tree:
        """The tree that splits the nodes of ``order``."""
        tree, place = Tree(), {0: 0}
        tree.sums[0] = tuple(map(float, self.sums[0][0].sum(axis=0)))
        tree.weight[0] = _weight(tree.sums[0], self.rules.l2)
        for number, node in enumerate(order):
            split, at = self.split[node], place[node]
            tree.feature[at], tree.cut[at], tree.gain[at], tree.order[at] = split.feature, split.cut, split.gain, number + 1
            made = [tree.add(tree.depth[at] + 1, part, self.rules.l2) for part in (split.left, split.right)]
            tree.left[at], tree.right[at] = made
            if self.feature[node] != LEAF:
                place[self.left[node]], place[self.right[node]] = made
        return tree


def grow(rules: Growth) -> Generator[tuple[tuple[np.ndarray, ...], list[Wanted]], np.ndarray, Tree]:
    """One tree: yields its known nodes and what it wants summed; is sent the sums, (wanted, feature, bin, 3), in that order."""
    known = _Known((yield Tree().arrays(), [(0, LEAF, 0, True)])[0], rules)
    while True:
        order, missing = known.plan()
        if not missing:
            return known.tree(order)
        wanted = known.wanted(missing)
        known.learn(wanted, (yield known.arrays(), wanted))


@dataclass(frozen=True)
class Binned:
    """Staged blocks (``bins``, ``label``, ``held``) of a matrix, and the upper edges of each column's bins."""

    blocks: DataFrame
    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    held: tuple[str, ...]
    n_rows: int


def bin_edges(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> tuple[tuple[float, ...], ...]:
    """Upper edges per column: every value where there are few, else sketched quantiles; two aggregates for all columns."""
    fractions = [i / max_bins for i in range(1, max_bins)]
    values = [F.col(c).cast("double") for c in columns]
    first = df.agg(
        *[F.approx_count_distinct(v, 0.02).alias(f"n{i}") for i, v in enumerate(values)],
        *[F.percentile_approx(v, fractions, 20 * max_bins).alias(f"q{i}") for i, v in enumerate(values)],
    ).first()
    few = [i for i in range(len(values)) if first[f"n{i}"] < 0.9 * max_bins]
    exact = df.agg(F.lit(0), *[F.collect_set(values[i]).alias(f"s{i}") for i in few]).first()
    edges = []
    for i in range(len(values)):
        found = sorted({v for v in (exact[f"s{i}"] if i in few else first[f"q{i}"] or []) if v == v})
        edges.append(tuple(found[:-1] if i in few else found))  # nothing lies above the largest value
    return tuple(edges)


def _bins(matrix: Sequence[np.ndarray], edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Number of each value's bin; null and NaN share the last one."""
    return np.column_stack([np.searchsorted(np.asarray(e), m, side="left") for m, e in zip(matrix, edges, strict=True)]).astype(np.uint8)


def bin_matrix(df: DataFrame, columns: Sequence[str], label: str, max_bins: int = MAX_BINS) -> Binned:
    """Bin ``columns`` of rows with a 0/1 ``label``; ``is_test`` and ``fold`` are kept where ``df`` has them."""
    held = tuple(c for c in HELD if c in df.columns)
    edges = bin_edges(df, columns, max_bins)
    names = [f"c{i}" for i in range(len(columns))]
    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)],
        F.col(label).cast("int").alias("label"),
        *[F.col(c).cast("int").alias(f"h_{c}") for c in held],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS).to_pandas()
                bins = _bins([part[n].to_numpy() for n in names], edges)
                out = [bins, part["label"].to_numpy(np.uint8), part[[f"h_{c}" for c in held]].to_numpy(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in out], ["bins", "label", "held"])

    made = rows.mapInArrow(run, "bins binary, label binary, held binary")
    # every scan ends with its longest task: blocks are dealt evenly once
    blocks = stage(made.repartition(df.sparkSession.sparkContext.defaultParallelism), "binned")
    n_rows = blocks.agg(F.sum(F.octet_length("label"))).first()[0] or 0
    return Binned(blocks, tuple(columns), edges, held, n_rows)


class _Column:
    """Bins of one column inside its words."""

    def __init__(self, words: np.ndarray, shift: int, bits: int):
        self.words, self.shift, self.mask = words, np.uint16(shift), np.uint16((1 << bits) - 1)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        return (self.words.take(rows) >> self.shift) & self.mask


class _Words:
    """Packed bins; a column is found by its number, as in an array (column, row)."""

    def __init__(self, words: np.ndarray, layout: _Layout):
        self.words, self.layout = words, layout

    def __getitem__(self, column: int) -> _Column:
        group, shift, bits = self.layout.packed[column]
        return _Column(self.words[group], shift, bits)


@dataclass
class _Block:
    bins: np.ndarray  # (column, row); packed, (group, row)
    label: np.ndarray
    held: np.ndarray
    margins: np.ndarray  # (model, row)

    @classmethod
    def of(cls, row: Row, columns: int, n_held: int, models: int) -> _Block:
        label = np.frombuffer(row["label"], np.uint8)
        margins = np.frombuffer(row["margins"], float).reshape(models, -1) if "margins" in row else np.zeros((models, len(label)))
        held = np.frombuffer(row["held"], np.int32).reshape(len(label), n_held)
        return cls(np.frombuffer(row["bins"], np.uint8).reshape(len(label), columns).T, label, held, margins)

    @classmethod
    def joined(cls, blocks: list[_Block]) -> _Block:
        """One block of the rows of all; each column of bins lies in one piece."""
        return cls(
            np.ascontiguousarray(np.concatenate([b.bins for b in blocks], axis=1)), np.concatenate([b.label for b in blocks]),
            np.concatenate([b.held for b in blocks]), np.concatenate([b.margins for b in blocks], axis=1),
        )


def _in_large_blocks(blocks: Iterator[_Block], most: int = SCAN_ROWS) -> Iterator[_Block]:
    held, rows = [], 0
    for block in blocks:
        if held and rows + len(block.label) > most:
            yield _Block.joined(held)
            held, rows = [], 0
        held.append(block)
        rows += len(block.label)
    if held:
        yield _Block.joined(held)


def _seen(block: _Block, rules: Growth, held: Sequence[str]) -> np.ndarray:
    if rules.left_out is None:
        return np.arange(len(block.label), dtype=np.int32)
    column, value = rules.left_out
    return np.flatnonzero(block.held[:, held.index(column)] != value).astype(np.int32)


@dataclass(frozen=True)
class _Layout:
    """Where the bins of each column lie in a row of sums, columns one after another without gaps, and in packed words."""

    first: np.ndarray
    bins: np.ndarray  # number of each column
    size: int
    place: np.ndarray  # of every cell in (column, bin) order
    shape: tuple[int, int]
    packed: tuple[tuple[int, int, int], ...]  # group, shift and bits of each column
    groups: tuple[tuple[int, ...], ...]  # columns of each group, from the highest bits down

    @classmethod
    def of(cls, edges: Sequence[Sequence[float]]) -> _Layout:
        n = np.array([len(e) + 1 for e in edges])
        width = int(n.max(initial=1))
        place = np.concatenate([i * width + np.arange(m) for i, m in enumerate(n)])
        groups, used, packed = [], [], {}
        for column in np.argsort(-n, kind="stable").tolist():
            bits = int(n[column] - 1).bit_length()
            group = next((g for g, b in enumerate(used) if b + bits <= GROUP_BITS), len(used))
            if group == len(used):
                groups.append([])
                used.append(0)
            packed[column] = (group, used[group], bits)
            groups[group].insert(0, column)
            used[group] += bits
        return cls(
            np.cumsum(n) - n, n, int(n.sum()), place, (len(n), width), tuple(packed[c] for c in range(len(n))), tuple(map(tuple, groups))
        )

    def words(self, bins: np.ndarray) -> np.ndarray:
        """Bins (column, row) as words (group, row)."""
        out = np.zeros((len(self.groups), bins.shape[1]), np.uint16)
        for column, (group, shift, _) in enumerate(self.packed):
            out[group] |= bins[column].astype(np.uint16) << np.uint16(shift)
        return out

    def cells(self, group: int) -> int:
        return 1 << sum(self.packed[c][2] for c in self.groups[group])

    def by_column(self, group: int, sums: np.ndarray, out: np.ndarray) -> None:
        """Add up sums by word, (3, cell), into the cells of the group's columns in ``out``, (cell, 3)."""
        for column in self.groups[group]:
            sums = sums.reshape(3, 1 << self.packed[column][2], -1)
            at, n = self.first[column], self.bins[column]
            out[at : at + n] = sums.sum(axis=2)[:, :n].T
            sums = sums.sum(axis=1)

    def spread(self, sums: np.ndarray) -> np.ndarray:
        """(wanted, cell, 3) as (wanted, column, bin, 3)."""
        out = np.zeros((len(sums), self.shape[0] * self.shape[1], 3))
        out[:, self.place] = sums
        return out.reshape(len(sums), *self.shape, 3)


def _gradients(label: np.ndarray, margin: np.ndarray, weights: tuple[float, float], loss: str) -> tuple[np.ndarray, np.ndarray]:
    weight = np.where(label == 1, weights[1], weights[0])
    if loss == "squares":
        sign = 2.0 * label - 1.0
        return -4.0 * weight * sign / (1.0 + np.exp(2.0 * sign * margin)), weight
    p = 1.0 / (1.0 + np.exp(-margin))
    return weight * (p - label), np.maximum(weight * p * (1.0 - p), 1e-16)


def _sums_of(words: np.ndarray, layout: _Layout, parts: Sequence[np.ndarray], gradients) -> np.ndarray:
    """Sums (part, cell, 3) of gradients, hessians and rows; ``gradients(rows)`` gives the first two."""
    out, few = np.zeros((len(parts), layout.size, 3)), []
    for i, rows in enumerate(parts):
        if len(rows) < FEW:
            few += [i] if len(rows) else []
            continue
        totals = [np.zeros((3, layout.cells(g))) for g in range(len(words))]
        for start in range(0, len(rows), CHUNK):
            some = rows[start : start + CHUNK].astype(np.intp)  # numpy takes by these only
            gradient, hessian = gradients(some)
            for word, total in zip(words, totals, strict=True):
                at = word.take(some).astype(np.intp)
                for kind, values in enumerate((gradient, hessian, None)):
                    total[kind] += np.bincount(at, values, total.shape[1])
        for group, total in enumerate(totals):
            layout.by_column(group, total, out[i])
    if few:
        chosen = np.concatenate([parts[i] for i in few]).astype(np.intp)
        slot = np.repeat(np.arange(len(few)), [len(parts[i]) for i in few])
        gradient, hessian = gradients(chosen)
        packed = _Words(words, layout)
        for column, (first, n) in enumerate(zip(layout.first, layout.bins)):
            cell, total = slot * n + packed[column][chosen], len(few) * n
            for kind, values in enumerate((gradient, hessian, None)):
                out[few, first : first + n, kind] = np.bincount(cell, values, total).reshape(len(few), n)
    return out


def _block_sums(block: _Block, rules: Growth, held, weights, partial, wanted: list[Wanted], margin: np.ndarray, layout: _Layout) -> np.ndarray:
    """Sums (wanted, cell, 3) of one model over one block."""
    asked = {node: (i, feature, cut, left) for i, (node, feature, cut, left) in enumerate(wanted)}
    parts, bins = [np.empty(0, np.int32)] * len(wanted), _Words(block.bins, layout)
    for node, rows in _rows_at(partial, bins, _seen(block, rules, held), _on_the_way(partial, list(asked))):
        i, feature, cut, left = asked[node]
        parts[i] = rows if feature == LEAF else rows[(bins[feature][rows] <= cut) == left]
    return _sums_of(block.bins, layout, parts, lambda rows: _gradients(block.label[rows], margin[rows], weights, rules.loss))


def _class_weights(rule: Growth, n: np.ndarray) -> tuple[float, float]:
    """Weights of a model whose rows hold ``n`` of each class."""
    return (1.0, rule.positive_weight) if rule.positive_weight is not None else tuple(n.sum() / (2.0 * np.maximum(n, 1)))


def _leaves(tree: Tree, children: dict[int, int], rows_of: dict[int, np.ndarray], bins: _Words) -> Iterator[tuple[int, np.ndarray]]:
    """Every leaf of a grown tree with its rows, from the rows of the nodes known while it grew and their left children."""
    open_ = [(0, 0)]
    while open_:
        at, node = open_.pop()
        if tree.feature[at] == LEAF:
            yield at, rows_of[node]
        elif node in children:
            open_ += [(tree.left[at], children[node]), (tree.right[at], children[node] + 1)]
        else:  # the last splits, whose sides were not summed
            goes = bins[tree.feature[at]][rows_of[node]] <= tree.cut[at]
            yield tree.left[at], rows_of[node][goes]
            yield tree.right[at], rows_of[node][~goes]


def _grown_in_task(words: np.ndarray, label: np.ndarray, rules: Growth, layout: _Layout) -> list[Tree]:
    """All trees of one model from the packed rows it sees."""
    weights, margin, trees = _class_weights(rules, np.bincount(label, minlength=2)[:2]), np.zeros(len(label)), []
    bins, every = _Words(words, layout), np.arange(len(label), dtype=np.int32)
    steps = rules.steps()
    while len(trees) < rules.rounds:
        gradient, hessian = _gradients(label, margin, weights, rules.loss)
        rows_of, children, growing, tree = {0: every}, {}, grow(rules), None
        known, wanted = next(growing)
        while tree is None:
            parts = []
            for i, (node, feature, cut, left) in enumerate(wanted):
                if feature == LEAF:
                    parts.append(rows_of[node])
                    continue
                rows, child = rows_of[node], len(known[0]) + 2 * i  # children are numbered in the order of asking
                goes, children[node] = bins[feature][rows] <= cut, child
                rows_of[child], rows_of[child + 1] = rows[goes], rows[~goes]
                parts.append(rows_of[child if left else child + 1])
            sums = _sums_of(words, layout, parts, lambda rows: (gradient.take(rows), hessian.take(rows)))  # noqa: B023
            try:
                known, wanted = growing.send(layout.spread(sums))
            except StopIteration as end:
                tree = end.value
        step = next(steps)
        for at, rows in _leaves(tree, children, rows_of, bins):
            margin[rows] += step * tree.weight[at]
        trees.append(tree)
    return trees


def _train_in_tasks(binned: Binned, rules: Sequence[Growth], layout: _Layout) -> list[list[Tree]]:
    """One task per model, which gets the rows the model sees; the driver gets the trees."""
    columns, held = len(binned.columns), binned.held

    def seen_by_model(rows: Iterator[Row]) -> Iterator[tuple[int, tuple[bytes, bytes]]]:
        for block in _in_large_blocks(_Block.of(row, columns, len(held), 0) for row in rows):
            words = layout.words(block.bins)
            for i, rule in enumerate(rules):
                seen = _seen(block, rule, held)
                if len(seen):
                    yield i, (np.ascontiguousarray(words[:, seen]).tobytes(), block.label[seen].tobytes())

    def grown(dealt) -> Iterator[tuple[int, list[Tree]]]:
        parts: dict[int, list] = {}
        for i, (words, label) in dealt:
            parts.setdefault(i, []).append((np.frombuffer(words, np.uint16).reshape(len(layout.groups), -1), np.frombuffer(label, np.uint8)))
        for i in sorted(parts):
            words, label = (np.concatenate(side, axis=-1) for side in zip(*parts.pop(i), strict=True))
            yield i, _grown_in_task(words, label, rules[i], layout)

    made = binned.blocks.rdd.mapPartitions(seen_by_model).partitionBy(len(rules), int).mapPartitions(grown)
    found = dict(made.collect())
    return [found.get(i, []) for i in range(len(rules))]


def _reduce(parts, partitions: int):
    return parts.reduce(_add) if partitions <= DIRECT else parts.treeReduce(_add, depth=2)


def _add(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b, strict=True)]


class _Matrix:
    """Blocks with the models' margins, cached; finished trees are added in the scan that next needs the margins."""

    def __init__(self, binned: Binned, models: int, layout: _Layout):
        self.binned, self.models, self.layout, self.blocks, self.rdd = binned, models, layout, None, None
        self.unwritten: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(models)]
        self.steps = 0
        self._load(binned.blocks)

    def _hold(self, rdd) -> None:
        old, self.rdd = self.rdd, rdd.persist(StorageLevel.MEMORY_AND_DISK)
        self.old = old

    def _load(self, blocks: DataFrame) -> None:
        columns, n_held, models, layout = len(self.binned.columns), len(self.binned.held), self.models, self.layout
        tasks = blocks.sparkSession.sparkContext.defaultParallelism
        wanted = max(1, min(tasks, -(-self.binned.n_rows // BLOCK_ROWS)))
        self.blocks = blocks
        rdd = blocks.rdd
        rdd = rdd.coalesce(wanted) if rdd.getNumPartitions() > wanted else rdd

        def packed(rows: Iterator[Row]) -> Iterator[_Block]:
            for block in _in_large_blocks(_Block.of(row, columns, n_held, models) for row in rows):
                yield _Block(layout.words(block.bins), block.label, block.held, block.margins)

        self._hold(rdd.mapPartitions(lambda rows: _in_large_blocks(packed(rows), CACHED_ROWS)))

    def sums(self, of_block) -> list[np.ndarray]:
        """Sum of ``of_block(block)``, a list of arrays, over all blocks."""

        def run(blocks):
            total = None
            for block in blocks:
                part = of_block(block)
                total = part if total is None else _add(total, part)
            return iter(() if total is None else (total,))

        found = _reduce(self.rdd.mapPartitions(run), self.rdd.getNumPartitions())
        if self.old is not None:  # the blocks it gave way to are there now
            self.old.unpersist()
            self.old = None
        return found

    def add(self, finished: dict[int, tuple[np.ndarray, ...]]) -> None:
        """Add a tree to the margins of each of some models."""
        for i, tree in finished.items():
            self.unwritten[i].append(tree)
        self.steps += 1
        if self.steps % FLUSH == 0:
            self._write()
            return

        layout = self.layout

        def added(block: _Block) -> _Block:
            margins = block.margins.copy()
            for i, tree in finished.items():
                _add_tree(margins[i], tree, _Words(block.bins, layout))
            return _Block(block.bins, block.label, block.held, margins)

        self._hold(self.rdd.map(added))

    def _write(self) -> None:
        columns, models, unwritten = len(self.binned.columns), self.models, self.unwritten

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    bins = np.ascontiguousarray(np.frombuffer(row["bins"], np.uint8).reshape(-1, columns).T)
                    margins = np.zeros((models, bins.shape[1]))
                    if "margins" in row:
                        margins += np.frombuffer(row["margins"], float).reshape(models, -1)
                    for i, trees in enumerate(unwritten):
                        for tree in trees:
                            _add_tree(margins[i], tree, bins)
                    made = [row["bins"], row["label"], row["held"], margins.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made], ["bins", "label", "held", "margins"])

        self._load(stage(self.blocks.mapInArrow(run, "bins binary, label binary, held binary, margins binary"), "margins"))
        self.unwritten = [[] for _ in range(models)]

    def close(self) -> None:
        for rdd in (self.rdd, self.old):
            if rdd is not None:
                rdd.unpersist()


@dataclass
class Booster:
    """Trees in training order, with the rules and bins they were grown by."""

    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    rules: Growth
    trees: list[Tree]

    def model(self, label: str) -> BoostedTreesModel:
        plain = [[*(a.tolist() for a in tree.arrays(step))] for tree, step in zip(self.trees, self.rules.steps())]
        importance = [0.0] * len(self.columns)
        for number, tree in enumerate(self.trees):
            twice = self.rules.loss == "squares" and number == 0  # the labels, see ``steps``
            for feature, gain in zip(tree.feature, tree.gain):
                if feature != LEAF:
                    importance[feature] += gain / 4 if twice else gain
        total = sum(importance) or 1.0
        return BoostedTreesModel(
            {"columns": list(self.columns), "edges": [list(e) for e in self.edges], "trees": plain, "label": label, "slope": self.rules.slope,
             "importance": [x / total for x in importance]}
        )

    def nodes(self, spark) -> DataFrame:
        """One row per node: tree, node, depth, split and its gain and order, sums, weight."""
        rows = []
        for number, tree in enumerate(self.trees):
            for i, feature in enumerate(tree.feature):
                inner = feature != LEAF
                rows.append((
                    number, i, tree.depth[i], self.columns[feature] if inner else None,
                    self.edges[feature][tree.cut[i]] if inner else None, tree.gain[i] if inner else None,
                    tree.order[i] if inner else None, tree.left[i] if inner else None, tree.right[i] if inner else None,
                    *tree.sums[i][:2], int(tree.sums[i][2]), tree.weight[i],
                ))
        return spark.createDataFrame(
            rows,
            "tree int, node int, depth int, feature string, threshold double, gain double, split_order int, left_node int, "
            "right_node int, gradient double, hessian double, n_rows long, weight double",
        )


def train(binned: Binned, rules: Sequence[Growth]) -> list[Booster]:
    """All boosters side by side: one scan serves every model's wishes, and models need not be in step."""
    layout, held = _Layout.of(binned.edges), binned.held
    if binned.n_rows <= LOCAL_ROWS:
        grown = _train_in_tasks(binned, rules, layout) if binned.n_rows else [[] for _ in rules]
        return [Booster(binned.columns, binned.edges, rule, trees) for rule, trees in zip(rules, grown, strict=True)]
    matrix = _Matrix(binned, len(rules), layout)

    def classes(block: _Block) -> list[np.ndarray]:
        return [np.bincount(block.label[_seen(block, r, held)], minlength=2)[:2] for r in rules]

    weights = [_class_weights(rule, n) for rule, n in zip(rules, matrix.sums(classes), strict=True)]
    done, steps = [[] for _ in rules], [rule.steps() for rule in rules]
    growing = {i: grow(rule) for i, rule in enumerate(rules) if rule.rounds}
    wishes = {i: next(g) for i, g in growing.items()}
    while growing:
        asked = [(i, rules[i], weights[i], partial, wanted) for i, (partial, wanted) in wishes.items()]

        def of_block(block: _Block, asked=asked) -> list[np.ndarray]:
            return [_block_sums(block, r, held, w, partial, wanted, block.margins[i], layout) for i, r, w, partial, wanted in asked]

        finished = {}
        for (i, *_), own in zip(asked, matrix.sums(of_block), strict=True):
            try:
                wishes[i] = growing[i].send(layout.spread(own))
            except StopIteration as end:
                done[i].append(end.value)
                if len(done[i]) == rules[i].rounds:
                    del growing[i], wishes[i]
                else:
                    finished[i] = end.value.arrays(next(steps[i]))
                    growing[i] = grow(rules[i])
                    wishes[i] = next(growing[i])
        if finished:
            matrix.add(finished)
    matrix.close()
    return [Booster(binned.columns, binned.edges, rule, trees) for rule, trees in zip(rules, done, strict=True)]


class BoostedTreesModel(StateModel):
    """Scores rows by the trees' summed weights; adds ``probability`` (of both classes) as Spark's classifiers do."""

    @property
    def featureImportances(self) -> list[float]:  # noqa: N802  named as Spark's tree models name it
        return self.fitted["importance"]

    def _transform(self, df: DataFrame) -> DataFrame:
        state = self.fitted
        edges, slope = [np.array(e) for e in state["edges"]], state.get("slope", 1.0)
        trees = [tuple(np.array(a, np.int32) for a in t[:4]) + (np.array(t[4]),) for t in state["trees"]]

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            bins = np.ascontiguousarray(_bins([c.to_numpy(float) for c in columns], edges).T)
            margin = np.zeros(bins.shape[1])
            for tree in trees:
                _add_tree(margin, tree, bins)
            return pd.Series(1.0 / (1.0 + np.exp(-slope * margin)))

        p = probability(*[F.col(c).cast("double") for c in state["columns"]])
        scored = df.withColumn("_p", p)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")
