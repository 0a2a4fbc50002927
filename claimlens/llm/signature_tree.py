"""Signature tree over token sets: dual traversal that prunes node pairs by their largest possible overlap.

A node holds the OR of its members' token bitmaps, their size range, and the largest number of tokens that a member
loses to shared bits.  Two members share at most the common bits of their nodes plus that loss; a pair of nodes is
left as soon as this, or the size ranges, cannot reach the similarity.  Everything below a pair is handled as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 16
CELLS = 1 << 21  # bitmap words compared at once
BATCH = 1 << 18  # pairs of nodes handled at once

# Jaccard >= 80/100 means 9 * overlap >= 4 * (size + size).
OVERLAP, SIZES = 9, 4


class Tree:
    """Levels of nodes over ``members`` (row numbers) with their ``bits`` (members x 64-bit words), in ascending size."""

    def __init__(self, members: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.members = members
        lost = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, lost)]
        while len(self.levels[-1][0]) > FAN:
            bits, least, most, lost = self.levels[-1]
            at = np.arange(0, len(bits), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at, axis=0),
                    np.minimum.reduceat(least, at),
                    np.maximum.reduceat(most, at),
                    np.maximum.reduceat(lost, at),
                )
            )

    def folded(self) -> Tree:
        """The same members with halved bitmaps."""
        bits, sizes, *_ = self.levels[0]
        half = bits.shape[1] // 2
        return Tree(self.members, sizes, bits[:, :half] | bits[:, half:])

    def roots(self, root: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest component under each node of a level."""
        of_members = root[self.members]
        at = np.arange(0, len(of_members), FAN**level)
        return np.minimum.reduceat(of_members, at), np.maximum.reduceat(of_members, at)


def _may_meet(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    (bits_a, least_a, most_a, lost_a), (bits_b, least_b, most_b, lost_b) = a, b
    fits = (5 * most_a[i] >= 4 * least_b[j]) & (5 * most_b[j] >= 4 * least_a[i])
    at = np.flatnonzero(fits)
    step = max(1, CELLS // bits_a.shape[1])
    for start in range(0, len(at), step):
        part = at[start : start + step]
        x, y = i[part], j[part]
        common = np.bitwise_count(bits_a[x] & bits_b[y]).sum(1, dtype=np.int64)
        most = common + np.minimum(lost_a[x], lost_b[y])
        fits[part] = OVERLAP * most >= SIZES * (least_a[x] + least_b[y])
    return fits


def _children(i: np.ndarray, j: np.ndarray, n_a: int, n_b: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.divmod(np.arange(FAN * FAN), FAN)
    i, j = (i[:, None] * FAN + x).ravel(), (j[:, None] * FAN + y).ravel()
    keep = (i < n_a) & (j < n_b)
    if same:
        keep &= i <= j
    return i[keep], j[keep]


def meeting_pairs(a: Tree, b: Tree | None = None, root: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers that may be similar: of one tree, or of two with equally wide bitmaps.

    ``root`` holds the rows' components and may change between two results: a pair of nodes all of whose members are
    connected is left, too.
    """
    same, b = b is None, a if b is None else b
    top = min(len(a.levels), len(b.levels)) - 1
    i, j = np.divmod(np.arange(len(a.levels[top][0]) * len(b.levels[top][0])), len(b.levels[top][0]))
    if same:
        i, j = i[i <= j], j[i <= j]
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if len(i) > BATCH:
            half = len(i) // 2
            stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
            continue
        if level == 0 and same:
            i, j = i[i < j], j[i < j]
        if root is not None:
            (low_a, high_a), (low_b, high_b) = a.roots(root, level), b.roots(root, level)
            apart = (low_a[i] != high_b[j]) | (high_a[i] != low_b[j])
            i, j = i[apart], j[apart]
        keep = _may_meet(a.levels[level], b.levels[level], i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if level == 0:
            yield a.members[i], b.members[j]
        else:
            step = max(1, BATCH // FAN**2)
            for start in range(0, len(i), step):
                part = slice(start, start + step)
                below = _children(i[part], j[part], len(a.levels[level - 1][0]), len(b.levels[level - 1][0]), same)
                stack.append((level - 1, *below))


def candidate_pairs(
    sizes: np.ndarray, bitmaps: list[bytes], side: np.ndarray | None = None, root: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i < j) of sets that the bitmaps do not rule out, in batches; of two ``side`` values only those across.

    Sets of one bitmap width make a tree.  Similar sets differ by at most one width; the wider ones are folded then.
    """
    widths = np.array([len(b) for b in bitmaps])
    sides = np.zeros(len(sizes), int) if side is None else side
    trees: dict[tuple[int, int], Tree] = {}
    for width in np.unique(widths):
        for s in np.unique(sides):
            members = np.flatnonzero((widths == width) & (sides == s))
            if len(members):
                members = members[np.argsort(sizes[members], kind="stable")]
                bits = np.frombuffer(b"".join(bitmaps[m] for m in members), np.uint64).reshape(len(members), -1)
                trees[int(width), int(s)] = Tree(members, sizes[members], bits)
    across = len({s for _, s in trees}) > 1
    for (width, s), tree in trees.items():
        for (other_width, other_s), other in trees.items():
            if across and s == other_s or other_width not in (width, 2 * width):
                continue
            if other_width == width:
                if across and s > other_s:
                    continue
                found = meeting_pairs(tree, other if across else None, root)
            else:
                found = meeting_pairs(tree, other.folded(), root)
            for i, j in found:
                yield np.minimum(i, j), np.maximum(i, j)
