"""Best-fit packing of tokenised documents into training sequences, improved by swap-based local search.

Texts become token ids in one scan.  A document longer than a sequence is cut into full sequences, its first piece
taking what is left over; all other pieces are packed.  Pieces are dealt at random over groups of about ``GROUP``, so
a group's size never follows a source or a length.  Inside a group pieces are placed by best fit, longest first; then
bins that are not full take from others by moves, one-for-one and two-for-one exchanges.  Every step raises the sum of
squared fills; emptied bins go.  Where that ends above the least number of bins, the search starts again from bins
filled one by one, and the better of both stays.

Exactly full bins are done.  Of the others a group closes the fullest, so that at most half of its pieces are left;
these are packed anew with those of other groups, in rounds, until one group is left.

Defined results: null and empty texts are one end token; rows are packed one by one, repeated or not, with or without
an id; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.session import stage

SIZE = 2048
END = 0  # id that ends every document
GROUP = 16_384  # pieces packed in one task
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json as ranks
SPECIAL = {"<|endoftext|>": 50256}

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks: str) -> tiktoken.Encoding:
    """The byte-level BPE, built once per process; gives the ids that byte_bpe_50k.json gives."""
    if ranks not in _encodings:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[ranks] = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=SPECIAL
        )
    return _encodings[ranks]


def token_ids(text: str | None, ranks: str = RANKS) -> np.ndarray:
    ids = encoding(ranks).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, END).astype("<u4")


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one, or full ones after a first that may be shorter."""
    first = length if length <= size else length % size or size
    return [(0, first)] + [(at, size) for at in range(first, length, size)]


def pieces(docs: DataFrame, size: int = SIZE, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows, parts = [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = token_ids(text.as_py(), ranks)
                for number, (start, length) in enumerate(cuts(len(ids), size)):
                    part = ids[start : start + length]
                    owner.append(i)
                    rows.append((number, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        parts.append(part)
            table = np.array(rows, np.int64).reshape(-1, 4)
            columns = [
                batch.column("doc_id").take(pa.array(owner, pa.int64())),
                pa.array(table[:, 0].astype(np.int32)),
                pa.array(table[:, 1]),
                pa.array(table[:, 2]),
                pa.array(table[:, 3]),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(per_batch, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the bin with the least room that still holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[number].append(item)
        else:
            room, number = size, len(bins)
            bins.append([item])
        by_room[room - length].append(number)
        rooms |= 1 << room - length
    return bins


class LocalSearch:
    """Bins of one group, improved until no exchange helps or their number is the least possible.

    A bin takes from another one by a move, a one-for-one or a two-for-one exchange (either side may give the two) that
    makes it fuller than both were.  So the sum of squared fills grows with every exchange, and bins are emptied.  Every
    distinct length, and every pair of lengths, of every bin that is not exactly full is on offer; passes go on until
    one of them changes nothing.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], size: int) -> None:
        self.size = size
        self.of = lengths.tolist()
        self.bins = dict(enumerate(bins))
        self.fill = {n: sum(self.of[i] for i in items) for n, items in self.bins.items()}
        # (one or two lengths given up, as their sum) -> the bins that can give them
        self.givers: dict[int, dict[int, dict[int, tuple[int, ...]]]] = {1: {}, 2: {}}
        self.masks = {1: 0, 2: 0}
        self.offered: dict[int, list[tuple[int, int]]] = {}
        for n in self.bins:
            self._offer(n)

    def _gifts(self, n: int) -> list[tuple[int, ...]]:
        """Items that bin ``n`` could give up, one for each distinct length and each distinct pair of lengths."""
        first: dict[int, int] = {}
        second: dict[int, int] = {}
        for i in self.bins[n]:
            if self.of[i] not in first:
                first[self.of[i]] = i
            elif self.of[i] not in second:
                second[self.of[i]] = i
        some = sorted(first.items(), reverse=True)
        pairs = [(i, j) for a, (_, i) in enumerate(some) for _, j in some[a + 1 :]]
        return [(i,) for _, i in some] + pairs + [(first[length], i) for length, i in second.items()]

    def _offer(self, n: int) -> None:
        """Put what ``n`` holds now on offer, in place of what it held."""
        for k, total in self.offered.pop(n, ()):
            del self.givers[k][total][n]
            if not self.givers[k][total]:
                self.masks[k] &= ~(1 << total)
        if n not in self.bins or self.fill[n] == self.size:
            return
        mine = self.offered[n] = []
        for gift in self._gifts(n):
            k, total = len(gift), sum(self.of[i] for i in gift)
            holders = self.givers[k].setdefault(total, {})
            if n not in holders:
                holders[n] = gift
                self.masks[k] |= 1 << total
                mine.append((k, total))

    def _best(self, n: int) -> tuple[int, tuple[int, ...], int, tuple[int, ...]] | None:
        """(gain, what ``n`` gives, other bin, what it gives) of the exchange that fills ``n`` most."""
        fill, room = self.fill[n], self.size - self.fill[n]
        best, chosen = 0, None
        for gift in [(), *self._gifts(n)]:
            given = sum(self.of[i] for i in gift)
            for k in (1, 2):
                if len(gift) == k == 2:
                    continue
                # totals above given + best, up to what fits
                window = (self.masks[k] & ((1 << given + room + 1) - 1)) >> (given + best + 1)
                while window:
                    top = window.bit_length() - 1
                    gain = best + 1 + top
                    donor = next((m for m in self.givers[k][given + gain] if m != n and self.fill[m] < fill + gain), None)
                    if donor is not None:
                        best, chosen = gain, (gain, gift, donor, self.givers[k][given + gain][donor])
                        break
                    window ^= 1 << top
            if best == room:
                break
        return chosen

    def shrink(self) -> None:
        least = math.ceil(sum(self.of) / self.size)
        changed = True
        while changed and len(self.bins) > least:
            changed = False
            for n in sorted(self.bins, key=lambda m: (-self.fill[m], m)):
                while n in self.bins and self.fill[n] < self.size and len(self.bins) > least and (found := self._best(n)):
                    gain, gift, other, taken = found
                    self.bins[n] = [i for i in self.bins[n] if i not in gift] + list(taken)
                    self.bins[other] = [i for i in self.bins[other] if i not in taken] + list(gift)
                    self.fill[n] += gain
                    self.fill[other] -= gain
                    if not self.bins[other]:
                        del self.bins[other], self.fill[other]
                    self._offer(n)
                    self._offer(other)
                    changed = True


def fullest_first(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins filled one after another, each by the longest item left and those that fill the rest of it most."""
    left = np.argsort(-lengths, kind="stable").tolist()
    short = (-lengths[left]).tolist()  # ascending, for the search below
    bins = []
    while left:
        head, room = left[0], size + short[0]
        first = max(1, bisect_left(short, -room))  # longer items do not fit beside it
        full, reached, steps = 1 << room, 1, []
        for length in short[first:]:
            if reached & full:
                break
            steps.append(reached)
            reached |= reached << -length
            reached &= (full << 1) - 1
        total, chosen = reached.bit_length() - 1, []
        for at in range(len(steps) - 1, -1, -1):
            if not steps[at] >> total & 1:
                chosen.append(first + at)
                total += short[first + at]
        bins.append([head, *(left[at] for at in chosen)])
        for at in [*chosen, 0]:  # from the back
            del left[at], short[at]
    return bins


def pack_group(lengths: np.ndarray, size: int = SIZE) -> list[list[int]]:
    """Local search from best fit and, where that needs more bins than the tokens fill, from bins filled one by one."""
    least, found = math.ceil(int(lengths.sum()) / size), None
    for start in (best_fit, fullest_first):
        search = LocalSearch(lengths, start(lengths, size), size)
        search.shrink()
        if found is None or len(search.bins) < len(found):
            found = list(search.bins.values())
        if len(found) == least:
            break
    return found


def _closed(bins: list[list[int]], fills: np.ndarray, size: int) -> np.ndarray:
    """Bins that stay: the exactly full ones, and the fullest others until at most half of the pieces are left."""
    order = np.argsort(-fills, kind="stable")
    pieces = np.array([len(bins[n]) for n in order])
    open_ = pieces.sum() - np.cumsum(pieces)  # pieces in bins after this one
    closed = np.zeros(len(bins), bool)
    closed[order] = (fills[order] == size) | (open_ + pieces > pieces.sum() / 2)
    return closed


def _packer(size: int, round_: int):
    """Function that packs one group of pieces."""

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        bins = pack_group(group["length"].to_numpy(), size)
        order = np.array([item for items in bins for item in items], np.int64)
        number = np.repeat(np.arange(len(bins)), [len(items) for items in bins])
        out = group.iloc[order].copy()
        lengths = out["length"].groupby(number)
        out["offset"] = lengths.cumsum().to_numpy() - out["length"].to_numpy()
        out["sequence_id"] = (round_ << 56) + (int(group["deal"].iloc[0]) << 24) + number
        fills = np.bincount(number, out["length"].to_numpy(), minlength=len(bins))
        out["closed"] = _closed(bins, fills, size)[number]
        return out

    return packed


def pack(docs: DataFrame, size: int = SIZE, ranks: str = RANKS, with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """Pieces with their sequence and their place in it."""
    cut = pieces(docs, size, ranks, with_ids).withColumn("row", F.monotonically_increasing_id())
    # Written once: rows keep their number even if an executor is lost later.
    cut = stage(cut, "pieces")
    whole = cut.where(F.col("length") == size)
    done = [whole.withColumns({"sequence_id": -F.col("row") - 1, "offset": F.lit(0).cast("long")}).drop("row")]
    open_, round_ = cut.where(F.col("length") < size), 0
    left = open_.count()
    while left:
        groups = max(1, round(left / group))
        dealt = open_.withColumn("deal", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups)))
        schema = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes) + ", offset long, sequence_id long, closed boolean"
        packed = stage(dealt.groupBy("deal").applyInPandas(_packer(size, round_), schema), "packed")
        if groups == 1:
            done.append(packed.drop("row", "deal", "closed"))
            break
        done.append(packed.where("closed").drop("row", "deal", "closed"))
        open_ = packed.where("NOT closed").drop("deal", "closed", "offset", "sequence_id")
        left, round_ = open_.count(), round_ + 1
    return reduce(DataFrame.unionByName, done)
