"""Exact interpolated quantiles without gathering a column in one task.

Spark's own exact ``percentile`` keeps every distinct value of a group in one buffer.  Here a sketch
brackets each wanted rank, one pass counts what lies below and inside the bracket, and only the values
inside are histogrammed.  A bracket that still holds too many distinct values is narrowed again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
MARGIN = 2 / SKETCH_ACCURACY
MAX_COLLECT = 4096  # histogram rows of one bracket the driver may receive


@dataclass
class _Rank:
    """One order statistic being searched: 0-based ``rank`` of ``column`` within [low, high]."""

    column: str
    rank: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    value: float | None = None

    def is_inside(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def _around(fraction: float) -> list[float]:
    return [max(fraction - MARGIN, 0.0), min(fraction + MARGIN, 1.0)]


def _brackets(ranks: Sequence[_Rank]) -> list[list[_Rank]]:
    """Ranks that search the same bracket (both neighbours of a position do) together."""
    shared: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        shared.setdefault((r.column, r.low, r.high), []).append(r)
    return list(shared.values())


def _count(df: DataFrame, ranks: Sequence[_Rank], shape: Mapping[str, float]) -> None:
    """Count below and inside each bracket; a bracket that missed its rank moves to that side."""
    aggs = []
    brackets = _brackets(ranks)
    for i, (r, *_) in enumerate(brackets):
        aggs.append(F.count_if(F.col(r.column) < r.low).alias(f"below{i}"))
        aggs.append(F.count_if(r.is_inside()).alias(f"inside{i}"))
    found = df.agg(*aggs).first()
    for i, r in ((i, r) for i, same in enumerate(brackets) for r in same):
        r.below, r.inside = found[f"below{i}"], found[f"inside{i}"]
        if r.rank < r.below:
            r.low, r.high, r.inside = shape[f"min_{r.column}"], r.low, 0
        elif r.rank >= r.below + r.inside:
            r.low, r.high, r.inside = r.high, shape[f"max_{r.column}"], 0
        elif r.low == r.high:
            r.value = r.low


def _histogram(df: DataFrame, brackets: Sequence[list[_Rank]]) -> DataFrame:
    """(bracket, value, rows) of the values inside; rows outside every bracket are dropped first."""
    hits = [
        F.when(r.is_inside(), F.struct(F.lit(i).alias("i"), F.col(r.column).alias("value")))
        for i, (r, *_) in enumerate(brackets)
    ]
    anywhere = reduce(or_, [r.is_inside() for r, *_ in brackets])
    return (
        df.where(anywhere)
        .select(F.explode(F.array(*hits)).alias("hit"))
        .where("hit IS NOT NULL")
        .groupBy("hit.i", "hit.value")
        .agg(F.count("*").alias("n"))
    )


def _pick(df: DataFrame, ranks: Sequence[_Rank]) -> None:
    """Read the wanted values off the histogram of every bracket that is small enough."""
    brackets = _brackets([r for r in ranks if r.value is None and r.inside])
    small = [same for same in brackets if same[0].inside <= MAX_COLLECT]
    large = [same for same in brackets if same[0].inside > MAX_COLLECT]
    if large:  # many rows, but perhaps few distinct values
        sizes = _histogram(df, large).groupBy("i").agg(F.count("*").alias("n")).collect()
        small += [large[row["i"]] for row in sizes if row["n"] <= MAX_COLLECT]
    if not small:
        return
    seen = [same[0].below for same in small]
    for row in _histogram(df, small).orderBy("i", "value").collect():
        i = row["i"]
        seen[i] += row["n"]
        for r in small[i]:
            if r.value is None and r.rank < seen[i]:
                r.value = row["value"]


def _narrow(df: DataFrame, ranks: Sequence[_Rank]) -> None:
    """Sketch again inside the bracket of every rank that is still open."""
    sketches = []
    for i, r in enumerate(ranks):
        at = (r.rank - r.below) / (r.inside - 1) if r.inside > 1 else 0.5
        spread = _around(at) if r.inside else [0.0, 0.5, 1.0]
        values = F.when(r.is_inside(), F.col(r.column))
        sketches.append(F.percentile_approx(values, spread, SKETCH_ACCURACY).alias(f"s{i}"))
    found = df.agg(*sketches).first()
    for i, r in enumerate(ranks):
        r.low, r.high = found[f"s{i}"][0], found[f"s{i}"][-1]


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several numeric columns, nulls left out.

    The same values as an exact ``percentile``; a column without values gives None.
    """
    df = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    aggs = []
    for c, fractions in wanted.items():
        ends = [end for f in fractions for end in _around(f)]
        aggs += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        aggs.append(F.percentile_approx(c, ends, SKETCH_ACCURACY).alias(f"s_{c}"))
    shape = df.agg(*aggs).first()

    ranks: dict[tuple[str, int], _Rank] = {}
    for c, fractions in wanted.items():
        for k, fraction in enumerate(fractions):
            if not shape[f"n_{c}"]:
                continue
            low, high = shape[f"s_{c}"][2 * k : 2 * k + 2]
            position = fraction * (shape[f"n_{c}"] - 1)
            for rank in {math.floor(position), math.ceil(position)}:
                ranks[c, rank] = _Rank(c, rank, low, high)

    open_ranks = list(ranks.values())
    while open_ranks:
        _count(df, open_ranks, shape)
        _pick(df, open_ranks)
        open_ranks = [r for r in open_ranks if r.value is None]
        if open_ranks:
            _narrow(df, open_ranks)

    out: dict[str, list[float | None]] = {}
    for c, fractions in wanted.items():
        out[c] = []
        for fraction in fractions:
            if not shape[f"n_{c}"]:
                out[c].append(None)
                continue
            position = fraction * (shape[f"n_{c}"] - 1)
            low, high = ranks[c, math.floor(position)].value, ranks[c, math.ceil(position)].value
            out[c].append(low + (high - low) * (position - math.floor(position)))
    return out


def quantile(df: DataFrame, column: str, fraction: float, approx: bool = False) -> float | None:
    """One quantile; ``approx=True`` settles for the sketch."""
    if approx:
        return df.agg(F.percentile_approx(column, fraction, SKETCH_ACCURACY)).first()[0]
    return exact_quantiles(df, {column: [fraction]})[column][0]
