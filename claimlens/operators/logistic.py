"""Logistic regression by Newton steps; several models, such as the folds of a cross-validation, in one scan per step.

A scan sums, for each model, the loss, the gradient and the matrix of second derivatives at its coefficients over the rows
it does not leave out.  These are arrays of (columns + 1)^2 numbers per task; the driver solves for the step.  What is
minimised is Spark's: the weighted mean of the log loss plus ``penalty`` / 2 times the sum of squared coefficients, the
intercept free.  It has one minimum; some eight scans reach it where the gradient alone takes a scan or two for each of
a hundred steps.  A step that does not lower the loss is halved.  No row is kept in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.transforms import StateModel

CHUNK = 65_536  # rows of one block of arrays
NEAR = 1e-12  # half the expected gain of a step, relative to the loss; the step of one this small is the last


@dataclass(frozen=True)
class Fit:
    """One model: its penalty, the weights of the classes 0 and 1, and the rows it must not see."""

    penalty: float
    weights: tuple[float, float]
    left_out: tuple[str, int] | None = None  # (column, value)


@dataclass
class _State:
    """Coefficients (the intercept last) with their loss and derivatives, and the step tried from there."""

    at: np.ndarray
    loss: float = np.inf
    step: np.ndarray | None = None
    gain: float = 0.0  # expected decrease along the whole step
    share: float = 1.0

    def tried(self) -> np.ndarray:
        return self.at if self.step is None else self.at + self.share * self.step


def _sums(x: np.ndarray, y: np.ndarray, held: Mapping[str, np.ndarray], fits: Sequence[Fit], at: np.ndarray) -> list[np.ndarray]:
    """Per model one array: weight, loss, weight of either class, gradient, second derivatives."""
    out = []
    margins = x @ at.T
    for i, fit in enumerate(fits):
        w = np.where(y == 1, fit.weights[1], fit.weights[0])
        if fit.left_out is not None:
            w = np.where(held[fit.left_out[0]] == fit.left_out[1], 0.0, w)
        m = margins[:, i]
        loss = np.logaddexp(0.0, m) - y * m
        with np.errstate(over="ignore"):
            p = 1.0 / (1.0 + np.exp(-m))
        sums = [w.sum(), w @ loss, (w * (1 - y)).sum(), w @ y]
        out.append(np.concatenate([sums, x.T @ (w * (p - y)), (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()]))
    return out


def _scan(rows: DataFrame, columns: int, held: Sequence[str], fits: Sequence[Fit], at: np.ndarray) -> np.ndarray:
    """Sums (model, number) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                x = np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(columns)] + [np.ones(part.num_rows)])
                y = part.column(columns).to_numpy(zero_copy_only=False)
                own = {c: part.column(columns + 1 + i).to_numpy(zero_copy_only=False) for i, c in enumerate(held)}
                found = np.stack(_sums(x, y, own, fits, at))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    size = 4 + (columns + 1) + (columns + 1) ** 2
    total = np.zeros((len(fits), size))
    for row in rows.mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(row["sums"]).reshape(len(fits), size)
    return total


def train(df: DataFrame, columns: Sequence[str], label: str, fits: Sequence[Fit], max_iter: int = 1000) -> list[LogisticModel]:
    """All models side by side on a stored table without gaps; at most ``max_iter`` steps each."""
    held = sorted({fit.left_out[0] for fit in fits if fit.left_out is not None})
    rows = df.select(
        *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("label"),
        *[F.col(c).cast("int").alias(f"h{i}") for i, c in enumerate(held)],
    )
    n = len(columns)
    states = [_State(np.zeros(n + 1)) for _ in fits]
    open_ = list(range(len(fits)))
    taken = 0
    while open_:
        asked = [fits[i] for i in open_]
        found = _scan(rows, n, held, asked, np.stack([states[i].tried() for i in open_]))
        still = []
        for i, sums in zip(open_, found, strict=True):
            if _advance(states[i], fits[i].penalty, sums, n) and taken < max_iter:
                still.append(i)
        open_ = still
        taken += 1
    return [LogisticModel({"columns": list(columns), "coefficients": s.at[:n].tolist(), "intercept": float(s.at[n])}) for s in states]


def _advance(state: _State, penalty: float, sums: np.ndarray, n: int) -> bool:
    """Take what the scan found at the tried coefficients; whether another scan is wanted."""
    weight, loss, zero, one = sums[:4]
    if weight <= 0:
        raise ValueError("no rows to learn from")
    if zero <= 0 or one <= 0:  # of one class only the intercept says so, as in Spark
        state.at = np.zeros(n + 1)
        state.at[n] = np.inf if zero <= 0 else -np.inf
        return False
    at = state.tried()
    free = np.append(np.full(n, penalty), 0.0)
    value = loss / weight + 0.5 * float(free @ (at * at))
    if state.step is not None and value > state.loss - 1e-4 * state.share * state.gain + 1e-13 * abs(state.loss):
        state.share /= 2
        return state.share > 1e-9
    gradient = sums[4 : n + 5] / weight + free * at
    curved = sums[n + 5 :].reshape(n + 1, n + 1) / weight + np.diag(free)
    step = -np.linalg.lstsq(curved, gradient, rcond=1e-15)[0]
    state.at, state.loss, state.step, state.gain, state.share = at, value, step, float(-gradient @ step), 1.0
    if state.gain <= NEAR * max(abs(value), NEAR):
        state.at = at + step
        return False
    return True


class LogisticModel(StateModel):
    """Scores rows by their columns; adds ``probability`` (of both classes) as Spark's classifiers do."""

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.fitted["coefficients"])

    @property
    def intercept(self) -> float:
        return self.fitted["intercept"]

    def probability(self) -> Column:
        """Probability of class 1; a null or NaN is refused, as by Spark's assembler."""
        margin = F.lit(float(self.intercept))
        for name, factor in zip(self.fitted["columns"], self.fitted["coefficients"], strict=True):
            value = F.nanvl(F.col(name).cast("double"), F.lit(None))
            margin = margin + F.coalesce(value, F.raise_error(F.lit(f"null or NaN in {name}")).cast("double")) * F.lit(float(factor))
        return 1 / (1 + F.exp(-margin))

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("_p", self.probability())
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")
