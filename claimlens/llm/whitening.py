"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The rows lie in blocks of integers in the shared folder.  A step of the bidiagonalisation A V = U B makes the products
A v and A'u in one scan: every left vector u_j is A w_j for a short vector w_j, so that the driver keeps w_j and the
scan makes u_j anew, together with its inner products with all earlier left vectors (full reorthogonalisation, repeated
when the vector shrinks by it).  Nothing as long as the table is ever kept, and a lost executor costs the scan of its
blocks only.  The singular values of the small bidiagonal matrix give the deviations, its right vectors the components.

Fixed by the job: an entry c becomes the integer x = floor(scale * c) + shift.  Rows whose id or vector is null, whose
vector is empty, holds null, NaN or infinite entries, or has not the table's (largest) dimension take no part; repeated
rows count each.  Entries are held at +-2^50.  Components without deviation have no whitened value and are left out, so
that a table of equal rows, or without rows, gives an empty result.  ``deviation`` is null where it exceeds 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.vectors import dimension, matrix, usable
from claimlens.session import stage

CELLS = 1 << 17  # entries of a block
LARGEST = float(1 << 50)
ROUNDING = 1e-13  # of the matrix's norm: shorter vectors are zero
CONVERGED = 1e-13  # of the largest singular value: residual of a finished component
RANK = 1e-10  # of the largest deviation: smaller ones are zero
RENEWED = 4  # times a new left vector is made orthogonal at most


def _blocks(rows: DataFrame, d: int, scale: int, shift: int) -> DataFrame:
    """Blocks of rows: ``keys`` and ``x``, the integers row by row as 8-byte numbers."""
    height, kind = max(1, CELLS // d), dict(rows.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, height):
                part = batch.slice(start, height)
                c = matrix(part.column("vec"), d)
                x = np.clip(np.floor(scale * c), -LARGEST, LARGEST).astype("<i8") + shift
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("key"))
                yield pa.RecordBatch.from_arrays([keys, pa.array([x.tobytes()], pa.binary())], ["keys", "x"])

    return stage(rows.where(F.size("vec") == d).select("key", "vec").mapInArrow(run, f"keys array<{kind}>, x binary"), "vector-blocks")


def _total(blocks: DataFrame, of_block: Callable[[np.ndarray], np.ndarray], d: int, kind: str = "double") -> np.ndarray:
    """Entrywise sum of ``of_block`` over all blocks, added up in the tasks and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column("x"):
                part = of_block(np.frombuffer(value.as_buffer(), "<i8").reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["part"])

    parts = blocks.select("x").mapInArrow(run, f"part array<{kind}>")
    sums = parts.select(F.posexplode("part").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v"))
    return np.array([row["v"] for row in sorted(sums.collect())])


@dataclass(frozen=True)
class Centre:
    """Number of rows and sums of the integers."""

    n: int
    sums: np.ndarray

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n times the centred rows, as integers."""
        return self.n * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x) / self.n


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(blocks: DataFrame, centre: Centre, k: int, norm: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading singular values of the centred rows and their right vectors, as columns.

    Ends when ``k`` triples have converged and nothing that was not met can be larger, else after as many steps as there
    are dimensions.  A vector that vanishes ends an invariant subspace; a random one orthogonal to all goes on.
    """
    d = len(centre.sums)
    rng = np.random.default_rng(seed)
    right = np.zeros((d, 0))  # v_j
    short, back = np.zeros((d, 0)), np.zeros((d, 0))  # w_j with u_j = A w_j, and A'u_j
    alpha, beta = np.zeros(d), np.zeros(d)
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    w = v
    for j in range(d):
        right = np.column_stack([right, v])
        length = 0.0
        for _ in range(RENEWED):

            def products(x: np.ndarray, w: np.ndarray = w, short: np.ndarray = short) -> np.ndarray:
                rows = centre.centred(x)
                u = rows @ w
                return np.concatenate([rows.T @ u, (rows @ short).T @ u, [u @ u]])

            sums = _total(blocks, products, d)
            z, along, square = sums[:d], sums[d:-1], sums[-1]
            w, z = w - short @ along, z - back @ along
            left = square - along @ along
            length = float(np.sqrt(max(left, 0.0)))
            if left > 0.5 * square or length <= ROUNDING * norm:
                break
        if length > ROUNDING * norm:
            alpha[j], w, z = length, w / length, z / length
        else:
            w, z = np.zeros(d), np.zeros(d)  # no left vector belongs to v
        short, back = np.column_stack([short, w]), np.column_stack([back, z])
        v = _orthogonal(z - alpha[j] * v, right)
        size = float(np.linalg.norm(v))
        whole = j + 1 == d
        if not whole and size > ROUNDING * norm:
            beta[j], v = size, v / size
        elif not whole:
            v = _orthogonal(rng.standard_normal(d), right)
            v /= np.linalg.norm(v)
        small = np.diag(alpha[: j + 1]) + np.diag(beta[:j], 1)
        inner, values, outer = np.linalg.svd(small)
        kept = min(k, j + 1)
        rest = norm**2 - float(values @ values)  # what has not been met, as a sum of squares
        done = (beta[j] * np.abs(inner[j, :kept]) <= CONVERGED * values[0]).all() and kept == k and rest <= values[k - 1] ** 2
        if done or whole:
            return values[:kept], right @ outer[:kept].T
        w = v - beta[j] * short[:, j]
    return np.zeros(0), right


def whiten(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """Every usable row's whitened value on each of the leading components, and what the fit says of it.

    Returns ``key``, ``component`` from 1, ``n``, ``deviation`` (sum over dimensions of (n*x - S)^2), ``whitened``,
    ``explained`` (share of the total variance), ``identity_error`` (largest entry of the whitened values' covariance less
    the identity, measured in a scan of its own).  A component's largest entry is positive.
    """
    rows = usable(embeddings, key, vector)
    kind = dict(rows.dtypes)["key"]
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = embeddings.sparkSession.createDataFrame([], schema)
    d = dimension(rows)
    if not d:
        return nothing
    blocks = _blocks(rows, d, scale, shift)
    counted = _total(blocks, lambda x: np.append(x.sum(axis=0), len(x)), d, "long")
    centre = Centre(int(counted[-1]), counted[:-1])
    norm = float(np.sqrt(_total(blocks, lambda x: np.array([np.square(centre.centred(x)).sum()]), d)[0]))
    if norm == 0:
        return nothing
    values, vectors = bidiagonalise(blocks, centre, min(components, d), norm)
    solid = values > RANK * values[0]
    values, vectors = values[solid], vectors[:, solid]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    onto, k = vectors * (np.sqrt(centre.n) / values), len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x) @ onto
        return np.append((y.T @ y).ravel(), y.sum(axis=0))

    sums = _total(blocks, moments, d) / centre.n
    mean = sums[k * k :]
    error = float(np.abs(sums[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    explained = values**2 / norm**2

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, value in zip(batch.column("keys"), batch.column("x"), strict=True):
                x = np.frombuffer(value.as_buffer(), "<i8").reshape(-1, d)
                whole, m = centre.exact(x), len(x)
                if d * float(np.abs(whole).max()) ** 2 < 2.0**62:
                    far = pa.array(np.square(whole).sum(axis=1))
                else:
                    far = pa.array([s if s < 2**63 else None for s in (sum(int(e) ** 2 for e in row) for row in whole)], pa.int64())
                at = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    keys.values.take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, centre.n)),
                    far.take(at),
                    pa.array((centre.centred(x) @ onto).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(score, schema)
