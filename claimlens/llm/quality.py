"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Statistics are taken once per document inside Arrow batches and written to the shared folder.  Per class, count, sum
and cross products of the statistics are summed by Spark over all labelled learning rows (a few hundred numbers reach
the driver), giving a mean and a covariance that is shrunk towards the pooled covariance and its diagonal.  Each
covariance is factored once (Cholesky); scoring whitens with the cached inverse factors, takes the Mahalanobis
distances and turns the difference of log densities into a probability.

Defined results: null and empty texts have the statistics of an empty text; labels other than 0 and 1 and rows
without a label teach nothing; with a class missing every score is the share of class 1 (0.5 without labels); rows
are scored one by one, repeated or not; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import learn_row
from claimlens.session import stage

SHRINK_POOLED = 0.5  # weight of the pooled covariance in a class covariance
SHRINK_DIAGONAL = 0.1  # weight of the diagonal in the result
RIDGE = 1e-3
TEMPERATURE = 4.0  # statistics are not Gaussian, so log-density differences are tempered

STATISTICS = (
    "log_bytes", "log_words", "word_length", "letters", "capitals", "digits", "spaces", "stops", "marks", "pipes",
    "distinct_words", "common_word", "short_words", "line_length", "distinct_lines", "bytes_entropy",
)


def _byte_classes() -> np.ndarray:
    """Which of the 256 byte values count as letter, capital, digit, space, full stop or comma, mark, pipe."""
    kinds = np.zeros((256, 7))
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalpha():
            kinds[b, 0] = 1
        if b < 128 and c.isupper():
            kinds[b, 1] = 1
        if b < 128 and c.isdigit():
            kinds[b, 2] = 1
        if b < 128 and c.isspace():
            kinds[b, 3] = 1
        if c in ".,;:'\"-()?":
            kinds[b, 4] = 1
        if 32 < b < 127 and not c.isalnum() and c not in ".,;:'\"-()?|":
            kinds[b, 5] = 1
        if c == "|":
            kinds[b, 6] = 1
    return kinds


KINDS = _byte_classes()


def statistics_of(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text, in the order of ``STATISTICS``."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = int(counts.sum())
    letters, capitals, digits, spaces, stops, marks, pipes = counts @ KINDS
    words = text.split()
    n = len(words)
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = text.split("\n")
    share = counts[counts > 0] / max(size, 1)
    bytes_in = size + 1.0
    root = np.sqrt
    return np.array(
        [
            np.log1p(size),
            np.log1p(n),
            np.log1p((size - spaces) / max(n, 1)),
            root(letters / bytes_in),
            root(capitals / (letters + 1)),
            root(digits / bytes_in),
            root(spaces / bytes_in),
            root(stops / bytes_in),
            root(marks / bytes_in),
            root(pipes / bytes_in),
            root(len(tally) / (n + 1)),
            root(max(tally.values(), default=0) / (n + 1)),
            root(sum(c for w, c in tally.items() if len(w) <= 3) / (n + 1)),
            np.log1p(size / len(lines)),
            root(len(set(lines)) / len(lines)),
            -float((share * np.log(share)).sum()),
        ]
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row, written once."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics_of(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        per_batch, f"doc_id {kind}, x array<double>"
    )
    return stage(found, "document-statistics")


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors of the class covariances, and the constant of the score."""

    means: np.ndarray
    factors: np.ndarray
    constant: float
    known: bool

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.full(len(x), self.constant)
        z = np.einsum("cij,cnj->cni", self.factors, x[None] - self.means[:, None])
        distance = (z**2).sum(-1)
        gap = (self.constant + 0.5 * (distance[0] - distance[1])) / TEMPERATURE
        return 1 / (1 + np.exp(-np.clip(gap, -60, 60)))


def class_moments(labelled: DataFrame) -> dict[int, np.ndarray]:
    """Per class the cross products of (1, x), summed by Spark over all labelled rows."""
    size = len(STATISTICS) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: np.zeros((size, size)), 1: np.zeros((size, size))}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").to_pylist())
            x = np.hstack([np.ones((len(x), 1)), x])
            y = batch.column("label").to_numpy()
            for c in sums:
                sums[c] += x[y == c].T @ x[y == c]
        for c, m in sums.items():
            if m[0, 0]:
                cells = pa.array(np.arange(size * size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * (size * size), pa.int32()), cells, pa.array(m.ravel())], names=["label", "cell", "v"]
                )

    summed = labelled.mapInArrow(partial, "label int, cell int, v double").groupBy("label", "cell").agg(F.sum("v").alias("v"))
    out = {0: np.zeros(size * size), 1: np.zeros(size * size)}
    for row in summed.collect():
        out[row["label"]][row["cell"]] = row["v"]
    return {c: m.reshape(size, size) for c, m in out.items()}


def fit(statistics: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """``labels`` (doc_id, label): rows that may be learnt from."""
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    moments = class_moments(statistics.join(known, "doc_id").select("x", "label"))
    counts = np.array([moments[c][0, 0] for c in (0, 1)])
    size = len(STATISTICS)
    if counts.min() < 2:
        share = counts[1] / counts.sum() if counts.sum() else 0.5
        return Discriminant(np.zeros((2, size)), np.zeros((2, size, size)), float(share), False)
    means = np.array([moments[c][0, 1:] / counts[c] for c in (0, 1)])
    scatter = np.array([moments[c][1:, 1:] - counts[c] * np.outer(means[c], means[c]) for c in (0, 1)])
    pooled = scatter.sum(0) / counts.sum()
    scale = np.diag(np.diag(pooled)) + RIDGE * np.eye(size)
    covariances = [
        (1 - SHRINK_DIAGONAL) * ((1 - SHRINK_POOLED) * scatter[c] / counts[c] + SHRINK_POOLED * pooled)
        + SHRINK_DIAGONAL * scale
        for c in (0, 1)
    ]
    roots = [np.linalg.cholesky(v) for v in covariances]
    logdet = [2 * np.log(np.diag(r)).sum() for r in roots]
    constant = float(np.log(counts[1] / counts[0]) - 0.5 * (logdet[1] - logdet[0]))
    return Discriminant(means, np.array([np.linalg.inv(r) for r in roots]), constant, True)


def score(statistics: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every row of ``statistics``."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    kind = statistics.schema["doc_id"].dataType.simpleString()
    return statistics.mapInArrow(per_batch, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, learnt from the rows that are not held out."""
    statistics = document_statistics(docs)
    model = fit(statistics, labels.where(learn_row("doc_id")))
    return score(statistics, model).select(
        "doc_id",
        (~learn_row("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows predicted good, with all their columns; texts are scored in the scan and never shuffled."""
    model = fit(document_statistics(docs), labels.where(learn_row("doc_id")))

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics_of(t.as_py()) for t in batch.column("text")]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(good, docs.schema)
