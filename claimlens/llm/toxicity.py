"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A window is a word (a long one in pieces), written three times in a row so that even a short one is stored as matches
and not as it stands.  Both dictionaries compress it.  The ordinary dictionary is trained on windows of ordinary
documents; the toxic one on those windows of toxic documents that hold a letter sequence found in clearly more toxic
than ordinary documents, for most of a toxic document is ordinary text.  The pair of lengths, at a window's own
length, is compared with thresholds calibrated on how many documents of either label hold such a window.  A logistic
model turns the number, share and strength of the windows beyond the thresholds into a probability.

Learning uses a sample of stated size (``SAMPLE`` documents per label, drawn by a hash of the id, none above
``LONGEST`` characters); scoring reads whole texts, one at a time.

Defined results: null and empty texts have one empty window; labels other than 0 and 1 teach nothing; with a label
missing every score is the share of label 1 (0 without labels); rows are scored one by one, repeated or not; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import learn_row

SAMPLE = {0: 3000, 1: 1000}
LONGEST = 50_000
GRAM = 6  # letters of the sequences that tell toxic windows
SUPPORT = 4  # toxic documents that hold such a sequence, at least
# Signed root of the likelihood ratio from which a sequence tells toxic from ordinary documents: a number, and a share
# of what a sequence of all toxic and no ordinary documents would reach.
DISTINCT, DISTINCT_SHARE = 4.0, 0.12
ORDINARY_BYTES, TOXIC_BYTES = 8192, 2048  # sizes of the dictionaries
LEVEL = 3
CLEAR, STRONG = 4.0, 1.0  # the same for a pair of lengths, and its log odds, from which it counts as toxic
SEGMENT = 24  # bytes of the pieces that the toxic dictionary is put together from: about a word
PHRASE = 8  # words of the training windows of ordinary text
PIECE = 32
CACHED = 300_000  # windows a task remembers


def windows_of(text: str | None) -> Counter[str]:
    words = Counter((text or "").lower().split())
    if any(len(w) > PIECE for w in words):
        pieces: Counter[str] = Counter()
        for word, n in words.items():
            for at in range(0, len(word), PIECE):
                pieces[word[at : at + PIECE]] += n
        words = pieces
    return words or Counter([""])


def _grams(window: str) -> set[str]:
    spaced = f" {window} "
    return {spaced[i : i + GRAM] for i in range(max(1, len(spaced) - GRAM + 1))}


def _odds(held: int, of: int, other: int, of_other: int) -> tuple[float, float]:
    """Smoothed log odds of two document shares, and the signed root of their likelihood-ratio statistic."""
    odds = math.log((held + 0.25) / (of + 0.5) * (of_other + 0.5) / (other + 0.25 * of_other / of))
    both = (held + other) / (of + of_other)
    gain = 0.0
    for n, size in ((held, of), (other, of_other)):
        for part, expected in ((n, size * both), (size - n, size * (1 - both))):
            gain += part * math.log(part / expected) if part else 0.0
    return odds, math.copysign(math.sqrt(max(0.0, 2 * gain)), odds)


def _train(size: int, windows: list[str], **cover: int) -> bytes:
    samples = [f" {w} ".encode("utf-8", "replace") for w in windows if w]
    if sum(map(len, samples)) < 8 * size:
        samples *= math.ceil(8 * size / max(1, sum(map(len, samples))))
    try:
        return zstandard.train_dictionary(size, samples, **cover).as_bytes()
    except zstandard.ZstdError:  # too few different windows to train on
        return b"".join(dict.fromkeys(samples))[-size:] or b" "


class Lengths:
    """Compressed lengths of a window under both dictionaries, remembered up to a stated number of windows."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.compressors = []
        for content in (ordinary, toxic):
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        self.known: dict[str, tuple[int, int, int]] = {}

    def __call__(self, window: str) -> tuple[int, int, int]:
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            raw = (f" {window}" * 3 + " ").encode("utf-8", "replace")
            a, b = (len(c.compress(raw)) for c in self.compressors)
            found = self.known[window] = (len(raw), a, b)
        return found


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    odds: dict[tuple[int, int, int], tuple[float, float]]  # lengths -> log odds, root ratio
    weights: np.ndarray
    share: float

    def features(self, windows: Counter[str], lengths: Lengths) -> list[float]:
        beyond, strongest, total = 0, 0.0, 0
        for window, n in windows.items():
            total += n
            odds, clear = self.odds.get(lengths(window), (0.0, 0.0))
            if clear >= CLEAR and odds >= STRONG:
                beyond += n
                strongest = max(strongest, odds)
        return [1.0, strongest, math.log1p(beyond), math.log1p(100 * beyond / (total + 20)), math.log1p(total)]

    def score(self, features: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -60, 60)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 0.5
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """``labels`` (doc_id, label): rows that may be learnt from."""
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    counts = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    drawn = [
        known.where("y = %d" % y).where(
            F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, size / counts[y]) * (1 << 30))
        )
        for y, size in SAMPLE.items()
        if y in counts
    ]
    if len(drawn) < 2:
        return Model(b"", b"", {}, np.empty(0), share)
    chosen = drawn[0].unionByName(drawn[1])
    texts = docs.where(F.char_length("text") <= LONGEST).select("doc_id", "text").join(chosen, "doc_id")
    return fit([(r["y"], r["text"]) for r in texts.select("y", "text").orderBy("doc_id", "text").collect()], share)


def fit(sample: list[tuple[int, str]], share: float) -> Model:
    """Dictionaries, thresholds and weights from a sample of (label, text); ``share``: of label 1 among all labels."""
    rows = [(y, windows_of(text)) for y, text in sample]
    sizes = Counter(y for y, _ in rows)
    if len(sizes) < 2:
        return Model(b"", b"", {}, np.empty(0), share)

    held: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
    for y, windows in rows:
        if y == 1:
            held[1].update(set().union(*map(_grams, windows)))
    often = {g for g, n in held[1].items() if n >= SUPPORT}
    for y, windows in rows:
        if y == 0:
            held[0].update(set().union(*map(_grams, windows)) & often)
    distinct = max(DISTINCT, DISTINCT_SHARE * _odds(sizes[1], sizes[1], 0, sizes[0])[1])
    marked = {g for g in often if _odds(held[1][g], sizes[1], held[0][g], sizes[0])[1] > distinct}
    toxic = [w for y, windows in rows if y == 1 for w, n in windows.items() if _grams(w) & marked for _ in range(n)]
    ordinary = []
    for words in (text.lower().split() for y, text in sample if y == 0 and text):
        ordinary += [" ".join(words[at : at + PHRASE]) for at in range(0, len(words), PHRASE)]
    model = Model(
        _train(ORDINARY_BYTES, ordinary), _train(TOXIC_BYTES, toxic or ordinary, k=SEGMENT, d=6), {}, np.empty(0), share
    )

    lengths = Lengths(model.ordinary, model.toxic)
    cells: dict[int, Counter[tuple[int, int, int]]] = {0: Counter(), 1: Counter()}
    for y, windows in rows:
        cells[y].update({lengths(w) for w in windows})
    odds = {c: _odds(n, sizes[1], cells[0][c], sizes[0]) for c, n in cells[1].items()}
    model = Model(model.ordinary, model.toxic, odds, model.weights, share)
    x = np.array([model.features(windows, lengths) for _, windows in rows])
    y = np.array([y for y, _ in rows])
    weight = np.where(y == 1, share / sizes[1], (1 - share) / sizes[0]) * len(y)  # as common as among all labels
    return Model(model.ordinary, model.toxic, odds, _logistic(x, y, weight), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(model.ordinary, model.toxic) if len(model.weights) else None
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            x = [model.features(windows_of(t), lengths) if lengths else [1.0] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(np.array(x).reshape(batch.num_rows, -1)))],
                names=["doc_id", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        per_batch, f"doc_id {kind}, score double"
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learnt from the rows that are not held out."""
    model = learn(docs, labels.where(learn_row("doc_id")))
    return score(docs, model).select(
        "doc_id",
        (~learn_row("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
