"""Language identification as inference of a multilingual mixture.

Every document is a mixture of languages: each of its letter trigrams is drawn from one of them.  Expectation
maximisation estimates the proportions from the trigram likelihoods of the learnt languages; languages are then taken
out while that raises the penalised log likelihood.  The language with the largest proportion is the prediction.

Trigram counts per language are summed by Spark over all labelled rows that may be learnt from, so that every language
among them is known, however rare; the table reaching the driver has ``BINS`` entries per language.  Whole texts are
read, in pieces of ``PIECE`` characters, so memory does not grow with a text.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing could be
learnt; rows are judged one by one, repeated or not; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import learn_row

BINS = 1 << 15
PIECE = 1 << 20
ROUNDS = 12
SETTLED = 1e-3
UNKNOWN = "und"

_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts of the trigrams of a text, read as lower-case words between single spaces."""
    counts = np.zeros(BINS, np.int64)
    text = text or ""
    for at in range(0, len(text), PIECE):
        piece = text[max(0, at - 2) : at + PIECE].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        letter = _LETTER[codes]
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first gap after a word
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
        mixed = codes[:-2] * _FACTORS[0] + codes[1:-1] * _FACTORS[1] + codes[2:] * _FACTORS[2]
        mixed = mixed[codes[1:-1] != 32]
        counts += np.bincount(((mixed ^ mixed >> 29) * _FACTORS[0] >> np.uint64(49)).astype(np.int64), minlength=BINS)
    bins = np.flatnonzero(counts)
    return bins, counts[bins]


@dataclass(frozen=True)
class Languages:
    names: list[str]
    log_p: np.ndarray  # languages x bins


def learn(docs: DataFrame) -> Languages:
    """Smoothed trigram distributions of every language among the rows that may be learnt from."""
    rows = docs.where(F.col("lang").isNotNull() & learn_row("doc_id")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                bins, counts = trigram_counts(text.as_py())
                sums.setdefault(lang.as_py(), np.zeros(BINS, np.int64))[bins] += counts
        for lang, counts in sums.items():
            bins = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins), pa.string()), pa.array(bins.astype(np.int32)), pa.array(counts[bins])],
                names=["lang", "bin", "n"],
            )

    summed = rows.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    per_lang = summed.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("cells")).collect()
    names = sorted(row["lang"] for row in per_lang)
    counts = np.zeros((len(names), BINS))
    for row in per_lang:
        for b, n in row["cells"]:
            counts[names.index(row["lang"]), b] = n
    counts += 0.1 + 1e-6 * counts.sum(1, keepdims=True) / BINS
    return Languages(names, np.log(counts / counts.sum(1, keepdims=True)) if names else counts)


def mixture(weights: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation maximisation and their log likelihood; ``likelihood``: languages x trigrams."""
    total = weights.sum()
    share = np.full(len(likelihood), 1 / len(likelihood))
    for _ in range(ROUNDS if len(share) > 1 else 0):
        joint = share[:, None] * likelihood
        new = (joint / joint.sum(0)) @ weights / total
        settled = np.abs(new - share).max() < SETTLED
        share = new
        if settled:
            break
    return share, float(np.log(share @ likelihood) @ weights)


def language_set(bins: np.ndarray, weights: np.ndarray, model: Languages) -> list[tuple[str, float]]:
    """Languages of a document with their proportions, largest first, after penalised selection."""
    log_p = model.log_p[:, bins]
    best = log_p.max(0)
    likelihood = np.exp(log_p - best)
    chosen = np.arange(len(model.names))
    price = 0.5 * np.log(weights.sum() + 1) + 1
    share, fit = mixture(weights, likelihood)
    while len(chosen) > 1:
        # Languages of next to no share go together, else the smallest one is put to the test.
        stays = share > 0.01
        if stays.all():
            stays = np.arange(len(chosen)) != share.argmin()
        fewer, fewer_fit = mixture(weights, likelihood[stays])
        if fewer_fit + price * (~stays).sum() < fit:
            break
        chosen, likelihood, share, fit = chosen[stays], likelihood[stays], fewer, fewer_fit
    order = np.argsort(-share, kind="stable")
    return [(model.names[chosen[i]], float(share[i])) for i in order]


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row; score is the share of the predicted language."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                bins, weights = trigram_counts(text.as_py()) if model.names else ((), ())
                found.append(language_set(bins, weights, model) if len(bins) else [(UNKNOWN, 0.0)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0][0] for f in found], pa.string()),
                    pa.array([min(1.0, f[0][1]) for f in found], pa.float64()),
                    pa.array([",".join(f"{name}:{share:.3f}" for name, share in f) for f in found], pa.string()),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        per_batch, f"doc_id {kind}, lang_pred string, score double, languages string"
    )


def predict(docs: DataFrame) -> DataFrame:
    return identify(docs, learn(docs)).withColumn("held_out", ~learn_row("doc_id"))
