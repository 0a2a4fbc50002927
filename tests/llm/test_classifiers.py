"""Toxicity, language and quality: held-out accuracy and awkward rows."""

from __future__ import annotations

import numpy as np
import pytest

from claimlens.llm import langid, quality, toxicity
from claimlens.llm.common import table
from claimlens.llm.queries import QUERIES


def _auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("name, label, floor", [("op4_toxicity", "toxic", 0.6), ("op9_quality", "quality", 0.98)])
def test_held_out_auc(spark, larger, name, label, floor):
    rows = QUERIES[name](spark, larger).join(table(spark, larger, "labels"), "doc_id").where("held_out").toPandas()
    assert _auc(rows["score"].to_numpy(), rows[label].to_numpy()) > floor
    assert rows["score"].between(0, 1).all()
    threshold = 0.7 if label == "toxic" else 0.5
    assert ((rows["score"] >= threshold) == (rows["predicted"] == 1)).all()


def test_language_accuracy(spark, larger):
    found = QUERIES["op5_language_id"](spark, larger)
    docs = table(spark, larger, "documents").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").toPandas()
    assert (rows["lang_pred"] == rows["lang"]).mean() > 0.98


def test_mixture_finds_both_languages(spark, larger):
    model = langid.learn(table(spark, larger, "documents"))
    texts = {r["lang"]: r["text"] for r in table(spark, larger, "documents").where("n_chars > 2000").collect()}
    mixed = texts["en"][:1500] + "\n" + texts["de"][:1500]
    names = dict(langid.language_set(*langid.trigram_counts(mixed), model))
    assert set(names) == {"en", "de"} and 0.3 < names["en"] < 0.7


def test_rare_language_is_learnt(spark):
    common = "'the weather was fine and the people of the town went out'"
    rare = "'zq xvyk wjzq kxv qyzw vkjx zzq wyx qkv'"
    docs = spark.range(200_000).selectExpr(
        "id AS doc_id", "if(id % 40000 = 0, 'zz', 'en') AS lang", f"if(id % 40000 = 0, {rare}, {common}) AS text"
    )
    model = langid.learn(docs)
    assert model.names == ["en", "zz"]
    found = {r["lang_pred"] for r in langid.identify(docs.where("lang = 'zz'"), model).collect()}
    assert found == {"zz"}


def test_pieces_do_not_change_counts():
    text = "Ein Satz, ÄÖÜ und noch einer 12 34. " * 50
    whole = langid.trigram_counts(text)
    piece, langid.PIECE = langid.PIECE, 64
    try:
        bins, counts = langid.trigram_counts(text)
    finally:
        langid.PIECE = piece
    assert set(whole[0]) <= set(bins) and abs(counts.sum() - whole[1].sum()) < len(text) / 16


def test_symbols_beyond_16_bits_are_no_letters(spark):
    docs = spark.createDataFrame(
        [(n, "en", f"plain words of text {n}") for n in range(20)]
        + [(100, "en", "\U0001F600\U0001F680"), (101, "en", "\U0001D7D8 \U0001F3B5"), (102, "en", "\U00010330\U00010331")],
        "doc_id long, lang string, text string",
    )
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs).where("doc_id >= 100").collect()}
    assert found[100] == found[101] == ("und", 0.0)  # emoji; a digit and a note
    assert found[102] == ("en", 1.0)  # Gothic letters
    assert len(langid.trigram_counts("\U00010330\U00010331")[0]) == 2


def test_awkward_rows(spark, odd, no_docs, small):
    labels = table(spark, small, "labels")
    for docs in (odd, no_docs):
        n = docs.count()
        assert toxicity.toxicity_scores(docs, labels).count() == n
        assert quality.quality_scores(docs, labels).count() == n
        assert langid.predict(docs).count() == n
    unknown = {r["doc_id"] for r in langid.predict(odd).where("lang_pred = 'und'").collect()}
    assert unknown == {1, 2, 3}
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert quality.keep_good(no_docs, labels).count() == 0


def test_without_labels(spark, odd):
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.quality_scores(odd, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.toxicity_scores(odd, none).collect()} == {0.0}
    unlearnt = odd.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.predict(unlearnt).collect()} == {"und"}


def test_windows_cover_the_whole_text():
    windows = toxicity.windows_of("Ab cd ab " + "z" * 70)
    assert windows == {"ab": 2, "cd": 1, "z" * 32: 2, "z" * 6: 1}
    assert toxicity.windows_of(None) == {"": 1}
