"""The pipeline against a brute-force version of each stage on the stage's own input."""

from __future__ import annotations

import brute
import corpus_pipeline as C
from claimlens.llm import quality
from claimlens.llm.common import learn_row, table
from claimlens.session import stage


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    columns, inputs = docs.columns, {}
    for name, apply in C.STAGES:
        inputs[name] = [(r["doc_id"], r["text"]) for r in docs.collect()] if "text" in docs.columns else None
        docs = stage(apply(spark, docs, small), name)
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
        inputs[name, "out"] = sorted(r["doc_id"] for r in docs.select("doc_id").distinct().collect())

    documents = table(spark, small, "documents")
    labels = table(spark, small, "labels").where(learn_row("doc_id"))
    model = quality.fit(quality.document_statistics(documents), labels)
    good = [d for d, t in inputs["quality_classifier"] if model.score(quality.statistics_of(t)[None])[0] >= 0.5]
    assert sorted(good) == inputs["quality_classifier", "out"]

    last = {}
    for d, t in inputs["exact_dedup"]:
        last[brute.lowered(t)] = max(d, last.get(brute.lowered(t), d))
    assert sorted(last.values()) == inputs["exact_dedup", "out"]

    component = brute.link_components({d: brute.shingles(t) for d, t in inputs["ngram_jaccard_join"]})
    assert sorted(set(component.values())) == inputs["ngram_jaccard_join", "out"]

    items = [r["text"] for r in table(spark, small, "benchmark").collect()]
    clean = [d for d, t in inputs["benchmark_decontamination"] if not brute.contaminated(t, items)]
    assert sorted(clean) == inputs["benchmark_decontamination", "out"]
    assert sorted(clean) == inputs["best_fit_packing", "out"]


def test_stages_on_awkward_rows(spark, odd, no_docs, small):
    for rows in (odd, no_docs):
        docs = rows
        for name, apply in C.STAGES:
            docs = stage(apply(spark, docs, small), name)
            if name != C.STAGES[-1][0]:
                assert docs.columns == rows.columns
        assert docs.where("length > 2048").isEmpty()
