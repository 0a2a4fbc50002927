"""License scan, exact dedup, decontamination and line dedup on awkward rows, against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

import brute
from claimlens.llm import decontaminate, exact_dedup, licenses, line_dedup
from claimlens.session import stage

ITEMS = [
    (1, "two THREE four, five six seven eight nine ten eleven twelve"),
    (2, "own line"),
    (2, "own line"),
    (3, None),
    (4, "!!!"),
    (None, "head"),
]


def _benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("anchor", F.lit(1))


def test_license_places(odd, no_docs):
    found = licenses.scan(odd).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in found}
    row = by_id[6]
    assert (row["n_base"], row["first_word"], row["base_labels"]) == (3, 3, "gpl,mit")
    words = brute.words(odd.where("doc_id = 6").first()["text"])
    places = [i for i in range(len(words)) if words[i : i + 2] in (["mit", "license"], ["apache", "license"])]
    places += [i for i in range(len(words)) if words[i : i + 3] == ["general", "public", "license"]]
    assert row["last_word"] == max(places) and row["n_base"] == len(places)
    assert by_id[1]["n_words"] == 0 and by_id[1]["first_word"] is None and by_id[1]["labels"] == ""
    assert 0 <= min(r["score"] for r in found) and max(r["score"] for r in found) <= 1
    assert licenses.scan(no_docs).count() == 0


def test_license_templates_by_containment(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of THIS thing"
    shuffled = "x y license general and then public, license; mit licenses"
    docs = spark.createDataFrame([(1, notice), (2, "the of and to a " * 50), (3, shuffled)], "doc_id long, text string")
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert labels == {1: "mit-notice", 2: "", 3: ""}


def test_exact_groups(odd, no_docs):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == odd.count()
    groups = defaultdict(list)
    for r in odd.select("doc_id", "text").collect():
        groups[brute.sha(brute.lowered(r["text"]))].append(r["doc_id"])
    for r in rows:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert kept == Counter(groups.keys())
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_drop_copies_leaves_one_row_of_a_text(odd, no_docs):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    texts = Counter(brute.lowered(r["text"]) for r in left.collect())
    assert set(texts.values()) == {1}
    assert set(texts) == {brute.lowered(r["text"]) for r in odd.select("text").collect()}
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_runs_merge_alike_in_any_number_of_rounds(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"))
    for parts in (1, 2, 40):
        rows = exact_dedup.exact_groups(docs.repartition(parts)).where("kept").collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(2993, 3000))


def test_contamination(spark, odd, no_docs):
    rows = decontaminate.contamination(odd, _benchmark(spark)).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect())
    assert len(rows) == sum(texts.values())
    tests = [(i, w) for i, t in ITEMS for w in brute.windows(t)]
    want = Counter()
    for (doc, text), n in texts.items():
        w, hit, items = brute.words(text), set(), set()
        for item, window in tests:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    items.add("" if item is None else str(item))
        want[(doc, len(w), len(hit), tuple(sorted(items)))] += n
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows) == want


def test_blocks_of_a_large_benchmark_and_no_benchmark(spark, odd, no_docs):
    def facts(**kw):
        rows = decontaminate.contamination(odd, _benchmark(spark, kw.pop("items", ITEMS)), **kw).collect()
        return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)

    assert facts(block=1) == facts()
    assert {hit for _, _, hit, _ in facts(items=[(3, None)])} == {0}
    assert decontaminate.contamination(no_docs, _benchmark(spark)).count() == 0


def test_blocks_are_bounded_when_items_share_an_opening(spark, monkeypatch):
    opening = "in the year of the great flood the old miller"
    items = [(n, f"{opening} said number{n}") for n in range(60)]
    docs = spark.createDataFrame([(n, f"x{n} {text}") for n, text in items[:3]] + [(9, opening)], "doc_id long, text string")
    blocks = []

    def scan(docs, windows, leads, whole=decontaminate._scan):
        blocks.append((windows.count(), set(windows.columns)))
        return whole(docs, windows, leads)

    monkeypatch.setattr(decontaminate, "_scan", scan)
    rows = decontaminate.contamination(docs, _benchmark(spark, items), block=20).collect()
    everyone = sorted(str(n) for n, _ in items)
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in rows} == {n: (12, everyone) for n in range(3)} | {9: (10, everyone)}
    # Two windows that all items share, and one of each item, all of these with the same first words.
    assert sum(n for n, _ in blocks) == 62 and max(n for n, _ in blocks) < 40
    assert all("items" not in columns and "item" not in columns for _, columns in blocks)


def test_removal_of_documents_and_spans(spark, odd):
    bench = _benchmark(spark, ITEMS[:1])
    left = decontaminate.decontaminate(odd, bench)
    assert left.columns == odd.columns
    gone = {r["doc_id"] for r in odd.collect()} - {r["doc_id"] for r in left.collect()}
    assert gone == {4, 5, None}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(odd, bench, remove="spans").collect()}
    assert cut[4] == "One thirteen fourteen fifteen sixteen" and cut[3] == " \t\n " and cut[1] is None


def test_line_dedup(odd, no_docs):
    got = line_dedup.dedup_lines(odd)
    rows = [(r["doc_id"], r["_n_lines"], r["_n_dropped"], r["text"]) for r in got.collect()]
    assert got.where("n_lines = 'extra n_lines' AND n_dropped = 'extra n_dropped' AND keep_bits = 'extra keep_bits'").count() == odd.count()
    blank = " \t\n\x0b\x0c\r"
    docs = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    holders = defaultdict(set)
    for doc, text in docs:
        for line in text.split("\n"):
            if doc is not None and len(line.strip(blank)) >= 40:
                holders[brute.lowered(line.strip(blank))].add(doc)
    want = []
    for doc, text in docs:
        lines = text.split("\n")
        keys = [brute.lowered(line.strip(blank)) for line in lines]
        gone = [doc is not None and len(holders[k]) >= 5 and doc < max(holders[k]) for k in keys]
        want.append((doc, len(lines), sum(gone), "\n".join(line for line, g in zip(lines, gone) if not g)))
    assert Counter(rows) == Counter(want)
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_a_line_in_every_document_is_dealt_over_many_tasks(spark):
    line = "a line that stands in every single document of the table"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(line).alias("text"))
    rows = line_dedup.dedup_lines(docs).where("n_dropped = 0").collect()
    assert [r["doc_id"] for r in rows] == [3999]


def test_occurrences_are_sorted_and_streamed(spark, monkeypatch):
    """The plan sorts ranges and runs a window over them without another exchange; keys span slices and ranges."""
    monkeypatch.setattr(line_dedup, "SLICE_ROWS", 16)
    lines = [f"line number {n % 7} that several documents of the table share" for n in range(600)]
    docs = spark.createDataFrame([(n // 3, "\n".join([lines[n], lines[n], f"own {n}"])) for n in range(600)], "doc_id long, text string")
    runs = stage(line_dedup.occurrences(docs), "runs")
    plan = line_dedup.repeated_keys(runs)
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Window") :]
    assert below.index("Sort") < below.index("rangepartitioning") and "hashpartitioning" not in below[: below.index("rangepartitioning")]
    last = {lines[n]: max(m // 3 for m in range(n % 7, 600, 7)) for n in range(7)}
    assert sorted(r["last_doc"] for r in plan.collect()) == sorted(last.values())
    got = line_dedup.dedup_lines(docs).agg(F.sum("n_dropped")).first()[0]
    assert got == sum(2 for n in range(600) if n // 3 < last[lines[n]])
