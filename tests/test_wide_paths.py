"""Factors, dictionaries, k-means of several starts, merged states and keyed tables against plain versions."""

from __future__ import annotations

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import dictionary, factors, fraud, joins
from claimlens.operators.claim_states import ClaimStates
from claimlens.session import new_stage_path, stage, stage_dir
from claimlens.sources.keyed import KeyedTable


def test_factors_equal_exact_svd(spark, monkeypatch):
    """A hot item that a third of all ratings are for, clear gaps between singular values, items scored in blocks."""
    rng = np.random.default_rng(6)
    a = (rng.standard_normal((60, 4)) * [9, 6, 4, 2]) @ rng.standard_normal((4, 25)) + 0.01 * rng.standard_normal((60, 25))
    a[rng.random(a.shape) < 0.5] = 0.0
    a[:, 3] = rng.standard_normal(60) * 3
    rows = [(f"m{m:02d}", f"i{i:02d}", float(x)) for (m, i), x in np.ndenumerate(a) if x]
    rows += [("m00", "i00", 0.5), (None, "i01", 1.0), ("m01", None, 1.0)]
    a[0, 0] += 0.5
    ratings = spark.createDataFrame(rows, "member string, item string, rating double").repartition(4)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 20)
    model = factors.fit_factors(ratings, n_factors=3, iterations=8)
    _, values, right = np.linalg.svd(a)
    assert model.values == pytest.approx(values[:3], rel=1e-6)
    got = {r["item"]: r["vec"] for r in model.items.collect()}
    v = np.array([got[f"i{i:02d}"] for i in range(25)])
    assert np.abs(v @ v.T - right[:3].T @ right[:3]).max() < 1e-4
    best = factors.recommend_items(model, ratings, 4, block=7).collect()
    wanted = a @ v @ v.T
    for m in range(60):
        mine = sorted((r for r in best if r["member"] == f"m{m:02d}"), key=lambda r: r["rank"])
        assert [r["score"] for r in mine] == pytest.approx(sorted(wanted[m], reverse=True)[:4], abs=1e-6)
        assert [r["score"] for r in mine] == pytest.approx([wanted[m, int(r["item"][1:])] for r in mine], abs=1e-6)


def test_products_in_rectangles_send_a_vector_once_per_block(spark, monkeypatch):
    """Three by four blocks, a hot item, a member without name, an item the model does not know."""
    monkeypatch.setattr(factors, "SIDE", 10)
    rng = np.random.default_rng(2)
    cells = [(m, i, float(rng.integers(1, 9))) for m in range(30) for i in range(40) if i == 3 or rng.random() < 0.3]
    named = [(None if m == 7 else 2**60 + m, i, r) for m, i, r in cells]
    ratings = stage(spark.createDataFrame(named, "member long, item long, rating double").repartition(3), "ratings")
    vectors = {i: rng.standard_normal(5) for i in range(39)}
    items = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item long, vec array<double>")
    cut = factors._Ratings.of(ratings)
    assert min(cut.blocks.values()) > 1
    assert cut.sent["item"].select(F.explode("blocks")).count() <= 40 * cut.blocks["member"] < len(cells)
    got = {r["member"]: r["vec"] for r in factors.FactorModel(items, []).coordinates(ratings).collect()}
    for m in range(30):
        want = sum(r * vectors[i] for n, i, r in cells if n == m and i in vectors)
        assert got[None if m == 7 else 2**60 + m] == pytest.approx(want)


def _kept_files(spark):
    """Folders of staged tables, and shuffle files on this machine."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().toSeq()
    names = [files.apply(i).getName() for i in range(files.size())]
    return set(os.listdir(stage_dir(spark).removeprefix("file:"))), {n for n in names if n.startswith("shuffle")}


def _soon(condition, seconds=20):
    until = time.time() + seconds
    while not (met := condition()) and time.time() < until:
        time.sleep(0.2)
    return met


def test_factors_leave_only_their_result_on_disk(spark, monkeypatch):
    """Products in panels of two columns; of all tables and shuffles on the way nothing stays."""
    monkeypatch.setattr(factors, "SIDE", 20)
    monkeypatch.setattr(factors, "PANEL", 50)
    rng = np.random.default_rng(4)
    a = (rng.standard_normal((50, 4)) * [9, 6, 4, 2]) @ rng.standard_normal((4, 30)) + 0.01 * rng.standard_normal((50, 30))
    rows = [(f"m{m:02d}", f"i{i:02d}", float(x)) for (m, i), x in np.ndenumerate(a)]
    ratings = stage(spark.createDataFrame(rows, "member string, item string, rating double").repartition(4), "given")
    tables, shuffles = _kept_files(spark)
    model = factors.fit_factors(ratings, n_factors=4)
    best = factors.recommend_items(model, ratings, 2, block=8)
    left = lambda: [now - before for now, before in zip(_kept_files(spark), (tables, shuffles))]
    assert sorted(t.split("-")[0] for t in left()[0]) == ["factors", "recommended"]
    assert _soon(lambda: not left()[1])
    _, values, right = np.linalg.svd(a)
    assert model.values == pytest.approx(values[:4], rel=1e-6)
    v = {r["item"]: r["vec"] for r in model.items.collect()}
    v = np.array([v[f"i{i:02d}"] for i in range(30)])
    assert np.abs(v @ v.T - right[:4].T @ right[:4]).max() < 1e-4
    wanted = a @ v @ v.T
    assert [r["score"] for r in best.where("rank = 1").orderBy("member").collect()] == pytest.approx(wanted.max(axis=1).tolist(), abs=1e-6)


def test_items_out_of_reach_are_not_scored(spark, monkeypatch):
    """Half of the members have their best items in the first block; the short vectors of the others cannot pass these."""
    rng = np.random.default_rng(8)
    items = {f"i{i:02d}": rng.standard_normal(3) * (9.0 if i % 4 == 0 else 0.001) + (i % 4 == 0) * 5 for i in range(40)}
    rows = [(f"m{m:02d}", f"i{i:02d}", 1.0 + m) for m in range(20) for i in (0, 4, m)]
    ratings = spark.createDataFrame(rows, "member string, item string, rating double")
    model = factors.FactorModel(spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "item string, vec array<double>"), [1.0] * 3)
    asked = []

    def kept(df, name, whole=factors.stage):
        out = whole(df, name)
        if name == "asked-members":
            asked.append(out.count())
        return out

    monkeypatch.setattr(factors, "stage", kept)
    best = factors.recommend_items(model, ratings, 2, block=8).collect()
    own = {f"m{m:02d}": sum((1.0 + m) * items[f"i{i:02d}"] for i in (0, 4, m)) for m in range(20)}
    assert len(best) == 40 and 0 <= asked[-1] < 20
    for m, v in own.items():
        mine = sorted((r["rank"], r["score"], r["item"]) for r in best if r["member"] == m)
        assert [s for _, s, _ in mine] == pytest.approx(sorted((float(v @ x) for x in items.values()), reverse=True)[:2])
        assert all(s == pytest.approx(float(v @ items[i])) for _, s, i in mine)


def test_factors_of_small_and_empty_tables(spark):
    ratings = spark.createDataFrame([("a", "x", None), ("b", "x", 2.0)], "member string, item string, rating double")
    assert factors.fit_factors(ratings).values == []
    assert factors.fit_factors(ratings.limit(0)).values == []


def test_positions_and_codes(spark):
    rows = [(str(i * 7 % 1000), i) for i in range(1000)] + [(None, 0)] * 3 + [("5", 7)] * 500
    df = spark.createDataFrame(rows, "value string, n int").repartition(5)
    codes = dictionary.value_codes(df, "value")
    assert {r["value"]: r["code"] for r in codes.collect()} == {v: i for i, v in enumerate(sorted({r[0] for r in rows if r[0]}))}
    other = spark.createDataFrame([("5",), ("new",), (None,)], "value string")
    got = {r["value"]: r["c"] for r in dictionary.with_code(other, "value", codes, "c").collect()}
    assert got == {"5": sorted({r[0] for r in rows if r[0]}).index("5"), "new": 1000, None: None}
    assert dictionary.with_code(df, "value", codes, "c").count() == len(rows)


def test_ids_of_a_whole_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    rows = [(i, " ".join(["the"] * (i % 4) + [f"w{i}", "the", f"w{i % 7}"])) for i in range(60)] + [(60, None), (61, "")]
    df = spark.createDataFrame(rows, "id long, text string").withColumns({c: F.lit("own") for c in ("word", "pos", "_key")})
    vocabulary = dictionary.whole_vocabulary(df, "text")
    counts = {}
    for _, text in rows:
        for w in (text or "").split():
            counts[w] = counts.get(w, 0) + 1
    ids = {w: n + 2 for n, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)))}
    assert {r["word"]: r["word_id"] for r in vocabulary.collect()} == ids
    plain = df.drop("_key")
    whole = {r["id"]: r["token_ids"] for r in dictionary.encode_by_exchange(plain, vocabulary, "id", "text").collect()}
    assert whole == {i: [ids[w] for w in (t or "").split()] for i, t in rows}
    some = dictionary.encode_by_exchange(plain, vocabulary.where("word <> 'the'"), "id", "text", 3).collect()
    assert {r["id"]: r["token_ids"] for r in some} == {
        i: ([1 if w == "the" else ids[w] for w in (t or "").split()] + [0] * 3)[:3] for i, t in rows
    }


def test_whole_texts_send_their_words_once_per_chunk(spark, tmp_path, monkeypatch):
    """Before, every text sent each of its words; texts of the same key share their ids, texts without a key have none."""
    rows = [(i, f"the same words w{i % 3}") for i in range(400)] + [(None, "the words"), (7, "words again")]
    df = stage(spark.createDataFrame(rows, "id long, text string").repartition(3), "texts")
    vocabulary = stage(dictionary.whole_vocabulary(df, "text"), "vocabulary")
    ids = {r["word"]: r["word_id"] for r in vocabulary.collect()}
    sent = []

    def counted(left, *args):
        sent.append(left.count())
        return joins.skew_join(left, *args)

    monkeypatch.setattr(dictionary, "skew_join", counted)
    found = dictionary.encode_by_exchange(df, vocabulary, "id", "text").collect()
    # three chunks of seven words at most, and the five words of the key that two texts share
    assert sent[0] <= 3 * 7 and sent[1:] == [5]
    one = {r["id"]: r["token_ids"] for r in found if r["id"] not in (None, 7)}
    assert one == {i: [ids[w] for w in t.split()] for i, t in rows if i not in (None, 7)}
    both = sorted([*enumerate(ids[w] for w in rows[7][1].split()), *enumerate(ids[w] for w in ("words", "again"))])
    assert [r["token_ids"] for r in found if r["id"] == 7] == [[i for _, i in both]] * 2
    assert [r["token_ids"] for r in found if r["id"] is None] == [[]]


def test_starts_side_by_side_equal_single_runs(spark):
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (4, 0), (0, 4), (4, 4))] + [np.zeros((120, 2))])
    df = stage(spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double").repartition(3), "points")
    starts = fraud.draw_starts(df, ["x", "y"], 4, 3, seed=5)
    distinct = {tuple(p) for p in points}
    assert starts.shape == (3, 4, 2) and all(tuple(c) in distinct for s in starts for c in s)
    assert all(len({tuple(c) for c in s}) == 4 for s in starts)
    assert (fraud.draw_starts(df, ["x", "y"], 4, 3, seed=5) == starts).all()
    together, costs = fraud.lloyd(df, ["x", "y"], starts)
    for start, centres, cost in zip(starts, together, costs):
        alone, own = fraud.lloyd(df, ["x", "y"], start[None])
        assert alone[0] == pytest.approx(centres) and own[0] == pytest.approx(cost)
        near = np.square(points[:, None] - centres).sum(axis=2)
        assert cost == pytest.approx(near.min(axis=1).sum())
        for i, centre in enumerate(centres):  # centres are the means of their members
            assert centre == pytest.approx(points[near.argmin(axis=1) == i].mean(axis=0), abs=1e-3)


def test_clusters_of_fewer_rows_than_centres(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 1)], "x double, is_fraud int")
    model, profile = fraud.fit_clusters(df, ["x"], k=3, restarts=2)
    assert {tuple(c) for c in model.centres} <= {(1.0,), (2.0,)} and sum(r["size"] for r in profile.collect()) == 3


CLAIMS = [(f"c{i}", f"p{i % 5}" if i % 11 else None, f"m{i % 7}" if i % 13 else None, float(i) if i % 9 else None) for i in range(120)]


@pytest.mark.parametrize("approx", [False, True])
def test_states_of_batches_merge_to_the_whole(spark, approx):
    claims = spark.createDataFrame(CLAIMS, "claim_id string, provider_id string, member_id string, claim_amount double")
    states = ClaimStates(spark, new_stage_path(spark, "states"), approx)
    with pytest.raises(ValueError):
        states.provider_stats()
    number = F.substring("claim_id", 2, 9).cast("int")
    parts = {f"b{i}": claims.where(F.pmod(number, F.lit(4)) == i) for i in range(4)}
    states.add("b0", parts["b1"])  # a first try with other rows, replaced by the replay
    states.add("b0", parts["b0"])
    states.add("b1", parts["b1"])
    states.compact()
    states.add("b1", parts["b1"])  # folded already: left out
    states.add("b2", parts["b2"])
    states.compact()
    states.compact()
    states.add("b3", parts["b3"])

    def rows(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    assert rows(states.provider_stats()) == rows(joins.provider_stats(claims).select(*states.provider_stats().columns))
    assert rows(states.member_stats()) == rows(joins.member_stats(claims).select(*states.member_stats().columns))


def _files(table):
    return {r["f"] for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()}


def test_keyed_table_rewrites_what_it_touches(spark):
    table = KeyedTable(spark, new_stage_path(spark, "keyed"), "id", buckets=8)
    with pytest.raises(ValueError):
        table.read()
    rows = [(f"k{i}", i, None if i % 3 else "a") for i in range(200)]
    table.upsert(spark.createDataFrame(rows, "id string, n int, s string"))
    before = _files(table)
    table.upsert(spark.createDataFrame([("k7", None, "new", 1.5), (None, 1, "x", 0.0)], "id string, n int, s string, more double"))
    after = _files(table)
    assert len(before) == len(after) == 8 and len(before & after) == 7
    got = {r["id"]: tuple(r) for r in table.read().select("id", "n", "s", "more").collect()}
    assert got == {k: (k, n, s, None) for k, n, s in rows} | {"k7": ("k7", 7, "new", 1.5)}
    table.upsert(spark.createDataFrame([("k7", 1, 5), ("k7", 2, 6), ("z", 3, 9)], "id string, at int, n int"), order="at")
    got = {r["id"]: r["n"] for r in table.read().collect()}
    assert got["k7"] == 6 and got["z"] == 9 and len(got) == 201
    table.vacuum()
    assert {r["id"]: r["n"] for r in table.read().collect()} == got


def test_a_second_writer_from_the_same_version_does_not_win(spark, monkeypatch):
    table = KeyedTable(spark, new_stage_path(spark, "keyed"), "id", buckets=2)
    table.upsert(spark.createDataFrame([("a", 1)], "id string, n int"))
    old = table._manifest()
    table.upsert(spark.createDataFrame([("a", 2)], "id string, n int"))
    late = KeyedTable(spark, table.path, "id")
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_manifest", lambda self: old)
        with pytest.raises(RuntimeError):
            late.upsert(spark.createDataFrame([("b", 3)], "id string, n int"))
    assert {tuple(r) for r in table.read().collect()} == {("a", 2)}


def test_lloyd_turns_rows_into_arrays_once(spark):
    """Steps scan cached blocks: the rows are made once, not once a step."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return x

    df = spark.range(0, 5000, 1, 2).select((F.col("id") % 97).cast("double").alias("x")).select(counted("x").alias("x"))
    centres, costs = fraud.lloyd(df, ["x"], np.array([[[0.0], [96.0]], [[3.0], [5.0]]]), max_iter=4, tol=-1.0)
    assert made.value == 5000
    x, want = np.arange(5000) % 97, np.array([0.0, 96.0])
    for _ in range(4):
        near = np.abs(x[:, None] - want).argmin(axis=1)
        want = np.array([x[near == i].mean() for i in range(2)])
    assert np.allclose(centres[0].ravel(), want) and costs[0] == pytest.approx(np.square(x[:, None] - want).min(axis=1).sum())


def test_points_are_dealt_in_small_blocks(spark):
    df = spark.range(0, 5000, 1, 1).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("y"))
    with fraud._points(df, ["x", "y"]) as points:
        blocks = points.collect()
    assert max(len(x) for x, _ in blocks) <= 2048 and all(len(x) == len(h) for x, h in blocks)
    assert np.concatenate([x for x, _ in blocks])[:, 0].tolist() == list(range(5000))
