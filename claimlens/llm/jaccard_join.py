"""N-gram Jaccard join: documents link when their 5-word shingle sets have a Jaccard similarity of 0.8 or more.

1. Every text becomes a set of hashes, a token bitmap and the set's prefix: of ``n`` hashes the smallest
   ``n - ceil(0.8 n) + 1``.  Two linked sets always share a hash of both prefixes, so the prefixes are all that is
   grouped.  Equal sets are one node from here on.
2. The nodes of a prefix hash meet in the block of its smallest node.  A block is searched with signature trees on
   sizes and bitmaps only, which leaves few pairs; their components are the groups in which links can be.
3. Only for these, texts become sets again, and a group's pairs are searched in the same way and verified exactly.
   A pair whose ends are connected already needs no check, so thousands of near copies cost about one check each.
4. Components of the verified links give every document the smallest id reachable.

Blocks and groups above ``CHUNK`` nodes are dealt over all pairs of their chunks, each a task of bounded size, however
many documents share a passage.  No pair of documents is written but candidates and links that join two components.

Defined results: null and empty texts, and texts of blanks, have no shingles and are a component of their own; rows
without ``doc_id`` have a null component and link with nothing; rows sharing an id are judged by their own texts; rows
repeating id and text give one row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.components import components
from claimlens.llm.shingles import bitmap, shingle_set, signature
from claimlens.llm.signature_tree import OVERLAP, SIZES, candidate_pairs
from claimlens.session import stage

CHUNK = 8192  # nodes of a block or group in one chunk
ROWS = 512  # sets in an Arrow batch
LISTED = 32 << 20  # bytes of the list of wanted texts, places included, up to which it is broadcast; else it is exchanged

Find = Callable[[np.ndarray], np.ndarray]


def prefix_length(size: int) -> int:
    return size - (4 * size + 4) // 5 + 1


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, version, n_shingles, node, prefix, bits) of every row, written once; no node without shingles."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("version"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([s[: prefix_length(len(s))].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "version", "n_shingles", "node", "prefix", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("string").alias("text"))
    return stage(
        texts.mapInArrow(
            per_batch, f"doc_id {kind}, version long, n_shingles long, node long, prefix array<long>, bits binary"
        ),
        "fingerprints",
    )


def blocks(prints: DataFrame) -> DataFrame:
    """(block, node): every node with the smallest nodes that share one of its prefix hashes, itself included."""
    keys = prints.where("doc_id IS NOT NULL").select(F.explode("prefix").alias("key"), "node")
    shared = keys.groupBy("key").agg(F.min("node").alias("block"), F.max("node").alias("last")).where("block < last")
    # Written, so that the join has two plain exchanges and AQE splits a hash that very many documents share.
    shared = stage(shared.select("key", "block"), "shared-hashes")
    return stage(keys.join(shared, "key").select("block", "node").distinct(), "blocks")


def in_chunks(members: DataFrame, group: str) -> DataFrame:
    """Rows with the ``unit`` they are searched in: a group's chunks meet in pairs, so every pair of rows meets once.

    Groups of up to ``CHUNK`` rows are one unit.  Chunks are drawn by the node's hash.
    """
    large = members.groupBy(group).count().where(F.col("count") > CHUNK)
    large = stage(large.select(group, F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")), "large-groups")
    sized = members.join(large, group, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = sized.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return other.withColumn("unit", F.xxhash64(group, low, high)).drop("chunks", "other")


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one unit; rows come sorted by unit, units may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column("unit").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
        for start, end in zip(starts[:-1], starts[1:]):
            if held and held[0].column("unit")[0].as_py() != unit[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over a unit's rows; the root of a component is its smallest row."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def join(self, a: int, b: int) -> None:
        one, two = self.root[a], self.root[b]
        self.root[self.root == max(one, two)] = min(one, two)


def join_links(left: np.ndarray, right: np.ndarray, forest: Forest, check: Callable[[int, np.ndarray], np.ndarray]) -> None:
    """Connect the rows by the links among the candidate pairs, checking no pair that is connected already.

    ``check(row, others)`` says which of ``others`` link with ``row``.  Of every component around a row one pair is
    checked at a time, until all its candidates are connected to it or checked.
    """
    order = np.lexsort((left, right))
    left, right = left[order], right[order]
    rows, starts = np.unique(right, return_index=True)
    for row, start, end in zip(rows, starts, [*starts[1:], len(right)]):
        others = left[start:end]
        while len(others):
            others = others[forest.root[others] != forest.root[row]]
            if not len(others):
                break
            _, first = np.unique(forest.root[others], return_index=True)
            for other in others[first][check(row, others[first])]:
                if forest.root[other] != forest.root[row]:
                    forest.join(row, other)
            others = np.delete(others, first)


def _search(rows: DataFrame, exact: bool) -> DataFrame:
    """(a, b): every node with the smallest node it is connected to in its unit; candidates only if not ``exact``."""

    def per_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches):
            nodes, place = np.unique(unit.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            sizes = unit.column("n_shingles").to_numpy()[place]
            chunk = unit.column("chunk").to_numpy()[place]
            bits = unit.column("bits").take(place).to_pylist()
            if exact:
                sets = [np.frombuffer(s, np.uint64) for s in unit.column("set").take(place).to_pylist()]

                def check(row: int, others: np.ndarray) -> np.ndarray:
                    joined = np.concatenate([sets[o] for o in others])
                    at = np.searchsorted(sets[row], joined)
                    same = sets[row][np.minimum(at, len(sets[row]) - 1)] == joined
                    starts = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
                    return OVERLAP * np.add.reduceat(same.astype(np.int64), starts) >= SIZES * (sizes[row] + sizes[others])

            else:

                def check(row: int, others: np.ndarray) -> np.ndarray:
                    return np.ones(len(others), bool)

            forest = Forest(len(nodes))
            for left, right in candidate_pairs(sizes, bits, chunk, forest.root):
                join_links(left, right, forest, check)
            moved = np.flatnonzero(forest.root != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[forest.root[moved]])], names=["a", "b"])

    dealt = rows.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(per_unit, "a long, b long")


def with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows to search (unit, chunk, node, size, bitmap, set): sets are made again from the texts of ``wanted`` rows.

    ``wanted``: node, its row (id, version) and the (unit, chunk) pairs it is searched in.
    """

    schema = pa.schema(
        [
            ("unit", pa.int64()), ("chunk", pa.int32()), ("node", pa.int64()),
            ("n_shingles", pa.int64()), ("bits", pa.binary()), ("set", pa.binary()),
        ]
    )

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for text, node, places in zip(batch.column("text"), batch.column("node"), batch.column("places")):
                found = shingle_set(text.as_py())
                facts = (node.as_py(), len(found), bitmap(found), found.tobytes())
                for place in places.as_py():
                    held.append((place["unit"], place["chunk"], *facts))
                    if len(held) >= ROWS:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in held], schema=schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in held], schema=schema)

    wanted = stage(wanted.withColumnRenamed("doc_id", "_id"), "wanted")
    # id, text version and node, and 12 bytes for each place; giant families have many places
    id_bytes = F.coalesce(F.octet_length(F.col("_id").cast("string")), F.lit(0))
    if (wanted.agg(F.sum(id_bytes + 40 + 12 * F.size("places"))).first()[0] or 0) <= LISTED:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(
        wanted, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_version"))
    )
    # Rows repeating id and text give their set again; the search takes a node once.
    return texts.select("node", "places", "text").mapInArrow(
        per_batch, "unit long, chunk int, node long, n_shingles long, bits binary, set binary"
    )


def linked(docs: DataFrame) -> DataFrame:
    """(doc_id, version, n_shingles, node, component_id, first) of every row.

    ``first`` marks the one row of a component that stays when near duplicates go: smallest id, then smallest node.
    """
    prints = fingerprints(docs)
    nodes = (
        prints.where("doc_id IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "version")).alias("least"), F.first("n_shingles").alias("n_shingles"))
    )
    nodes = stage(nodes.select("node", "n_shingles", "least.doc_id", F.col("least.version").alias("_version")), "nodes")
    bits = prints.where("doc_id IS NOT NULL").select(F.col("doc_id"), F.col("version").alias("_version"), "node", "bits")
    bits = nodes.join(bits, ["doc_id", "_version", "node"]).select("node", "n_shingles", "bits").dropDuplicates(["node"])

    members = in_chunks(blocks(prints), "block").join(bits, "node")
    candidates = components(_search(members.select("unit", "chunk", "node", "n_shingles", "bits"), exact=False))
    # The smallest node of a group is its label; it has no label of its own.
    roots = candidates.select(F.col("label").alias("node"), "label").distinct()
    groups = stage(candidates.unionByName(roots).withColumnRenamed("label", "group"), "groups")
    places = in_chunks(groups, "group").groupBy("node").agg(F.collect_list(F.struct("unit", "chunk")).alias("places"))
    labels = components(_search(with_sets(docs, places.join(nodes.drop("n_shingles"), "node")), exact=True))

    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stage(labelled.select("node", "label", "doc_id", "_version"), "labelled")
    least = labelled.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    least = stage(least.select("label", F.col("least.doc_id").alias("component_id"), F.col("least.node").alias("_first")), "least")
    of_node = labelled.join(least, "label").select(
        "node", "component_id", F.when(F.col("node") == F.col("_first"), F.col("doc_id")).alias("_stays")
    )
    of_node = stage(of_node, "component-of-node")
    return (
        prints.select("doc_id", "version", "n_shingles", "node")
        .join(of_node, "node", "left")
        .select(
            "doc_id",
            "version",
            "n_shingles",
            "node",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
            (F.col("doc_id").isNull() | F.col("node").isNull() | F.col("doc_id").eqNullSafe(F.col("_stays"))).alias("first"),
        )
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every component: all columns, texts as they are."""
    gone = linked(docs).where("NOT first").select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()
    same = (docs["doc_id"] == gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_version"])
    return docs.join(gone, same, "left_anti")
