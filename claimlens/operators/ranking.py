"""Global ranks, running totals and stratified splits over groups of any size.

A window over one group sorts the whole group in one task.  Here a group is cut into ordered slices,
the slices' sizes are accumulated (one small row each), and a window only ever sorts one slice.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_DIGITS = 4  # leading hex digits of the hash: 65,536 even slices per group, 1.5 million rows each of 100 billion
MAX_LABELS = 100  # of a split that names them one by one
ROWS_PER_SLICE = 200_000  # rows of a running total that one window sorts


def hash_rank(
    df: DataFrame, groups: list[str], key: str, seed: int, name: str = "rank", size: str | None = None
) -> DataFrame:
    """1-based rank of each row in its group, in the order of ``md5(key + seed)``; ``size`` adds the group's size.

    Equal to ``row_number() over (partition by groups order by md5, key)``; ``key`` must be unique.
    """
    hashed = df.withColumn("_md5", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))).withColumn(
        "_slice", F.substring("_md5", 1, SLICE_DIGITS)
    )
    sizes = hashed.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    before = sizes.select(
        *([F.sum("_n").over(whole).alias(size)] if size else []),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
    )
    same = F.col("_slice") == F.col("_s")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*groups, "_slice").orderBy("_md5", key)
    return (
        hashed.withColumn("_in", F.row_number().over(inside))
        .join(before, same)
        .withColumn(name, F.col("_before") + F.col("_in"))
        .drop("_md5", "_slice", "_s", "_in", "_before", *[f"_g{i}" for i in range(len(groups))])
    )


def stratified_split(
    df: DataFrame, label: str, key: str, test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly ``round(test_fraction * size)`` rows of every label, chosen by hash."""
    ranked = hash_rank(df, [label], key, seed, "_rank", "_size")
    in_test = F.col("_rank") <= F.round(F.col("_size") * test_fraction)
    return ranked.withColumn("is_test", in_test.cast("int")).drop("_rank", "_size")


def plain_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` without strata."""
    return stratified_split(df.withColumn("_all", F.lit(1)), "_all", key, test_fraction, seed).drop("_all")


def wide_split(df: DataFrame, label: str | None, key: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """``stratified_split`` (``plain_split`` without ``label``) of wide rows with few labels: only hashes of keys are exchanged.

    The test rows of a label are those up to the hash and key at its last place, which a few small jobs find; the rows
    themselves are neither sorted nor sent.  Where repeats of one key lie on both sides of that place, rows are ranked.
    """
    hashed = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    group = F.lit(1) if label is None else F.col(label)
    keys = df.select(group.alias("_g"), F.col(key).alias("_key"), hashed.alias("_md5"))
    keys = keys.withColumn("_slice", F.substring("_md5", 1, SLICE_DIGITS))
    running = Window.partitionBy("_g").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keys.groupBy("_g", "_slice").agg(F.count("*").alias("_n"))
    placed = sizes.withColumns(
        {
            "_want": F.round(F.sum("_n").over(Window.partitionBy("_g")) * test_fraction),
            "_before": F.coalesce(F.sum("_n").over(running), F.lit(0)),
        }
    )
    last = placed.where((F.col("_before") < F.col("_want")) & (F.col("_want") <= F.col("_before") + F.col("_n")))
    ends = {row["_g"]: row for row in last.limit(MAX_LABELS + 1).collect()}
    if len(ends) > MAX_LABELS:
        return plain_split(df, key, test_fraction, seed) if label is None else stratified_split(df, label, key, test_fraction, seed)
    in_test = F.lit(0)
    for g, row in ends.items():
        if row["_slice"] is None:  # rows without a key come first, and are dropped
            continue
        inside = keys.where(F.col("_g").eqNullSafe(F.lit(g)) & (F.col("_slice") == row["_slice"]))
        place = int(row["_want"] - row["_before"])
        end = inside.orderBy("_md5", "_key").limit(place).orderBy(F.desc("_md5"), F.desc("_key")).first()
        up_to = (F.col("_md5") < end["_md5"]) | ((F.col("_md5") == end["_md5"]) & (F.col("_key") <= F.lit(end["_key"])))
        if inside.where(up_to).count() != place:
            return plain_split(df, key, test_fraction, seed) if label is None else stratified_split(df, label, key, test_fraction, seed)
        up_to = (hashed < end["_md5"]) | ((hashed == end["_md5"]) & (F.col(key) <= F.lit(end["_key"])))
        in_test = F.when(group.eqNullSafe(F.lit(g)), up_to.cast("int")).otherwise(in_test)
    return df.where(F.col(key).isNotNull()).withColumn("is_test", in_test)


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1; within every label the folds differ by at most one row."""
    ranked = hash_rank(df, [label], key, seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")


def running_total(df: DataFrame, order: str, values: list[str], slices: int | None = None) -> DataFrame:
    """Add ``<value>_before``: the sum of each value over all rows with a smaller ``order``.

    ``order`` must be unique per row and not null.  Slices are cut at sketched quantiles, as many as the rows ask
    for; their totals (one row each) are accumulated apart.  ``df`` is read several times: give a stored table.
    """
    slices = slices or 1 + df.count() // ROWS_PER_SLICE
    fractions = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), fractions, 10 * slices)).first()[0] if fractions else []
    ordered = df.withColumn("_order", F.col(order).cast("double"))
    if cuts:
        splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
        sliced = Bucketizer(splits=splits, inputCol="_order", outputCol="_slice").transform(ordered)
    else:
        sliced = ordered.withColumn("_slice", F.lit(0.0))
    totals = sliced.groupBy("_slice").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values],
    )
    inside = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.join(F.broadcast(offsets), F.col("_slice") == F.col("_s"))
    for v in values:
        out = out.withColumn(
            f"{v}_before", F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))
        )
    return out.drop("_order", "_slice", "_s", *[f"_o_{v}" for v in values])
