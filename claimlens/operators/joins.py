"""Joins of claims to members and to provider/member statistics, safe for hot keys.

A third of all claims may share one member or provider.  Where counts per key exist already, keys with more than
``ROWS_PER_TASK`` rows are salted over as many tasks as their count asks for.  Where they do not, the join is left as
two plain exchanges, whose oversized partitions AQE splits; the rows are not read a second time to count them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C

ROWS_PER_TASK = 2_000_000
SPREAD = 1 << 20  # rows without a key match nothing and may go anywhere


def heavy(counts: DataFrame, key: str, n: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Keys whose count ``n`` exceeds ``rows``, with the tasks to deal them over: at most total / ``rows`` keys."""
    return counts.where(F.col(n) > rows).select(key, F.ceil(F.col(n) / rows).cast("int").alias("_salts"))


def hot_keys(df: DataFrame, key: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Heavy keys of a table; counts its rows, so the table should be a stored one."""
    return heavy(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), key, "_n", rows)


def skew_join(left: DataFrame, right: DataFrame, key: str, spread: Column, hot: DataFrame | None = None) -> DataFrame:
    """Left join to a ``right`` that is unique on ``key``; every left row appears exactly once.

    ``spread`` is any column of the left row that varies within a key; rows of the ``hot`` keys, as ``heavy`` gives
    them, and rows without a key are dealt by it.  Without ``hot`` AQE splits what is oversized.
    """
    if hot is None:
        return left.join(right, key, "left")
    marked = F.broadcast(hot)
    salts = F.when(F.col(key).isNull(), F.lit(SPREAD)).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = F.pmod(F.xxhash64(spread), salts)
    salted_left = left.join(marked, key, "left").withColumn("_salt", dealt).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = (
        right.join(marked, key, "left").withColumn("_salt", F.explode(copies.cast("array<bigint>"))).drop("_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")


def member_attributes(members: DataFrame) -> DataFrame:
    """The member columns a claim needs, under their claim-side names."""
    wanted = [F.col(old).alias(new) for old, new in C.MEMBER_COLUMN_NAMES.items()]
    state = [F.col("state")] if "state" in members.columns else []
    return members.select("member_id", *wanted, *state)


def enrich_claims(claims: DataFrame, members: DataFrame | None) -> DataFrame:
    """Claims with member attributes; columns the claims already carry are kept and not joined again."""
    present = set(claims.columns)
    missing = [c for c in (*C.MEMBER_COLUMN_NAMES.values(), "state") if c not in present]
    if members is None or not any(c in missing for c in C.MEMBER_COLUMN_NAMES.values()):
        return claims
    attributes = member_attributes(members)
    attributes = attributes.select("member_id", *[c for c in missing if c in attributes.columns])
    return skew_join(claims, attributes, "member_id", F.col("claim_id"))


def provider_stats(claims: DataFrame, approx: bool = False) -> DataFrame:
    """Mean amount, claim count and distinct members per provider.

    The distinct count makes Spark group by (provider, member) first, so a hot provider is split over
    its members before the final merge.  ``approx=True`` trades exactness for one small sketch each.
    """
    members = F.approx_count_distinct("member_id") if approx else F.count_distinct("member_id")
    return (
        claims.where(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            F.avg("claim_amount").alias("provider_avg_claim"),
            F.count("claim_id").alias("provider_claim_count"),
            members.alias("provider_unique_members"),
        )
    )


def member_stats(claims: DataFrame) -> DataFrame:
    return (
        claims.where(F.col("member_id").isNotNull())
        .groupBy("member_id")
        .agg(
            F.count("claim_id").alias("member_claim_count"),
            F.avg("claim_amount").alias("member_avg_claim"),
            F.sum("claim_amount").alias("member_total_spend"),
        )
    )


def with_provider_stats(claims: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Claims with their provider's statistics; a claim without provider keeps nulls."""
    stats = provider_stats(claims) if stats is None else stats
    hot = heavy(stats, "provider_id", "provider_claim_count")
    return skew_join(claims, stats, "provider_id", F.col("claim_id"), hot)


def with_member_stats(claims: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Claims with their member's statistics.

    An aggregate joined back rather than a window: the window would sort all claims of one member in
    one task, the aggregate combines them map-side.
    """
    stats = member_stats(claims) if stats is None else stats
    hot = heavy(stats, "member_id", "member_claim_count")
    return skew_join(claims, stats, "member_id", F.col("claim_id"), hot)


def with_claim_stats(
    claims: DataFrame, providers: DataFrame | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Claims with both statistics, each aggregated from the claims as given (not from a joined frame)."""
    providers = provider_stats(claims) if providers is None else providers
    members = member_stats(claims) if members is None else members
    return with_member_stats(with_provider_stats(claims, providers), members)


def enrich_requests(
    requests: DataFrame, providers: DataFrame, members: DataFrame
) -> DataFrame:
    """Requests with stored provider and member statistics; a value sent with the request wins.

    A batch may hold a hot key; a stream joins the static tables directly.
    """
    out = requests
    for stats, key in ((providers, "provider_id"), (members, "member_id")):
        stored = [c for c in stats.columns if c != key]
        renamed = stats.select(key, *[F.col(c).alias(f"_stored_{c}") for c in stored])
        if out.isStreaming:
            out = out.join(renamed, key, "left")
        else:
            out = skew_join(out, renamed, key, F.col("claim_id"))
        for c in stored:
            value = F.col(f"_stored_{c}")
            out = out.withColumn(c, F.coalesce(F.col(c), value) if c in out.columns else value)
        out = out.drop(*[f"_stored_{c}" for c in stored])
    return out


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Keys are counted first, so a key shared by many rows meets the parents once; the rows themselves
    then meet the orphan keys, a hot one salted.
    """
    counts = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    parent_keys = parent.select(F.col(parent_key or key).alias(key)).distinct()
    missing = counts.join(parent_keys, key, "left_anti").select(key, F.lit(True).alias("_orphan"))
    rows = child.where(F.col(key).isNotNull())
    marked = skew_join(rows, missing, key, F.struct(*child.columns), heavy(counts, key, "_n"))
    return marked.where("_orphan").select(*child.columns)
