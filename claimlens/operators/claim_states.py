"""Provider and member statistics kept as partial states per batch, which merge without reading old claims again.

A batch of claims becomes one row per provider and per member (count, sum, number of amounts), and the distinct
(provider, member) pairs, or with ``approx`` a HyperLogLog sketch per provider.  States add up in any order.  A batch's
folder carries its id and is written whole, so a replayed batch replaces itself; ``compact`` folds finished batches into
one base, which remembers their ids, and a folded batch that comes again is left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import remove
from claimlens.sources.readers import path_exists

KEYS = {"providers": "provider_id", "members": "member_id"}
SUMS = ("n_claims", "n_amounts", "total")


@dataclass
class ClaimStates:
    """States under ``path``: ``batches/<id>/<kind>``, ``base-<n>/<kind>`` and ``folded`` (base number, batch id)."""

    spark: SparkSession
    path: str
    approx: bool = False

    def _kinds(self) -> list[str]:
        return ["providers", "members"] + ([] if self.approx else ["pairs"])

    def add(self, batch_id: str, claims: DataFrame) -> None:
        """Write the states of a batch; the same id again replaces what it wrote, unless it has been folded."""
        if batch_id in self._folded()[1]:
            return
        for kind, df in self._of(claims).items():
            df.write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}/{kind}")
        self.spark.createDataFrame([(batch_id,)], "batch string").coalesce(1).write.mode("overwrite").json(f"{self.path}/batches/{batch_id}/done")

    def _of(self, claims: DataFrame) -> dict[str, DataFrame]:
        parts = {}
        for kind, key in KEYS.items():
            sums = [
                F.count("claim_id").alias("n_claims"), F.count("claim_amount").alias("n_amounts"),
                F.sum(F.col("claim_amount").cast("double")).alias("total"),
            ]
            if self.approx and kind == "providers":
                sums.append(F.hll_sketch_agg(F.col("member_id").cast("string")).alias("members"))
            parts[kind] = claims.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)
        if not self.approx:
            parts["pairs"] = claims.where("provider_id IS NOT NULL AND member_id IS NOT NULL").select("provider_id", "member_id").distinct()
        return parts

    def _folded(self) -> tuple[int, set[str]]:
        """Number of the newest base (0: none) and the ids it holds."""
        if not path_exists(self.spark, f"{self.path}/folded"):
            return 0, set()
        rows = self.spark.read.schema("base int, batch string").json(f"{self.path}/folded").collect()
        newest = max(r["base"] for r in rows)
        return newest, {r["batch"] for r in rows if r["base"] == newest}

    def _finished(self) -> list[str]:
        """Ids of the batches beside the base whose states are whole."""
        if not path_exists(self.spark, f"{self.path}/batches"):
            return []
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batches")
        fs = fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
        done = self._folded()[1]
        return sorted(n for n in names if n not in done and path_exists(self.spark, f"{self.path}/batches/{n}/done/_SUCCESS"))

    def _merged(self, kind: str) -> DataFrame:
        newest, _ = self._folded()
        folders = [f"{self.path}/batches/{n}/{kind}" for n in self._finished()]
        folders += [f"{self.path}/base-{newest}/{kind}"] if newest else []
        if not folders:
            raise ValueError("no batch has been added")
        states = reduce(DataFrame.unionByName, [self.spark.read.parquet(f) for f in folders])
        if kind == "pairs":
            return states.distinct()
        sums = [F.sum(c).alias(c) for c in SUMS]
        if "members" in states.columns:
            sums.append(F.hll_union_agg("members").alias("members"))
        return states.groupBy(KEYS[kind]).agg(*sums)

    def compact(self) -> None:
        """Fold all finished batches into a new base; it counts from the moment its list of ids is written."""
        newest, folded = self._folded()
        batches = self._finished()
        if not batches:
            return
        for kind in self._kinds():
            self._merged(kind).write.mode("overwrite").parquet(f"{self.path}/base-{newest + 1}/{kind}")
        rows = [(newest + 1, b) for b in sorted(folded | set(batches))]
        self.spark.createDataFrame(rows, "base int, batch string").coalesce(1).write.mode("append").json(f"{self.path}/folded")
        remove(self.spark, [f"{self.path}/batches/{b}" for b in batches] + ([f"{self.path}/base-{newest}"] if newest else []))

    def provider_stats(self) -> DataFrame:
        """What ``joins.provider_stats`` gives for the claims of all batches together."""
        states = self._merged("providers")
        mean, count = (F.col("total") / F.col("n_amounts")).alias("provider_avg_claim"), F.col("n_claims").alias("provider_claim_count")
        if self.approx:
            return states.select("provider_id", mean, count, F.hll_sketch_estimate("members").alias("provider_unique_members"))
        distinct = self._merged("pairs").groupBy("provider_id").agg(F.count("*").alias("_members"))
        members = F.coalesce("_members", F.lit(0)).alias("provider_unique_members")
        return states.join(distinct, "provider_id", "left").select("provider_id", mean, count, members)

    def member_stats(self) -> DataFrame:
        """What ``joins.member_stats`` gives for the claims of all batches together."""
        return self._merged("members").select(
            "member_id",
            F.col("n_claims").alias("member_claim_count"),
            (F.col("total") / F.col("n_amounts")).alias("member_avg_claim"),
            F.col("total").alias("member_total_spend"),
        )
