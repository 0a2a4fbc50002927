"""Plan recommendation: collaborative, nearest-neighbour, content-based and their hybrid."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions.text import plan_explanation
from claimlens.operators import reports
from claimlens.operators.joins import skew_join
from claimlens.operators.neighbours import NeighbourIndex
from claimlens.operators.transforms import ZScaler, ZScalerModel
from claimlens.session import stage


def top_plans(scores: DataFrame, n: int) -> DataFrame:
    """The ``n`` best plans per member with their rank; ties in plan order."""
    order = Window.partitionBy("member_id").orderBy(F.desc("score"), "plan")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _entry(score: Column, plan: Column | str) -> Column:
    """Entry of a ranking: sorts best score first, ties in plan order."""
    return F.struct((-score + F.lit(0.0)).alias("minus"), (F.lit(plan) if isinstance(plan, str) else plan).alias("plan"))


def _ranked(scores: Mapping[str, Column]) -> Column:
    """Sorted array of one entry per plan; no shuffle."""
    return F.sort_array(F.array(*[_entry(score, plan) for plan, score in scores.items()]))


# --- content-based ------------------------------------------------------------------------------


def content_ranking(profiles: DataFrame, n: int = 3) -> DataFrame:
    """Add ``ranking``: cosine of a member's risk and income with each plan, the best ``n``."""

    def value(name: str, default: float) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(default)) if name in profiles.columns else F.lit(default)

    risk = (
        value("age", 40.0) / 85 * 0.3
        + value("num_chronic_conditions", 0.0) / 5 * 0.4
        + (value("bmi", 25.0) - 15) / 40 * 0.2
        + 0.1
    )
    frame = profiles.withColumns({"_risk": risk, "_income": value("income_score", 0.5)})
    member = [F.col("_risk"), 1 - F.col("_income"), F.col("_income")]
    length = F.sqrt(sum((x * x for x in member[1:]), member[0] * member[0]))
    scores = {}
    for plan, (premium, coverage, deductible) in C.PLAN_SCORES.items():
        need = [coverage / 5, (5 - deductible) / 5, premium / 5]
        along = member[0] * need[0] + member[1] * need[1] + member[2] * need[2]
        scores[plan] = along / (length * float(np.linalg.norm(need)))
    return frame.withColumn("ranking", F.slice(_ranked(scores), 1, n)).drop("_risk", "_income")


def _unfold(ranked: DataFrame, digits: int | None = 4) -> DataFrame:
    """(member, plan, score, rank) rows of a ``ranking`` array."""
    # the outer form, because Spark evaluates an exploded expression twice to skip empty arrays early
    rows = ranked.select("member_id", F.posexplode_outer("ranking").alias("pos", "hit")).where("pos IS NOT NULL")
    value = 0.0 - F.col("hit.minus")
    score = value if digits is None else F.round(value, digits)
    return rows.select("member_id", F.col("hit.plan").alias("plan"), score.alias("score"), (F.col("pos") + 1).alias("rank"))


def recommend_content(profiles: DataFrame, n: int = 3) -> DataFrame:
    return _unfold(content_ranking(profiles, n))


# --- collaborative ------------------------------------------------------------------------------


@dataclass
class CollaborativeModel:
    """Projection of a member's plan ratings on the leading singular directions.

    The member x plan matrix is never gathered: its plan x plan Gram matrix is one aggregate, whose
    eigenvectors V give the reconstruction ``row . V_k . V_k^T`` as a join of ratings with weights.
    """

    plans: list[str]
    projection: np.ndarray

    def scores(self, interactions: DataFrame) -> DataFrame:
        """One row per known member with ``ranking`` over all plans."""
        rows = [(p, q, float(self.projection[i, j])) for i, p in enumerate(self.plans) for j, q in enumerate(self.plans)]
        weights = interactions.sparkSession.createDataFrame(rows, "plan_type string, plan string, weight double")
        # a rating without plan says nothing of any, but its member is known
        rated = _ratings(interactions).withColumn("plan_type", F.coalesce("plan_type", F.lit(self.plans[0] if self.plans else None)))
        scored = rated.join(weights, "plan_type").groupBy("member_id", "plan")
        per_plan = scored.agg(F.sum(F.col("weight") * F.col("rating")).alias("score"))
        entries = F.collect_list(_entry(F.col("score"), F.col("plan")))
        return per_plan.groupBy("member_id").agg(F.sort_array(entries).alias("ranking"))


def _ratings(interactions: DataFrame) -> DataFrame:
    """(member, plan, rating): repeats summed, map-side first; a rating without plan counts 0."""
    rating = F.coalesce(F.col("rating").cast("double"), F.lit(1.0))
    value = F.when(F.col("plan_type").isNull(), F.lit(0.0)).otherwise(rating)
    return interactions.groupBy("member_id", "plan_type").agg(F.sum(value).alias("rating"))


def fit_collab(interactions: DataFrame, n_factors: int = 50) -> CollaborativeModel:
    ratings = stage(_ratings(interactions), "ratings")
    members = ratings.select("member_id").distinct().count()
    known = ratings.where("plan_type IS NOT NULL")
    other = known.select("member_id", F.col("plan_type").alias("other"), F.col("rating").alias("other_rating"))
    # pairs of plans of one member: a member has no more rows than there are plans
    pairs = known.join(other, "member_id").groupBy("plan_type", "other")
    cells = pairs.agg(F.sum(F.col("rating") * F.col("other_rating")).alias("g")).collect()
    plans = sorted({row["plan_type"] for row in cells})
    place = {plan: i for i, plan in enumerate(plans)}
    gram = np.zeros((len(plans), len(plans)))
    for row in cells:
        gram[place[row["plan_type"]], place[row["other"]]] = row["g"]
    k = min(n_factors, min(members, len(plans)) - 1)
    values, vectors = np.linalg.eigh(gram)
    # equal singular values: the direction of the alphabetically last plan is dropped first
    main = np.abs(vectors).argmax(axis=0)
    order = sorted(range(len(plans)), key=lambda c: (-values[c], main[c]))[: max(k, 0)]
    kept = vectors[:, order]
    projection = kept @ kept.T
    projection[np.abs(projection) < 1e-12] = 0.0
    return CollaborativeModel(plans, projection)


def recommend_collab(model: CollaborativeModel, interactions: DataFrame, n: int = 3) -> DataFrame:
    ranked = model.scores(interactions).withColumn("ranking", F.slice("ranking", 1, n))
    return _unfold(ranked, digits=None)


# --- nearest neighbours -------------------------------------------------------------------------


def profile_vectors(profiles: DataFrame, scaler: ZScalerModel, *carry: str) -> DataFrame:
    """Standardised profile as ``vec``, scaled to length 1; missing values count as 0."""
    columns = list(scaler.fitted)
    filled = profiles.select(
        "member_id",
        *carry,
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in profiles.columns else F.lit(0.0).alias(c)
            for c in columns
        ],
    )
    scaled = scaler.transform(filled)
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0])))
    unit = F.array(*[F.col(c) / F.when(length > 0, length).otherwise(1.0) for c in columns])
    return scaled.select("member_id", *carry, unit.alias("vec"))


def fit_profile_scaler(members: DataFrame) -> ZScalerModel:
    columns = [c for c in C.PROFILE_COLUMNS if c in members.columns]
    filled = members.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return ZScaler(columns=columns).fit(filled)


def profile_index(members: DataFrame, scaler: ZScalerModel, k: int = 10, path: str | None = None) -> NeighbourIndex:
    """Stored index of the members' profiles that answers up to ``k`` neighbours beside the nearest one."""
    plan = F.coalesce("plan_type", F.lit(C.DEFAULT_PLAN)) if "plan_type" in members.columns else F.lit(C.DEFAULT_PLAN)
    known = profile_vectors(members.withColumn("payload", plan), scaler, "payload").withColumnRenamed("member_id", "key")
    return NeighbourIndex.build(known, k + 1, path)


def knn_ranking(
    profiles: DataFrame, index: NeighbourIndex, scaler: ZScalerModel, k: int = 10, n: int = 3, skip_first: bool = True
) -> DataFrame:
    """(member_id, ranking): plans of the ``k`` nearest members, weighted by inverse distance.

    ``skip_first`` drops the nearest member as the profile itself, known or not.
    """
    asked = profile_vectors(profiles, scaler)
    found = index.nearest(asked, k + 1 if skip_first else k)
    hits = found.select(
        "vec", F.explode(F.slice("neighbours", 2, k) if skip_first else F.col("neighbours")).alias("hit")
    )
    votes = hits.groupBy("vec", F.col("hit.payload").alias("plan")).agg(
        F.sum(1 / (F.col("hit.distance") + 1e-9)).alias("score")
    )
    ranking = F.sort_array(F.collect_list(_entry(F.col("score"), F.col("plan"))))
    per_vector = votes.groupBy("vec").agg(F.slice(ranking, 1, n).alias("ranking"))
    return skew_join(asked, per_vector, "vec", F.col("member_id")).select("member_id", "ranking")


def recommend_knn(profiles: DataFrame, members: DataFrame, k: int = 10, n: int = 3) -> DataFrame:
    scaler = fit_profile_scaler(members)
    return _unfold(knn_ranking(profiles, profile_index(members, scaler, k), scaler, k, n))


# --- hybrid -------------------------------------------------------------------------------------


def fallback_ranking(age: Column, chronic: Column) -> Column:
    """Rule-based plans by age and number of conditions."""

    def tier(name: str) -> Column:
        return F.array(*[_entry(F.lit(score), plan) for plan, score in C.FALLBACK_PLANS[name]])

    return (
        F.when((age > 60) | (chronic >= 3), tier("senior"))
        .when((age > 40) | (chronic >= 1), tier("middle"))
        .otherwise(tier("young"))
    )


def recommend_fallback(profiles: DataFrame) -> DataFrame:
    chronic = F.coalesce("num_chronic_conditions", F.lit(0))
    return _unfold(profiles.select("member_id", fallback_ranking(F.col("age"), chronic).alias("ranking")))


@dataclass
class HybridRecommender:
    """Fitted hybrid: .40 collaborative + .35 neighbours + .25 content over each list's best four.

    The neighbours come from a stored index, made once by ``fit`` and read by every question.
    """

    collab: CollaborativeModel
    scaler: ZScalerModel
    index: NeighbourIndex
    members: DataFrame
    interactions: DataFrame
    k: int = 10

    @classmethod
    def fit(cls, members: DataFrame, interactions: DataFrame | None = None, k: int = 10) -> HybridRecommender:
        rated = reports.interactions(members) if interactions is None else interactions
        scaler = fit_profile_scaler(members)
        return cls(fit_collab(rated), scaler, profile_index(members, scaler, k), members, rated, k)

    def recommend(self, profiles: DataFrame, n: int = 3, digits: int | None = 4) -> DataFrame:
        """(member, plan, score, rank) for every request; members without ratings get the rule plans."""
        return self.answers(profiles, n, digits).drop("request_id")

    def answers(self, profiles: DataFrame, n: int = 3, digits: int | None = 4) -> DataFrame:
        """(request, member, plan, score, rank): each request by itself, however often its member asks.

        Requests equal in every column are one request; ``with_request_id`` tells which rows they are.
        """
        asked = with_request_id(profiles).dropDuplicates(["request_id"])
        members = asked.select("request_id", F.col("member_id").alias("_member"))
        # The lists below are kept by request: its id takes the member's place.
        asked = asked.withColumns({"_member": F.col("member_id"), "member_id": F.col("request_id")}).drop("request_id")
        # only the askers' ratings are scored
        own = self.interactions.join(asked.select(F.col("_member").alias("member_id")), "member_id", "left_semi")
        ranked = self.collab.scores(own).withColumn("ranking", F.slice("ranking", 1, 4))
        ranked = ranked.withColumnRenamed("member_id", "_member")
        rated = asked.join(ranked.select("_member"), "_member", "left_semi")
        lists = {
            "collab": _unfold(ranked.join(asked.select("_member", "member_id"), "_member"), None),
            "knn": _unfold(knn_ranking(rated, self.index, self.scaler, self.k, 4)),
            "content": _unfold(content_ranking(rated, 4)),
        }
        parts = [
            df.select("member_id", "plan", (F.col("score") * C.HYBRID_WEIGHTS[name]).alias("score"))
            for name, df in lists.items()
        ]
        mixed = parts[0].unionByName(parts[1]).unionByName(parts[2])
        best = top_plans(mixed.groupBy("member_id", "plan").agg(F.sum("score").alias("score")), n)
        # a sum of doubles may miss a tie by its last bits: settle it first
        score = F.col("score") if digits is None else F.round(F.round("score", 8), digits)
        hybrid = best.select("member_id", "plan", score.alias("score"), "rank")
        unknown = asked.join(ranked.select("_member"), "_member", "left_anti")
        both = hybrid.unionByName(recommend_fallback(unknown).where(F.col("rank") <= n))
        found = both.withColumnRenamed("member_id", "request_id").join(members, "request_id")
        return found.select("request_id", F.col("_member").alias("member_id"), "plan", "score", "rank")

    def save_to(self, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        self.members.write.mode("overwrite").parquet(f"{path}/members")
        self.interactions.write.mode("overwrite").parquet(f"{path}/interactions")
        self.index.copy_to(f"{path}/neighbours")
        spark = self.members.sparkSession
        rows = [(i, plan, [float(x) for x in self.collab.projection[i]]) for i, plan in enumerate(self.collab.plans)]
        factors = spark.createDataFrame(rows, "position int, plan string, weights array<double>")
        factors.write.mode("overwrite").parquet(f"{path}/projection")

    @classmethod
    def load_from(cls, spark: SparkSession, path: str, k: int = 10) -> HybridRecommender:
        rows = spark.read.parquet(f"{path}/projection").orderBy("position").collect()
        collab = CollaborativeModel([r["plan"] for r in rows], np.array([r["weights"] for r in rows]))
        return cls(
            collab,
            ZScalerModel.load(f"{path}/scaler"),
            NeighbourIndex.load(spark, f"{path}/neighbours"),
            spark.read.parquet(f"{path}/members"),
            spark.read.parquet(f"{path}/interactions"),
            k,
        )


def with_request_id(profiles: DataFrame) -> DataFrame:
    """Add ``request_id``, made of all columns, so that a retried task makes the same one."""
    return profiles.withColumn("request_id", F.sha2(F.to_json(F.struct(*sorted(profiles.columns))), 256))


def recommendation_records(answers: DataFrame, profiles: DataFrame) -> DataFrame:
    """One record per request row: list of (plan, score) and the explanation sentence."""
    lists = answers.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "plan", "score"))).alias("_recs")
    )
    wanted = with_request_id(profiles).select("request_id", "member_id", "age", "num_chronic_conditions")
    joined = wanted.join(lists, "request_id", "left")
    chronic = F.coalesce("num_chronic_conditions", F.lit(0))
    return joined.select(
        "member_id",
        F.transform("_recs", lambda r: F.struct(r["plan"].alias("plan"), r["score"].alias("score"))).alias("recommendations"),
        plan_explanation(F.col("age"), chronic, F.get(F.col("_recs"), F.lit(0))["plan"]).alias("explanation"),
    )
