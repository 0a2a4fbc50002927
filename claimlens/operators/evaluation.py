"""Model evaluation: confusion, reports, AUC, weights, gates and the registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions import scalars as S
from claimlens.operators.ranking import running_total
from claimlens.session import stage


def confusion(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("prediction")).agg(
        F.count("*").alias("n_rows")
    )


def accuracy(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("int")).alias("accuracy"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The data are read once, as a confusion table of classes x classes; a measure without rows is 0.
    """
    roles = F.explode(
        F.array(
            F.struct(
                F.col("label").cast("string").alias("class"),
                F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0).alias("hits"),
                F.col("n_rows").alias("support"),
                F.lit(0).cast("bigint").alias("predicted"),
            ),
            F.struct(
                F.col("prediction").cast("string").alias("class"),
                F.lit(0).cast("bigint").alias("hits"),
                F.lit(0).cast("bigint").alias("support"),
                F.col("n_rows").alias("predicted"),
            ),
        )
    )
    sums = (
        confusion(df, label, predicted)
        .select(roles.alias("r"))
        .groupBy("r.class")
        .agg(F.sum("r.hits").alias("hits"), F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"))
    )
    per_class = (
        sums.withColumns(
            {
                "precision": _ratio(F.col("hits"), F.col("predicted")),
                "recall": _ratio(F.col("hits"), F.col("support")),
            }
        )
        .withColumn(
            "f1_score",
            _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
        .select("class", "precision", "recall", "f1_score", "support", "hits")
    )
    measures = ("precision", "recall", "f1_score")
    total = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / total).alias(f"w_{m}") for m in measures]
    means = [F.avg(m).alias(f"m_{m}") for m in measures]
    hit_rate = (F.sum("hits") / total).alias("hit_rate")
    overall = per_class.agg(*weighted, *means, hit_rate, total.alias("total"))

    def line(name: str, values: Sequence[str]) -> Column:
        parts = [F.col(v).alias(m) for m, v in zip(measures, values)]
        return F.struct(F.lit(name).alias("class"), *parts, F.col("total").alias("support"))

    lines = F.array(
        line("accuracy", ["hit_rate"] * 3),
        line("macro avg", [f"m_{m}" for m in measures]),
        line("weighted avg", [f"w_{m}" for m in measures]),
    )
    return per_class.drop("hits").unionByName(overall.select(F.inline(lines)))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve with average ranks for ties; one row.

    Rows collapse to one per distinct score, and the rows below a score come from a sliced running
    total, so no task ever sorts the whole table.  Null when a class is missing.
    """
    return _area(stage(_per_score(df, label, score), "per-score"))


def roc_aucs(df: DataFrame, label: str, score: str, group: str, groups: Sequence[int]) -> dict[int, float]:
    """The same within each of a few groups; the rows are scored once for all of them.

    Without negatives it is 1 and without positives 0, as in Spark's evaluator.
    """
    per_score = stage(_per_score(df, label, score, group), "per-score")
    found = {}
    for g in groups:
        own = per_score.where(F.col(group) == g).drop(group)
        auc = _area(own).first()["auc"]
        found[g] = float(own.where("negatives > 0").isEmpty()) if auc is None else auc
    return found


def _per_score(df: DataFrame, label: str, score: str, *groups: str) -> DataFrame:
    """Rows of either class per distinct score."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*groups, F.col(score).alias("_score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("positives"),
            F.count_if(F.col(label) == 0).alias("negatives"),
        )
    )


def _area(per_score: DataFrame) -> DataFrame:
    ranked = running_total(per_score, "_score", ["negatives"])
    wins = F.col("positives") * (F.col("negatives_before") + F.col("negatives") / 2)
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return ranked.agg((F.sum(wins) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def class_weights(df: DataFrame, label: str, positive_weight: float | None = None) -> DataFrame:
    """Weight per class: balanced ``n / (classes * n_class)``, or a fixed weight of class 1."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    if positive_weight is not None:
        weight = F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
        return counts.withColumn("weight", weight)
    totals = counts.agg(F.sum("n_rows") / F.count("*")).scalar()
    return counts.withColumn("weight", totals / F.col("n_rows"))


def with_class_weights(df: DataFrame, label: str, positive_weight: float | None = None) -> DataFrame:
    """Add ``weight`` as an expression; the few class weights are known when the plan is made."""
    if positive_weight is not None:
        return df.withColumn("weight", F.when(F.col(label) == 1, float(positive_weight)).otherwise(1.0))
    chain = None
    for row in class_weights(df, label).collect():
        is_class = F.col(label).eqNullSafe(F.lit(row[label]))
        chain = F.when(is_class, row["weight"]) if chain is None else chain.when(is_class, row["weight"])
    return df.withColumn("weight", F.lit(1.0) if chain is None else chain)


def risk_scores(df: DataFrame, probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Replace the approval probability by the risk table's columns."""
    p = F.col(probability)
    return df.withColumns(
        {
            "approval_probability": F.round(p, 4),
            "risk_score": F.round(1 - p, 4),
            "risk_band": S.risk_band(1 - p),
            "decision": S.decision(p, threshold),
        }
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the highest AUC; of equal ones the first trained (``position``)."""
    return metrics.orderBy(F.desc("auc"), "position").limit(1)


def quality_gate(metrics: DataFrame, min_auc: float = 0.75) -> DataFrame:
    return metrics.withColumn("status", F.when(F.col("auc") >= min_auc, "PASS").otherwise("FAIL"))


def enforce_gate(metrics: DataFrame, min_auc: float = 0.75) -> DataFrame:
    """The gated metrics, or an error that names the failing models."""
    gated = quality_gate(metrics, min_auc)
    failed = [row["model"] for row in gated.where("status = 'FAIL'").select("model").collect()]
    if failed:
        raise ValueError(f"below AUC {min_auc}: {', '.join(sorted(failed))}")
    return gated


def metrics_frame(spark: SparkSession, aucs: Mapping[str, float]) -> DataFrame:
    rows = [(i, name, float(auc)) for i, (name, auc) in enumerate(aucs.items())]
    return spark.createDataFrame(rows, "position int, model string, auc double")


def latest_active(registry: DataFrame) -> DataFrame:
    """Newest active entry per model."""
    rest = [c for c in registry.columns if c != "model_name"]
    newest = F.max(F.struct("created_at", *[c for c in rest if c != "created_at"])).alias("_newest")
    return (
        registry.where("is_active")
        .groupBy("model_name")
        .agg(newest)
        .select("model_name", *[F.col(f"_newest.{c}").alias(c) for c in rest])
    )
