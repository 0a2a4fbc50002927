"""Training, evaluation and scoring of the claim approval models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators import boosting, forest, logistic
from claimlens.operators import evaluation as E
from claimlens.operators.boosting import Growth
from claimlens.operators.claim_features import FEATURES
from claimlens.operators.ranking import stratified_folds, stratified_split
from claimlens.session import sized, stage

# Steps at most, classes balanced
LINEAR = {"logistic": 1000}
# Boosting by least squares, and of second order, level by level and best leaf first
BOOSTERS = {
    "gbm": Growth(rounds=200, step=0.05, max_depth=5, l2=0.0, min_hessian=0.0, loss="squares", bins=32),
    "xgboost": Growth(rounds=300, step=0.05, policy="depth", max_depth=6, l2=1.0, min_hessian=1.0, positive_weight=3.0),
    "lightgbm": Growth(
        rounds=300, step=0.05, policy="loss", max_depth=None, max_leaves=63, l2=0.0, min_hessian=1e-3, min_rows=20,
        positive_weight=None,
    ),
}
# Trees and depth, classes balanced
FORESTS = {"rf": forest.Bagging(trees=200, max_depth=10)}
ALL_FAMILIES = (*LINEAR, "rf", *BOOSTERS)


def _balanced(df: DataFrame, label: str) -> tuple[int, tuple[float, float]]:
    """Number of rows, and the balanced weights of the classes 0 and 1."""
    found = {row[label]: row for row in E.class_weights(df, label).collect()}
    if other := [c for c in found if c not in (0, 1)]:
        raise ValueError(f"{label} is 0 or 1, not {other[0]}")
    return sum(row["n_rows"] for row in found.values()), tuple(found[c]["weight"] if c in found else 1.0 for c in (0, 1))


def with_probability(model: Model, df: DataFrame) -> DataFrame:
    """Model output with the class-1 ``probability`` as a plain column."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(last, logistic.LogisticModel):
        return df.withColumn("probability", last.probability())
    out = model.transform(df)
    return out.withColumn("probability", vector_to_array("probability")[1]).drop("rawPrediction", "features")


@dataclass
class ClaimModel:
    family: str
    model: PipelineModel
    metrics: dict = field(default_factory=dict)
    threshold: float = C.DECISION_THRESHOLD

    def predict(self, features: DataFrame) -> DataFrame:
        """Features with ``probability`` and 0/1 ``prediction`` at the threshold."""
        out = with_probability(self.model, features)
        return out.withColumn("prediction", (F.col("probability") >= self.threshold).cast("int"))

    def risk_score(self, features: DataFrame) -> DataFrame:
        """Risk table: probability, risk, band and decision, keyed by claim."""
        keys = [c for c in ("claim_id", "member_id") if c in features.columns]
        scored = E.risk_scores(with_probability(self.model, features), "probability", self.threshold)
        return scored.select(*keys, "approval_probability", "risk_score", "risk_band", "decision")

    def feature_importance(self, spark: SparkSession, names: Sequence[str] = FEATURES) -> DataFrame:
        """Importance per feature (absolute coefficient for the linear model), largest first."""
        fitted = self.model.stages[-1]
        values = fitted.featureImportances if hasattr(fitted, "featureImportances") else abs(fitted.coefficients.toArray())
        rows = [(name, float(values[i])) for i, name in enumerate(names)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.family}")

    @classmethod
    def load(cls, family: str, path: str) -> ClaimModel:
        return cls(family, PipelineModel.load(f"{path}/{family}"))


def train_claim(
    features: DataFrame,
    family: str = "xgboost",
    label: str = "claim_approved",
    key: str = "claim_id",
    columns: Sequence[str] = FEATURES,
    rounds: int | None = None,
    folds: int = 0,
    seed: int = 42,
) -> ClaimModel:
    """Fit on 80% of every class and evaluate on the rest; ``folds`` adds a cross-validated AUC."""
    split = _split(features, label, key, folds, seed)
    return _train(split, [family], label, columns, {family: rounds}, folds, seed)[family]


def _split(features: DataFrame, label: str, key: str, folds: int, seed: int) -> DataFrame:
    """Staged features with ``is_test`` and, if asked for, ``fold``: every model of a run reads this one table."""
    split = stratified_split(features, label, key, 0.2, seed)
    return stage(stratified_folds(split, label, key, folds, seed) if folds else split, "split")


def _train(
    split: DataFrame, families: Sequence[str], label: str, columns: Sequence[str], rounds: Mapping[str, int | None], folds: int, seed: int
) -> dict[str, ClaimModel]:
    """Every family on the same rows.  All boosters and all their folds grow side by side on one binned matrix, so do forests."""
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    n_train = train.count()
    grown = _grown(split, families, label, columns, rounds, folds, seed)
    models = {}
    for family in families:
        model = ClaimModel(family, grown[family, None])
        scored = model.predict(test).select(F.col(label).alias("label"), "probability", "prediction").persist()
        model.metrics = {
            "model": family,
            "auc_roc": E.roc_auc(scored, "label", "probability").first()["auc"],
            "report": [row.asDict() for row in E.classification_report(scored).collect()],
            "confusion": [row.asDict() for row in E.confusion(scored).collect()],
            "training_rows": n_train,
        }
        scored.unpersist()
        if folds:
            found = _fold_auc(split, [grown[family, fold] for fold in range(folds)], label)
            model.metrics["cv_auc_mean"], model.metrics["cv_auc_std"] = found
        models[family] = model
    return models


def _grown(
    split: DataFrame, families: Sequence[str], label: str, columns: Sequence[str], rounds: Mapping[str, int | None], folds: int,
    seed: int, whole: bool = True,
) -> dict[tuple[str, int | None], PipelineModel]:
    """(family, fold left out) -> model of a family of the library's own; fold None is that of the training rows, left out if
    not ``whole``."""
    left_out = {None: ("is_test", 1)} if whole else {}
    left_out |= {fold: ("fold", fold) for fold in range(folds)}
    boosters, forests = {}, {}
    for family in families:
        for fold, rows in left_out.items():
            if family in BOOSTERS:
                n = rounds.get(family) or BOOSTERS[family].rounds
                boosters[family, fold] = replace(BOOSTERS[family], rounds=n, left_out=rows)
            if family in FORESTS:
                n = rounds.get(family) or FORESTS[family].trees
                forests[family, fold] = replace(FORESTS[family], trees=n, seed=seed, left_out=rows)
    models = {}
    if "gbm" in families:
        refuse_unfit(split, label, columns)
    for bins in sorted({rules.bins for rules in boosters.values()}):
        alike = {key: rules for key, rules in boosters.items() if rules.bins == bins}
        found = boosting.train(boosting.bin_matrix(split, columns, label, bins), list(alike.values()))
        models |= {key: booster.model(label) for key, booster in zip(alike, found, strict=True)}
    if forests:
        _refuse_gaps(split, [label, *columns])
        found = forest.train(boosting.bin_matrix(split, columns, label, forest.MAX_BINS), list(forests.values()))
        models |= {key: grown.model() for key, grown in zip(forests, found, strict=True)}
    for family in families:
        if family in LINEAR:
            found = _linear(split, label, columns, rounds.get(family) or LINEAR[family], folds, whole)
            models |= {(family, fold): model for fold, model in found.items()}
    return {key: PipelineModel([model]) for key, model in models.items()}


def _linear(
    split: DataFrame, label: str, columns: Sequence[str], steps: int, folds: int, whole: bool
) -> dict[int | None, logistic.LogisticModel]:
    """Fold left out -> logistic model; a penalty of strength 1 against the sum over rows is 1/n against their mean."""
    _refuse_gaps(split, [label, *columns])
    fits = {}
    if whole:
        n_rows, weights = _balanced(split.where("is_test = 0"), label)
        fits[None] = logistic.Fit(1.0 / max(n_rows, 1), weights, ("is_test", 1))
    if folds:
        n_rows, weights = _balanced(split, label)
        penalty = 1.0 / max(int(n_rows * (folds - 1) / folds), 1)
        fits |= {fold: logistic.Fit(penalty, weights, ("fold", fold)) for fold in range(folds)}
    return dict(zip(fits, logistic.train(split, columns, label, list(fits.values()), steps), strict=True))


def _refuse_gaps(df: DataFrame, columns: Sequence[str]) -> None:
    """Forests and linear models, like Spark's own classifiers, take no null or NaN."""
    gaps = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.count_if(gap).alias(c) for gap, c in zip(gaps, columns)]).first()
    if found := [c for c in columns if row[c]]:
        raise ValueError(f"null or NaN in {', '.join(found)}")


def refuse_unfit(df: DataFrame, label: str, columns: Sequence[str]) -> None:
    """What Spark's boosted trees refuse: no rows, labels other than 0 and 1, null and NaN."""
    _refuse_gaps(df, [label, *columns])
    if not _balanced(df, label)[0]:
        raise ValueError("boosted trees need rows to learn from")


def _fold_auc(folded: DataFrame, models: Sequence[PipelineModel], label: str) -> tuple[float, float]:
    """Mean and population deviation of the AUC of each fold under the model that has not seen it."""
    parts = [
        with_probability(model, folded.where(F.col("fold") == fold)).select(label, "probability", F.lit(fold).alias("fold"))
        for fold, model in enumerate(models)
    ]
    found = E.roc_aucs(reduce(DataFrame.unionAll, parts), label, "probability", "fold", list(range(len(models))))
    aucs = [found[fold] for fold in range(len(models))]
    mean = sum(aucs) / len(aucs)
    return mean, (sum((a - mean) ** 2 for a in aucs) / len(aucs)) ** 0.5


def cross_validate(
    features: DataFrame,
    family: str,
    label: str,
    key: str,
    columns: Sequence[str] = FEATURES,
    rounds: int | None = None,
    folds: int = 5,
    seed: int = 42,
) -> tuple[float, float]:
    """Mean and population deviation of the AUC over stratified folds."""
    folded = stage(stratified_folds(features, label, key, folds, seed), "folds")
    models = _grown(folded, [family], label, columns, {family: rounds}, folds, seed, whole=False)
    return _fold_auc(folded, [models[family, fold] for fold in range(folds)], label)


def train_all(
    features: DataFrame,
    families: Sequence[str] = ("logistic", "rf", "xgboost", "lightgbm"),
    rounds: Mapping[str, int] | None = None,
    folds: int = 0,
    label: str = "claim_approved",
    key: str = "claim_id",
    seed: int = 42,
) -> tuple[dict[str, ClaimModel], DataFrame]:
    """Every family on the same rows, and their metrics in training order."""
    split = _split(features, label, key, folds, seed)
    models = _train(split, families, label, FEATURES, rounds or {}, folds, seed)
    aucs = {f: m.metrics["auc_roc"] for f, m in models.items()}
    return models, E.metrics_frame(features.sparkSession, aucs)


# --- lake variant -------------------------------------------------------------------------------

LAKE_CATEGORICAL = ("claim_type", "plan_type", "state", "diagnosis_code")
LAKE_NUMERIC = (
    "claim_amount", "age", "bmi", "num_chronic_conditions", "num_procedures", "days_in_hospital", "prior_auth",
    "high_cost_flag", "composite_risk",
)


def lake_pipeline(rounds: int = 100, seed: int = 42) -> Pipeline:
    """Frequency indexers, assembler that skips incomplete rows, scaler and boosted trees."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in LAKE_CATEGORICAL]
    inputs = [*LAKE_NUMERIC, *[f"{c}_idx" for c in LAKE_CATEGORICAL]]
    return Pipeline(
        stages=[
            *indexers,
            VectorAssembler(inputCols=inputs, outputCol="features_raw", handleInvalid="skip"),
            StandardScaler(inputCol="features_raw", outputCol="features"),
            # a null state or code is "kept" as its own index, one more than the values seen
            GBTClassifier(labelCol="claim_approved", maxIter=rounds, maxDepth=5, maxBins=256, seed=seed),
        ]
    )


def train_claim_lake(df: DataFrame, rounds: int = 100, seed: int = 42) -> tuple[PipelineModel, float]:
    """Fitted pipeline and its AUC on a hashed 20% of every class."""
    split = stage(stratified_split(df, "claim_approved", "claim_id", 0.2, seed), "lake-split")
    train = split.where("is_test = 0")
    model = lake_pipeline(rounds, seed).fit(sized(train, train.count()))
    scored = with_probability(model, split.where("is_test = 1"))
    return model, E.roc_auc(scored, "claim_approved", "probability").first()["auc"]
