"""Fitted column transforms as Spark ML estimators with JSON-persisted state."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators.quantiles import SKETCH_ACCURACY, exact_quantiles

MAX_CODES = 100_000  # values, of all columns together, that a fitted indexer may hold


class _HasColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to transform in place", TypeConverters.toListString)

    def get_columns(self) -> list[str]:
        return self.getOrDefault(self.columns)


class StateModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Model whose fitted values are one JSON-serialisable parameter."""

    state = Param(Params._dummy(), "state", "fitted values")

    def __init__(self, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    @property
    def fitted(self):
        return self.getOrDefault(self.state)


class _ColumnEstimator(Estimator, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        if columns is not None:
            self._set(columns=list(columns))


class MedianImputerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.fitted.items() if m is not None}
        )


class MedianImputer(_ColumnEstimator):
    """Null -> exact median of the column; ``approx`` settles for a sketched one."""

    approx = Param(Params._dummy(), "approx", "use the quantile sketch", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, approx=False):
        super().__init__(columns=columns)
        self._set(approx=approx)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        columns = self.get_columns()
        if self.getOrDefault(self.approx):
            row = df.agg(*[F.percentile_approx(c, 0.5, SKETCH_ACCURACY).alias(c) for c in columns]).first()
            return MedianImputerModel({c: None if row[c] is None else float(row[c]) for c in columns})
        medians = exact_quantiles(df, {c: [0.5] for c in columns})
        return MedianImputerModel({c: medians[c][0] for c in columns})


class LabelIndexerModel(StateModel):
    """State: column -> its values in order; a value's place is its code, unseen values get the next one.

    Codes are joined as tables, one per column, and sent to every task: a fit holds at most ``MAX_CODES`` of them.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for column, values in self.fitted.items():
            codes = df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "_value string, _code double")
            value = F.coalesce(F.col(column).cast("string"), F.lit(C.UNKNOWN_CATEGORY))
            code = F.coalesce("_code", F.lit(float(len(values))))
            df = df.join(F.broadcast(codes), value == F.col("_value"), "left").withColumn(column, code).drop("_value", "_code")
        return df.select(*names)


class LabelIndexer(_ColumnEstimator):
    """Category -> 0-based rank of its value in code-point order; null is its own class.

    The fitted values lie on the driver, so a fit refuses more than ``MAX_CODES`` of them;
    ``dictionary.value_codes`` and ``with_code`` number columns of any size.
    """

    def _fit(self, df: DataFrame) -> LabelIndexerModel:
        columns = self.get_columns()
        pairs = F.array(
            *[
                F.struct(
                    F.lit(c).alias("name"),
                    F.coalesce(F.col(c).cast("string"), F.lit(C.UNKNOWN_CATEGORY)).alias("value"),
                )
                for c in columns
            ]
        )
        found = df.select(F.explode(pairs).alias("p")).select("p.*").distinct().limit(MAX_CODES + 1).collect()
        if len(found) > MAX_CODES:
            raise ValueError(f"more than {MAX_CODES} values in {columns}: number them with dictionary.value_codes")
        return LabelIndexerModel({c: sorted(r["value"] for r in found if r["name"] == c) for c in columns})


class ZScalerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - mean) / std for c, (mean, std) in self.fitted.items()})


class ZScaler(_ColumnEstimator):
    """Mean 0 and population standard deviation 1; a constant column becomes 0."""

    def _fit(self, df: DataFrame) -> ZScalerModel:
        columns = self.get_columns()
        row = df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        ).first()
        return ZScalerModel({c: [row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 1.0] for c in columns})


class RangeScalerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - low) / span for c, (low, span) in self.fitted.items()})


class RangeScaler(_ColumnEstimator):
    """Minimum -> 0 and maximum -> 1; a constant column becomes 0."""

    def _fit(self, df: DataFrame) -> RangeScalerModel:
        columns = self.get_columns()
        row = df.agg(
            *[F.min(c).cast("double").alias(f"min_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"max_{c}") for c in columns],
        ).first()
        state = {}
        for c in columns:
            low, high = row[f"min_{c}"] or 0.0, row[f"max_{c}"] or 0.0
            state[c] = [low, (high - low) or 1.0]
        return RangeScalerModel(state)


def fit_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: min, max, mean, population deviation and exact median, one row each."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"min_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"max_{c}") for c in columns],
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    rows = [
        (c, row[f"min_{c}"], row[f"max_{c}"], row[f"mean_{c}"], row[f"std_{c}"], medians[c][0])
        for c in columns
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, min_value double, max_value double, mean_value double, std_value double, median_value double"
    )
