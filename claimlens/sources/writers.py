"""Table sinks: Parquet, CSV, JSON, relational tables, predictions, registry and document upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schemas


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_claims(claims: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Claims laid out by month and, within files, by provider, so that scans skip files and row groups."""
    claims.withColumn("claim_month", F.date_format("claim_date", "yyyy-MM")).sortWithinPartitions(
        "claim_month", "provider_id"
    ).write.mode(mode).partitionBy("claim_month").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("nullValue", "None").option("escape", '"').csv(path)


def write_table(
    df: DataFrame, url: str, table: str, if_exists: str = "append", properties: Mapping[str, str] | None = None
) -> None:
    """Relational write in batches of 1000 rows; ``if_exists`` is append, replace or fail."""
    mode = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}[if_exists]
    df.write.option("batchsize", 1000).jdbc(url, table, mode=mode, properties=dict(properties or {}))


def append_documents(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upsert(target: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Documents after setting, per key, the fields an update supplies; unknown keys are inserted.

    A null or absent field is not supplied.  With ``order``, several updates of one key apply in that
    order: each field takes its last supplied value.
    """
    fields = [c for c in updates.columns if c not in (key, order)]
    if order:
        last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields]
        updates = updates.groupBy(key).agg(*last)
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = target.join(new, key, "full_outer")
    names = [c for c in target.columns if c != key] + [c for c in fields if c not in target.columns]
    columns = []
    for c in names:
        if c not in fields:
            columns.append(F.col(c))
        elif c in target.columns:
            columns.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        else:
            columns.append(F.col(f"_new_{c}").alias(c))
    return joined.select(key, *columns)


def write_predictions(df: DataFrame, path: str, version: str) -> None:
    """Overwrite the prediction table, stamped with model version and time."""
    stamped = df.withColumns({"model_version": F.lit(version), "created_at": F.current_timestamp()})
    stamped.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One-row results and statistics."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_run_results(
    spark: SparkSession, path: str, best: str | None, results: Mapping[str, float], passed: bool
) -> DataFrame:
    row = spark.createDataFrame([(best, dict(results), passed)], "best_claim string, results map<string,double>, passed boolean")
    stamped = row.select(F.current_timestamp().alias("timestamp"), "best_claim", "results", "passed")
    write_json(stamped, path)
    return spark.read.schema(schemas.RUN_RESULTS).json(path)


def register_model(spark: SparkSession, path: str, entry: Mapping[str, object]) -> None:
    """Append one model to the registry; fields left out stay null."""
    names = [f for f in schemas.MODEL_REGISTRY.names if f not in ("created_at", "deployed_at")]
    row = spark.createDataFrame(
        [tuple(entry.get(n) for n in names)],
        ", ".join(f"{n} {schemas.MODEL_REGISTRY[n].dataType.simpleString()}" for n in names),
    )
    now = F.current_timestamp()
    row.withColumns(
        {"created_at": now, "deployed_at": F.when(F.col("is_active"), now)}
    ).select(*schemas.MODEL_REGISTRY.names).write.mode("append").parquet(path)
