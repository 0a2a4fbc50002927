"""Table sources: CSV, Parquet, JSON documents, relational tables, and their selection by settings."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from claimlens import schemas

log = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str = "None", multi_line: bool = False
) -> DataFrame:
    """CSV with a header and a declared schema; any Hadoop path (``s3a://`` too).

    ``multi_line`` admits line breaks inside quoted text, at the price of one task per file instead of
    one per block; quotes inside values are doubled.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _read(spark: SparkSession, name: str, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":  # only notes hold free text
        return read_csv(spark, path, schemas.TABLES[name], multi_line=name == "notes")
    return read_parquet(spark, path)


def load_dataset(spark: SparkSession, base: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The four tables under ``base``; a missing one is left out with a warning."""
    out = {}
    for name, file in schemas.TABLE_FILES.items():
        path = f"{base}/{file}.{fmt}"
        if not path_exists(spark, path):
            log.warning("table %s not found at %s", name, path)
        else:
            out[name] = _read(spark, name, path, fmt)
    return out


def load_with_fallback(
    spark: SparkSession, primary: str, fallback: str, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Each table from ``primary``, or from ``fallback`` where the first place lacks it."""
    out = {}
    for name, file in schemas.TABLE_FILES.items():
        for base in (primary, fallback):
            path = f"{base}/{file}.{fmt}"
            try:
                if not path_exists(spark, path):
                    raise FileNotFoundError(path)
                out[name] = _read(spark, name, path, fmt)
                break
            except (AnalysisException, FileNotFoundError) as error:
                log.warning("table %s not read from %s: %s", name, base, error)
    return out


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """Every file below ``prefix`` with its size and time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(prefix)
        .select("path", "length", "modificationTime")
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    where: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Relational table; ``where`` is pushed to the database.

    ``partition`` = (column, lowest, highest, parts) reads ranges in parallel instead of one task.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if partition:
        column, low, high, parts = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    df = reader.load()
    return df.where(where) if where else df


def read_query(
    spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None
) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("query", sql).options(**(properties or {})).load()


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, where: Column | str | None = None, limit: int = 0
) -> DataFrame:
    """JSON documents without their ``_id``; ``limit`` 0 reads all."""
    df = spark.read.schema(schema).json(path)
    if where is not None:
        df = df.where(where)
    df = df.drop("_id")
    return df.limit(limit) if limit else df


# --- selection by settings ----------------------------------------------------------------------

LAKE, OBJECT_STORE, DATABASE, LOCAL = "lake", "object_store", "database", "local"


def resolve_source(conf: Mapping[str, str]) -> str:
    """First configured source: lake, object store, database, else the local folder."""
    for kind, key in ((LAKE, "lake.path"), (OBJECT_STORE, "object_store.path"), (DATABASE, "database.url")):
        if conf.get(key):
            return kind
    return LOCAL


def get_data(spark: SparkSession, conf: Mapping[str, str], source: str = "auto") -> dict[str, DataFrame]:
    """The four tables, lazily, from the chosen or the first configured source."""
    kind = resolve_source(conf) if source == "auto" else source
    local = conf.get("local.path", "data")
    if kind == LAKE:
        return {n: read_parquet(spark, f"{conf['lake.path']}/{f}") for n, f in schemas.TABLE_FILES.items()}
    if kind == OBJECT_STORE:
        return load_with_fallback(spark, conf["object_store.path"], local)
    if kind == DATABASE:
        login = {k.removeprefix("database."): x for k, x in conf.items() if k.startswith("database.") and k != "database.url"}
        return {
            n: read_table(spark, conf["database.url"], f, properties=login) for n, f in schemas.TABLE_FILES.items()
        }
    if kind == LOCAL:
        return load_dataset(spark, local)
    raise ValueError(f"unknown source {kind!r}")
