"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Settings the engine expects; a cluster's own values win because they are only set where absent.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


ROWS_PER_PARTITION = 50_000  # of a matrix that a fit scans once per tree level


def build_session(app: str = "claimlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster without it is an
    error, because a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="claimlens-"))
    return context.getCheckpointDir()


# Tables staged inside the open blocks, innermost last.  A thread that a block starts has no open block.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging", default=())
_unscoped: list[str] = []  # staged outside any block: a result may read them until the program ends


def new_stage_path(spark: SparkSession, name: str, outlive: bool = False) -> str:
    """A new folder for one table; with ``outlive`` it belongs to the block around the innermost one."""
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes.get()[:-1] if outlive else _scopes.get()
    if not scopes and not _unscoped:
        atexit.register(_remove_unscoped, spark)
    (scopes[-1] if scopes else _unscoped).append(path)
    return path


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders in the shared folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def _remove_unscoped(spark: SparkSession) -> None:
    try:
        remove(spark, _unscoped)
    except (Py4JError, OSError, AttributeError):  # the JVM has gone before the program
        pass


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a frame that several fits scan: a lost executor re-reads files rather than
    re-running joins, and later scans prune to the columns they need.
    """
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str, outlive: bool = False) -> tuple[DataFrame, str]:
    """The same with the folder, for those who remove a table as soon as nothing reads it; ``outlive`` as in ``new_stage_path``."""
    path = new_stage_path(df.sparkSession, name, outlive)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what a query inside the block has shuffled as soon as it ends, not when the driver's memory is cleaned."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its number of rows asks for; for fits that scan it many times."""
    return df.coalesce(1 + rows // ROWS_PER_PARTITION)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside the block when it ends; for jobs whose results are written out.

    Blocks may be nested; a table belongs to the innermost one.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        remove(spark, paths)
