"""Keyed tables that an upsert rewrites only where it touches them.

Rows lie in hash buckets of their key, each a folder.  An upsert reads the buckets its keys fall into, writes these anew
and then a manifest that names the folder of every bucket; buckets it does not touch keep their files.  A manifest is
made beside and renamed into place, so readers see either all of an upsert or none of it, and two writers that started
from the same version cannot both win.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimlens.sources.readers import path_exists
from claimlens.sources.writers import upsert


@dataclass
class KeyedTable:
    """Table under ``path`` with unique ``key``; ``buckets`` is fixed when it is first written."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    def _fs(self):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{name}")

    def _manifest(self) -> dict:
        """The newest version: its number, the schema, the number of buckets and the folder of each bucket."""
        if not path_exists(self.spark, f"{self.path}/manifests"):
            return {"version": 0, "buckets": self.buckets, "schema": None, "folders": {}}
        names = [s.getPath().getName() for s in self._fs().listStatus(self._file(""))]
        newest = max((n for n in names if n.startswith("v")), default=None)
        if newest is None:
            return {"version": 0, "buckets": self.buckets, "schema": None, "folders": {}}
        stream = self._fs().open(self._file(newest))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        beside, final = self._file(f"new-{uuid.uuid4().hex}"), self._file(f"v{manifest['version']:012d}")
        stream = self._fs().create(beside)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if self._fs().exists(final) or not self._fs().rename(beside, final):
            self._fs().delete(beside, False)
            raise RuntimeError("another writer has changed the table meanwhile; apply the updates again")

    def _read(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame | None:
        folders = [f"{self.path}/data/{f}" for b, f in manifest["folders"].items() if wanted is None or int(b) in wanted]
        if not folders:
            return None
        return self.spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(*folders)

    def read(self) -> DataFrame:
        manifest = self._manifest()
        found = self._read(manifest)
        if found is None:
            raise ValueError("the table has not been written")
        return found

    def upsert(self, updates: DataFrame, order: str | None = None) -> None:
        """Set, per key, the fields that ``updates`` supply, as ``writers.upsert`` does; unknown keys are inserted.

        Updates without a key are left out.
        """
        manifest = self._manifest()
        number = F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(manifest["buckets"])).cast("int")
        updates = updates.where(F.col(self.key).isNotNull())
        touched = {row[0] for row in updates.select(number.alias("b")).distinct().collect()}  # at most one per bucket
        if not touched and manifest["version"]:
            return
        old = self._read(manifest, touched)
        if old is None:
            kept = [c for c in updates.columns if c != order]
            if manifest["schema"] is not None:
                old = self.spark.createDataFrame([], StructType.fromJson(manifest["schema"]))
            else:
                old = updates.select(*kept).limit(0)
        new = upsert(old, updates, self.key, order)
        folder = uuid.uuid4().hex
        new.withColumn("_bucket", number).repartition(F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        folders = manifest["folders"] | {str(b): f"{folder}/_bucket={b}" for b in touched}
        self._publish({
            "version": manifest["version"] + 1, "buckets": manifest["buckets"], "schema": json.loads(new.schema.json()), "folders": folders,
        })

    def vacuum(self) -> None:
        """Remove folders and manifests that the newest version does not use."""
        manifest = self._manifest()
        used = set(manifest["folders"].values())
        data = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        for written in self._fs().listStatus(data):
            for bucket in self._fs().listStatus(written.getPath()):
                name = f"{written.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and name not in used:
                    self._fs().delete(bucket.getPath(), True)
        for status in self._fs().listStatus(self._file("")):
            if status.getPath().getName() != f"v{manifest['version']:012d}":
                self._fs().delete(status.getPath(), False)
