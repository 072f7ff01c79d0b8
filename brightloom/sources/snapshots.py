"""Stored tables that change by whole snapshots: immutable data folders and a manifest switched last.

A table lies in buckets by a hash of its key. A write puts the new rows of the buckets it
touches into a new folder and then adds a numbered manifest that says where every bucket
lies; the highest manifest is the table. A reader keeps the files of the manifest it
read, a write that fails midway leaves the old state, and of two writers of one version
the second one fails: a manifest is moved into place whole and never replaced.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightloom.session import written

BUCKETS = 64


class Conflict(RuntimeError):
    """Somebody else has written the version that was to be written."""


class SnapshotTable:
    """Rows by a string key in the folder `path`; a path without a manifest is an empty table."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _bucket(self, key: Column) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(key), F.lit(self.buckets)), F.lit(0)).cast("int")

    def version(self) -> int:
        """Number of the current manifest, 0 before the first write."""
        if not self._files.exists(self._path("manifest")):
            return 0
        names = [status.getPath().getName() for status in self._files.listStatus(self._path("manifest"))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _folders(self, version: int) -> dict[str, str]:
        """Where each bucket lies."""
        if version == 0:
            return {}
        stream = self._files.open(self._path(f"manifest/{version:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _rows(self, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/data/{folder}/_bucket={bucket}" for bucket, folder in folders.items()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the current, or of an earlier, version."""
        return self._rows(self._folders(self.version() if version is None else version))

    def get(self, key: str) -> DataFrame:
        """The rows of one key, from its bucket."""
        bucket = str(self.spark.range(1).select(self._bucket(F.lit(key))).first()[0])
        folders = self._folders(self.version())
        return self._rows({b: f for b, f in folders.items() if b == bucket}).filter(F.col(self.key) == key)

    def put(self, rows: DataFrame, written_at: str | None = None, version: int | None = None) -> int:
        """Rows replace all stored rows of their keys; gives the new version.

        With `written_at` the row with the highest such value stays for each key. `version`
        is the one that `rows` were worked out from (the current one, if not given).
        Buckets that the rows do not touch keep their files.
        """
        before = self.version() if version is None else version
        folders, name = self._folders(before), uuid4().hex
        fresh = written(rows.select(*self.schema.names).withColumn("_bucket", self._bucket(F.col(self.key))), "put")
        touched = [str(r[0]) for r in fresh.select("_bucket").distinct().collect()]  # at most one row per bucket
        stored = self._rows({b: f for b, f in folders.items() if b in touched})
        stored = stored.withColumn("_bucket", self._bucket(F.col(self.key)))
        if written_at is None:
            replaced = fresh.select(F.col(self.key).alias("_key")).distinct()
            kept = stored.join(replaced, F.col(self.key).eqNullSafe(F.col("_key")), "left_anti").unionByName(fresh)
        else:
            others = [c for c in (*self.schema.names, "_bucket") if c != self.key]
            both = stored.unionByName(fresh).groupBy(self.key)
            kept = both.agg(F.max_by(F.struct(*others), written_at).alias("_v")).select(self.key, "_v.*")
        if touched:
            kept.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{name}")
        self._switch(before + 1, folders | dict.fromkeys(touched, name))
        return before + 1

    def clear(self) -> int:
        """A version without rows; earlier ones can still be read."""
        before = self.version()
        self._switch(before + 1, {})
        return before + 1

    def _switch(self, version: int, folders: dict[str, str]) -> None:
        pending = self._path(f"manifest/_{uuid4().hex}")
        stream = self._files.create(pending, False)
        try:
            stream.write(bytearray(json.dumps(folders).encode()))
        finally:
            stream.close()
        rename = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        context = self._hadoop.FileContext.getFileContext(pending.toUri(), self._conf)
        try:
            # Without the overwrite option the move fails where the manifest is there already.
            context.rename(pending, self._path(f"manifest/{version:012d}"), rename)
        except Exception as error:
            self._files.delete(pending, False)
            raise Conflict(f"version {version} of {self.path} was written by somebody else") from error
