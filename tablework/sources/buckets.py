"""A keyed table on plain parquet of which a change rewrites only the buckets it touches.

Rows lie in hash buckets of their key. Every change writes the touched buckets to a folder of its own and then commits a
new version: a small file that names the folder of each bucket. Buckets that were not touched keep their files. Readers
see the version they opened; a change that fails leaves files that no version names; of two changes made from the same
version one fails, because a version file is created only once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 64
_BUCKET = "_bucket"


class ChangedMeanwhile(RuntimeError):
    """Another writer committed a version first; read again and repeat the change."""


class BucketTable:
    """A table of ``keys`` below ``path``; choose so many buckets that one of them is about a file (some 256 MB)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    # versions

    def version(self) -> int:
        """Number of the last commit, 0 for a table that was not made yet."""
        folder = self._at("versions")
        if not self._files.exists(folder):
            return 0
        # a file without content is still being written
        done = [f.getPath().getName() for f in self._files.listStatus(folder) if f.getLen()]
        return max((int(name) for name in done if name.isdigit()), default=0)

    def _state(self, version: int) -> dict:
        return json.loads("\n".join(r["value"] for r in self.spark.read.option("wholetext", True).text(f"{self.path}/versions/{version}").collect()))

    def _commit(self, version: int, state: dict):
        try:
            out = self._files.create(self._at(f"versions/{version}"), False)
        except Py4JJavaError as error:
            if not self._files.exists(self._at(f"versions/{version}")):
                raise
            raise ChangedMeanwhile(f"version {version} of {self.path} is there already") from error
        out.write(bytearray(json.dumps(state).encode()))
        out.close()

    # rows

    def _bucket(self, keys: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, keys: list[str], buckets: int) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        placed = rows.withColumn(_BUCKET, self._bucket(keys, buckets))
        placed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def _written(self, folder: str) -> set[str]:
        names = [f.getPath().getName() for f in self._files.listStatus(self._at(folder))]
        return {n.split("=")[1] for n in names if n.startswith(f"{_BUCKET}=")}

    def _rows(self, state: dict, chosen=None) -> DataFrame:
        paths = [f"{self.path}/{folder}/{_BUCKET}={b}" for b, folder in state["folders"].items() if chosen is None or b in chosen]
        schema = state["schema"]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def create(self, rows: DataFrame, keys: list[str], buckets: int = BUCKETS) -> BucketTable:
        """Write all rows as the first version."""
        folder = self._write(rows, keys, buckets)
        state = {"keys": keys, "buckets": buckets, "schema": rows._jdf.schema().toDDL(), "folders": {b: folder for b in self._written(folder)}}
        self._commit(1, state)
        return self

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self._state(version or self.version()))

    def rewrite(self, changed: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the rows of every bucket that holds a key of ``changed`` by ``change(their rows)``; the new version.

        ``change`` must keep the rows of the keys it does not mean to change, and may add rows with keys of ``changed``.
        """
        version = self.version()
        state = self._state(version)
        keys, buckets = state["keys"], state["buckets"]
        # as many numbers as there are buckets at most
        touched = {str(r[0]) for r in changed.select(self._bucket(keys, buckets)).distinct().collect()}
        if not touched:
            return version
        columns = self.spark.createDataFrame([], state["schema"]).columns
        folder = self._write(change(self._rows(state, touched)).select(*columns), keys, buckets)
        written = self._written(folder)
        if strays := written - touched:
            raise ValueError(f"rows for buckets that were not to change: {sorted(strays)}")
        folders = {b: f for b, f in state["folders"].items() if b not in touched} | {b: folder for b in written}
        self._commit(version + 1, state | {"folders": folders})
        return version + 1

    def files(self) -> list[str]:
        return sorted(self.read().inputFiles())

    def drop_unused(self, keep_versions: int = 1):
        """Delete what only older versions name; no reader or change may be at work on them."""
        last = self.version()
        kept = set()
        for v in range(max(1, last - keep_versions + 1), last + 1):
            kept |= set(self._state(v)["folders"].values())
        for folder in self._files.listStatus(self._at("data")):
            if f"data/{folder.getPath().getName()}" not in kept:
                self._files.delete(folder.getPath(), True)
        for v in range(1, last - keep_versions + 1):
            self._files.delete(self._at(f"versions/{v}"), False)
