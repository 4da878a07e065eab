"""Versioned Parquet tables: a batch is written to a new version, then a pointer moves.

Readers see whole versions only; a batch that fails leaves the pointer where it was.
The pointer names the batch that made the version, so a batch that comes again
after a restart is skipped. A ``VersionedSet`` has one pointer for several tables:
a batch reaches all of them at once, or none.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class _Pointed:
    """A folder whose file CURRENT says what counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _pointer(self) -> dict | None:
        fs, path = self._fs(f"{self.path}/CURRENT")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            raw = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return json.loads(raw)

    def _point(self, value: dict) -> None:
        """Written beside and renamed over, so that it is never seen half-written."""
        fs, new = self._fs(f"{self.path}/CURRENT.new")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        _, current = self._fs(f"{self.path}/CURRENT")
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(new, current, options)

    @property
    def batch(self) -> int:
        """The last batch that was written; -1 before any."""
        found = self._pointer()
        return found["batch"] if found else -1

    def drop(self) -> None:
        fs, path = self._fs(self.path)
        fs.delete(path, True)

    def _remove(self, path: str) -> None:
        fs, old = self._fs(path)
        fs.delete(old, True)


class VersionedTable(_Pointed):
    @property
    def version(self) -> int:
        found = self._pointer()
        return found["version"] if found else -1

    def read(self) -> DataFrame | None:
        found = self._pointer()
        return self.spark.read.parquet(f"{self.path}/v={found['version']}") if found else None

    def write(self, df: DataFrame, batch: int = -1) -> int:
        """The table's next version; older ones but the last go."""
        now = self.version
        df.write.mode("overwrite").parquet(f"{self.path}/v={now + 1}")
        self._point({"version": now + 1, "batch": batch})
        if now > 0:
            self._remove(f"{self.path}/v={now - 1}")
        return now + 1


class VersionedSet(_Pointed):
    """Several tables under one pointer."""

    def versions(self) -> dict[str, int]:
        found = self._pointer()
        return found["versions"] if found else {}

    def read(self, name: str) -> DataFrame | None:
        version = self.versions().get(name)
        return None if version is None else self.spark.read.parquet(f"{self.path}/{name}/v={version}")

    def write(self, frames: dict[str, DataFrame], batch: int) -> None:
        """New versions of some tables; the others keep theirs. All of it counts once the pointer has moved."""
        now = self.versions()
        new = dict(now)
        for name, df in frames.items():
            new[name] = now.get(name, -1) + 1
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/v={new[name]}")
        self._point({"batch": batch, "versions": new})
        for name in frames:
            if now.get(name, 0) > 0:
                self._remove(f"{self.path}/{name}/v={now[name] - 1}")
