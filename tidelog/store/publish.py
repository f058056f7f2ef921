"""Publishing a folder of files in one step.

A published table is a folder with one sub-folder per version and a small pointer file, CURRENT, naming the version
that readers take. Writers fill a new sub-folder, then replace the pointer by a rename, which the file system does as
one step: readers see the old table or the new one, never a part. One writer at a time is assumed; a job that dies
leaves an unnamed sub-folder behind, which vacuum() removes.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


class Published:
    """A table at `root` (any path Hadoop's file systems know)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str = "") -> Any:
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self) -> Any:
        return self._path().getFileSystem(self._conf)

    def current(self) -> dict[str, Any] | None:
        """What the pointer says, or None where nothing was published yet."""
        fs = self._fs()
        if not fs.exists(self._path(POINTER)):
            return None
        stream = fs.open(self._path(POINTER))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def stage(self) -> str:
        """A fresh sub-folder's name; what is written there is seen by nobody until publish()."""
        return f"v-{uuid.uuid4().hex}"

    def publish(self, version: str, **facts: Any) -> dict[str, Any]:
        """Makes `version` the one that readers take; facts are kept beside its name."""
        before = self.current() or {"number": 0}
        now = {"version": version, "number": before["number"] + 1, **facts}
        fresh = self._path(f"{POINTER}.{uuid.uuid4().hex}")
        out = self._fs().create(fresh, True)
        try:
            out.write(bytearray(json.dumps(now).encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(self._path().toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(
            self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1
        )
        options[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fresh, self._path(POINTER), options)
        return now

    def read(self) -> DataFrame | None:
        now = self.current()
        return None if now is None else self.spark.read.parquet(f"{self.root}/{now['version']}")

    def vacuum(self) -> int:
        """Removes versions that the pointer names neither as the current one nor among its parts. Call it when no reader
        still uses one. Returns how many."""
        now, fs, gone = self.current(), self._fs(), 0
        if now is None:
            return 0
        for entry in fs.listStatus(self._path()):
            name = entry.getPath().getName()
            if name.startswith("v-") and name not in (now["version"], *now.get("parts", ())):
                gone += bool(fs.delete(entry.getPath(), True))
        return gone
