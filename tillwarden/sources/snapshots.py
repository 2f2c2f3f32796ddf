"""Tables replaced as a whole: versions side by side, and a pointer that is switched in one step.

A version is written to a folder of its own, so a run that breaks off leaves the
current one as it was, and a reader meets either the old rows or the new ones. Some old
versions stay for readers that still hold them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_current"


@dataclass(frozen=True)
class Snapshots:
    """All versions of one table below ``root``, of which the newest ``keep`` stay."""

    spark: SparkSession
    root: str
    keep: int = 2

    def _path(self, *parts: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))

    def _files(self) -> Any:
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self) -> dict | None:
        if not self._files().exists(self._path(POINTER)):
            return None
        stream = self._files().open(self._path(POINTER))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> str | None:
        """The folder of the current version; None before the first."""
        found = self._pointer()
        return found and f"{self.root.rstrip('/')}/{found['version']}"

    def note(self) -> dict:
        """What was noted with the current version."""
        return (self._pointer() or {}).get("note", {})

    def read(self, layout: T.StructType | str) -> DataFrame | None:
        folder = self.current()
        return folder and self.spark.read.schema(layout).parquet(folder)

    def publish(self, rows: DataFrame, partition_by: Sequence[str] = (), note: dict | None = None) -> str:
        """Write a version, make it the current one together with its note, and remove the oldest."""
        version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.root.rstrip('/')}/{version}"
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(folder)
        self.switch(version, note)
        self.clean()
        return folder

    def switch(self, version: str, note: dict | None = None) -> None:
        """Make a written version the current one: a pointer file is renamed over the old one."""
        text = json.dumps({"version": version, "note": note or {}})
        fresh = self._path(f"{POINTER}-{uuid.uuid4().hex[:8]}")
        stream = self._files().create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path().toUri(), self.spark._jsc.hadoopConfiguration()
        )
        context.rename(context.makeQualified(fresh), context.makeQualified(self._path(POINTER)), options)

    def versions(self) -> list[str]:
        """The written versions, oldest first."""
        if not self._files().exists(self._path()):
            return []
        names = (status.getPath().getName() for status in self._files().listStatus(self._path()))
        return sorted(n for n in names if n.startswith("v-"))

    def clean(self) -> None:
        """Remove the oldest versions, and what runs that broke off have left behind them.

        Only versions older than the current one go: a newer one may be another run's, just being written.
        """
        current = (self._pointer() or {}).get("version", "")
        older = [v for v in self.versions() if v < current]
        for version in older[: max(0, len(older) - (self.keep - 1))]:
            self._files().delete(self._path(version), True)
