"""Late rows apart: an intake that marks them, and a repair of the windows they belong to.

A window aggregate drops rows behind the watermark and only counts them. Here the
intake decides: each batch of arriving rows is judged by the newest time of the
batches before it and written as one folder, late rows beside the others. Detection
reads the rows in time; as a folder appears as a whole, its own watermark is never ahead of the
intake's, and it drops none of them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwarden.config import RuleConfig
from tillwarden.operators.alerts import burst_alerts, bursts, in_table_layout, point_alerts
from tillwarden.sources import warehouse
from tillwarden.sources.snapshots import Snapshots

LATENESS = dt.timedelta(minutes=10)


@dataclass(frozen=True)
class Intake:
    """Arriving rows below ``folder``; ``layout`` are their columns, with ``event_time``."""

    spark: SparkSession
    folder: str
    layout: T.StructType
    lateness: dt.timedelta = LATENESS
    cfg: RuleConfig = RuleConfig()

    @property
    def _state(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.folder}/newest")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def start(self, rows: DataFrame, once: bool = False) -> StreamingQuery:
        """Take in a stream of rows."""
        writer = rows.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.folder}/checkpoint")
        return (writer.trigger(availableNow=True) if once else writer).start()

    def take(self, rows: DataFrame, batch: int) -> None:
        """Write one batch, marked by the newest time before it, and remember the newest time.

        A batch that comes again is judged as the first time, and if its folder is
        there it is complete and stays: no row is taken in twice.
        """
        note = self._state.note()
        before = note.get("before" if note.get("batch") == batch else "newest")
        target, written = self._path("rows", f"batch={batch}"), self._path(f"writing-{batch}")
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(target):
            marked = rows.select(*self.layout.names, self._is_late(before).alias("late"))
            marked.write.mode("overwrite").partitionBy("late").parquet(written.toString())
            files.mkdirs(target.getParent())
            if not files.rename(written, target):
                raise OSError(f"cannot move a batch to {target}")
        taken = self.spark.read.schema(self.layout).parquet(target.toString())
        newest = taken.agg(F.date_format(F.max("event_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()[0]
        newest = max(filter(None, (before, newest)), default=None)
        self._state.publish(self.spark.range(1), note={"batch": batch, "before": before, "newest": newest})

    def _is_late(self, newest: str | None):
        if newest is None:
            return F.lit(False)
        mark = dt.datetime.fromisoformat(newest) - self.lateness
        mark = F.lit(mark.isoformat(sep=" ")).cast("timestamp")
        # Rows without a time are in time; a window of such a time would drop them.
        end = F.window(F.coalesce("event_time", mark), self.cfg.rapid_window)["end"]
        return F.col("event_time").isNotNull() & (end <= mark)

    def _marked(self) -> T.StructType:
        return T.StructType([*self.layout.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])

    def in_time(self) -> DataFrame:
        """The rows in time as a stream, whole batches at once."""
        # The folder must be there for a stream to begin, and paths must name the mark for files to be left out.
        self._path("rows").getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(self._path("rows"))
        stream = self.spark.readStream.schema(self.layout).option("basePath", f"{self.folder}/rows")
        return stream.parquet(f"{self.folder}/rows/batch=*/late=false")

    def rows(self) -> DataFrame:
        """All rows taken in, with ``batch`` and ``late``."""
        return self.spark.read.schema(self._marked()).parquet(f"{self.folder}/rows")

    def late_rows(self) -> DataFrame:
        """The late rows, each with the start and end of its window."""
        late = self.rows().where("late")
        slot = F.window("event_time", self.cfg.rapid_window)
        return late.withColumn("slot", slot).select("*", "slot.start", "slot.end").drop("slot")

    def repair(self, database: str, folder: str) -> None:
        """Raise the alerts of late rows, and raise anew those of the windows they belong to.

        The windows are counted again over all rows taken in, of which only those of
        the days between the first and the last such window are read. They become a
        version beside the alert table that takes precedence over it (:func:`warehouse.alerts`); a
        later repair replaces it.
        """
        late = self.late_rows()
        changed = late.where("user_id IS NOT NULL").select("user_id", "start").distinct()
        changed.write.mode("overwrite").parquet(f"{folder}/changed")
        changed = self.spark.read.schema(changed.schema).parquet(f"{folder}/changed")
        span = late.agg(F.min("start"), F.max("end")).first()
        if span[0] is None:
            return
        slot = F.window("event_time", self.cfg.rapid_window)["start"]
        rows = self.rows().where(F.col("event_time").between(*map(F.lit, span))).withColumn("start", slot)
        again = bursts(rows.join(changed, ["user_id", "start"], "left_semi"), F.col("start"), self.cfg, "event_time")
        found = in_table_layout(point_alerts(late, self.cfg)).unionByName(in_table_layout(burst_alerts(again, self.cfg)))
        warehouse.repaired_alerts(self.spark, database).publish(found)
