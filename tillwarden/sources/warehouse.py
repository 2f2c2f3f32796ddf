"""The three Parquet tables of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwarden import schemas
from tillwarden.sources.snapshots import Snapshots

RAW = "transactions_raw"
PROCESSED = "transactions_processed"
ALERTS = "fraud_alerts"
PARTITION = "processing_date"

LAYOUTS = {
    RAW: schemas.TRANSACTION,
    PROCESSED: schemas.PROCESSED,
    ALERTS: schemas.ALERT_TABLE,
}


def _ddl(layout: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create what is missing; ``location`` puts the files outside the warehouse folder."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {where}")
    for name, layout in LAYOUTS.items():
        partitioned = f"PARTITIONED BY ({PARTITION})" if PARTITION in layout.names else ""
        placed = f"LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_ddl(layout)}) "
            f"USING parquet {partitioned} {placed}"
        )


def in_layout(rows: DataFrame, name: str) -> DataFrame:
    """Columns picked by name and put in the table's order."""
    return rows.select(*LAYOUTS[name].names)


def location(spark: SparkSession, database: str, name: str) -> str:
    """The folder of a table."""
    described = spark.sql(f"DESCRIBE EXTENDED {database}.{name}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def snapshots(spark: SparkSession, database: str, name: str) -> Snapshots:
    """The versions of a table that is replaced as a whole, beside the table's own folder."""
    return Snapshots(spark, f"{location(spark, database, name)}_versions")


def replace_partitions(
    rows: DataFrame, database: str, name: str, many_dates: bool = True, whole: bool = False
) -> None:
    """Overwrite the dates in ``rows`` and leave the others: a rerun adds no duplicates.

    ``whole`` replaces the table, dates that ``rows`` lack included. A rebuild of
    all rows needs that: under a run date, rows would else stay under the dates of
    earlier runs as well. The rows are written as a new version and the table is
    switched to it in one step: a run that breaks off leaves the old rows, and no
    reader meets an empty table. From then on :func:`table` reads the version, as does
    the view ``<name>_current``, and dates are replaced inside it.

    With many dates, rebalancing brings each date's rows together, so a date is
    a few files and not one per task; AQE splits a date too big for one task.
    Rows of a single date need no shuffle for that.
    """
    spark = rows.sparkSession
    rows = in_layout(rows, name)
    if many_dates:
        rows = rows.hint("rebalance", PARTITION)
    versions = snapshots(spark, database, name)
    if whole:
        folder = versions.publish(rows, [PARTITION])
        columns = ", ".join(f"`{c}`" for c in LAYOUTS[name].names)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name}_current AS SELECT {columns} FROM parquet.`{folder}`")
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        folder = versions.current()
        if folder:
            rows.write.mode("overwrite").partitionBy(PARTITION).parquet(folder)
        else:
            rows.write.mode("overwrite").insertInto(f"{database}.{name}")
    finally:
        spark.conf.set(mode, before)


def append_stream(
    rows: DataFrame, database: str, name: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append a stream exactly once: the file sink's log skips a batch it has written.

    ``once`` takes what is there now and stops.
    """
    rows = in_layout(rows, name)
    partitioned = PARTITION in rows.columns
    if partitioned:
        # A date is spread over some of the tasks: not one file per date and task,
        # and no task with a whole date, or with all copies of one row.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        place = F.xxhash64(rows.columns[0], F.spark_partition_id())
        rows = rows.repartition(PARTITION, F.pmod(place, F.lit(max(4, tasks // 16))))
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if partitioned:
        writer = writer.partitionBy(PARTITION)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(f"{database}.{name}")


def open_alerts(spark: SparkSession, database: str) -> Snapshots:
    """The alerts of windows that were open when the detection stream last stopped."""
    return Snapshots(spark, f"{location(spark, database, ALERTS)}_open")


def repaired_alerts(spark: SparkSession, database: str) -> Snapshots:
    """The alerts raised by late rows, and those of the windows they changed."""
    return Snapshots(spark, f"{location(spark, database, ALERTS)}_repaired")


def alerts(spark: SparkSession, database: str) -> DataFrame:
    """The alert table as corrected by late rows, and the alerts of open windows that it does not have yet.

    An alert of an open window may still grow; once the table has the id, it is final.
    """
    found = table(spark, database, ALERTS)
    for versions, first in ((repaired_alerts, True), (open_alerts, False)):
        other = versions(spark, database).read(LAYOUTS[ALERTS])
        if other is None:
            continue
        above, below = (other, found) if first else (found, other)
        ids = above.select("alert_id").distinct()
        found = above.unionByName(below.join(ids, "alert_id", "left_anti"))
    return found


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The rows of a table; of one replaced as a whole, those of its current version."""
    return snapshots(spark, database, name).read(LAYOUTS[name]) or spark.table(f"{database}.{name}")
