"""Late rows: split off before the window aggregate, and the windows they change raised anew."""

from __future__ import annotations

import datetime as dt
import json

import pytest
import samples
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.operators.alerts import all_alerts
from tillwarden.sources import warehouse
from tillwarden.streaming import detect
from tillwarden.streaming.late import Intake

LAYOUT = schemas.T.StructType(
    [f for f in schemas.TRANSACTION if f.name in schemas.RULE_FIELDS]
    + [schemas.T.StructField("event_time", schemas.T.TimestampType())]
)


@pytest.fixture
def setting(spark, tmp_path, request):
    database = "l_" + request.node.name.lower()
    warehouse.create_tables(spark, database, str(tmp_path / "tables"))
    intake = Intake(spark, str(tmp_path / "intake"), LAYOUT, lateness=dt.timedelta(minutes=5))
    (tmp_path / "topic").mkdir()
    return intake, database, tmp_path


def _send(tmp_path, *rows):
    topic = tmp_path / "topic"
    lines = [json.dumps(dict(zip(schemas.TRANSACTION.names, row))) for row in rows]
    (topic / f"{len(list(topic.iterdir())):03d}.txt").write_text("\n".join(lines) + "\n")


def _run(spark, intake, database, tmp_path):
    good, _ = detect.usable_transactions(spark.readStream.text(str(tmp_path / "topic")))
    intake.start(good, once=True).awaitTermination()
    found = detect.detect(intake.in_time(), lateness="5 minutes")
    query = warehouse.append_stream(found, database, warehouse.ALERTS, str(tmp_path / "c"), once=True)
    query.awaitTermination()
    return sum(
        int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
    )


def _burst(user, n, start=0, seconds=0, amount=10.0):
    return [samples.wire_row(f"{user}{i}", user, amount, at=samples.clock(seconds + i)) for i in range(start, n)]


def _same(spark, intake, database):
    found = warehouse.alerts(spark, database).drop("alert_timestamp")
    batch = all_alerts(intake.rows().select(*LAYOUT.names)).drop("alert_timestamp")
    assert found.exceptAll(batch).isEmpty() and batch.exceptAll(found).isEmpty()
    return found


def test_late_rows_and_table_make_the_batch_result(spark, setting):
    intake, database, tmp_path = setting
    repair = lambda: intake.repair(database, str(tmp_path / "repair"))
    _send(tmp_path, *_burst("grows", 5), *_burst("appears", 3), *_burst("stays", 4))
    assert _run(spark, intake, database, tmp_path) == 0
    _send(tmp_path, samples.wire_row("on", "x", at=samples.clock(900)))
    assert _run(spark, intake, database, tmp_path) == 0
    repair()  # nothing is late yet
    assert intake.late_rows().isEmpty()
    late = [*_burst("grows", 7, 5), *_burst("appears", 5, 3), *_burst("new", 4), samples.wire_row("big", "z", 9000.0, at=samples.clock(7))]
    _send(tmp_path, *late, *_burst("in time", 4, seconds=700), samples.wire_row("flush", "n", at=samples.clock(9000)))
    assert _run(spark, intake, database, tmp_path) == 0
    _send(tmp_path, samples.wire_row("flush 2", "n", at=samples.clock(9001)))
    assert _run(spark, intake, database, tmp_path) == 0
    assert {r.transaction_id for r in intake.late_rows().collect()} == {r[0] for r in late}
    starts = {r.start for r in intake.late_rows().collect()}
    assert starts == {dt.datetime(2024, 3, 1)}
    for _ in range(2):
        repair()
        found = _same(spark, intake, database)
    counts = {r.user_id: r.transaction_count for r in found.where("alert_type = 'RAPID_TRANSACTIONS'").collect()}
    assert counts == {"grows": 7, "appears": 5, "stays": 4, "new": 4, "in time": 4}
    assert found.where("alert_type = 'HIGH_AMOUNT'").count() == 1


def test_a_batch_that_comes_again_is_taken_once(spark, setting):
    intake, database, tmp_path = setting
    first = samples.transactions(spark, _burst("a", 4)).withColumn("event_time", F.to_timestamp("timestamp"))
    later = samples.transactions(spark, [samples.wire_row("l", "b", at=samples.clock(9000))])
    later = later.withColumn("event_time", F.to_timestamp("timestamp"))
    intake.take(first, 0)
    intake.take(later, 1)
    intake.take(first, 2)  # late by now
    want = sorted(map(repr, intake.rows().collect()))
    for again in (first, first):
        intake.take(again, 2)
    assert sorted(map(repr, intake.rows().collect())) == want
    assert intake.rows().where("late").count() == 4 and intake.rows().count() == 9
    unknown = first.withColumn("event_time", F.lit(None).cast("timestamp"))
    intake.take(unknown, 3)
    assert intake.rows().where("batch = 3 AND NOT late").count() == 4
