from __future__ import annotations

import json

import pytest
import samples
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.config import RuleConfig
from tillwarden.operators.alerts import all_alerts
from tillwarden.operators.routing import notifications
from tillwarden.sources import messages, sample, warehouse
from tillwarden.streaming import detect, monitor

NAMES = schemas.TRANSACTION.names


class Topic:
    """A folder of text files standing in for a topic."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0
        folder.mkdir()

    def send(self, *rows, raw=()):
        lines = [json.dumps(dict(zip(NAMES, row))) for row in rows] + list(raw)
        (self.folder / f"{self.sent:04d}.txt").write_text("\n".join(lines) + "\n")
        self.sent += 1

    def stream(self):
        return self.spark.readStream.text(str(self.folder))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def database(spark, tmp_path, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    warehouse.create_tables(spark, name, str(tmp_path / "tables"))
    return name


def _run(topic, database, tmp_path, lateness="0 seconds"):
    query = detect.start_to_table(
        topic.stream(), database, str(tmp_path / "checkpoint"), lateness=lateness, once=True
    )
    query.awaitTermination()
    return query


def _stored(spark, database):
    return warehouse.table(spark, database, warehouse.ALERTS)


def _bursts(spark, database):
    rows = _stored(spark, database).where("alert_type = 'RAPID_TRANSACTIONS'").collect()
    return [(r.user_id, r.transaction_count, r.last_transaction_id) for r in rows]


def _later(seconds=7200):
    return samples.wire_row("flush", "nobody", at=samples.clock(seconds))


def test_stream_gives_the_batch_result(spark, topic, database, tmp_path):
    rows = [
        *samples.burst_rows(),
        *[
            samples.wire_row(i, f"user {i}", a, place, samples.NOON, h)
            for i, a, place, h, _, _ in samples.BOUNDARY
            if None not in (a, place, h)
        ],
    ]
    topic.send(*rows)
    topic.send(samples.wire_row("flush", "nobody", at="2024-03-02T00:00:00"))
    _run(topic, database, tmp_path)
    batch = all_alerts(samples.transactions(spark, rows)).drop("alert_timestamp")
    stream = _stored(spark, database).drop("alert_timestamp")
    assert stream.exceptAll(batch).isEmpty()
    assert batch.exceptAll(stream).isEmpty()
    assert set(_bursts(spark, database)) == samples.EXPECTED_BURSTS


def test_restart_continues_a_window_without_duplicates(spark, topic, database, tmp_path):
    """A user's four rows arrive over two runs; later runs add nothing."""
    four = [row for row in samples.burst_rows() if row[1] == "u2"]
    topic.send(*four[:3], samples.wire_row("big", "z", 9000.0, at=samples.clock(5)))
    _run(topic, database, tmp_path, lateness="1 minute")
    assert _bursts(spark, database) == []
    topic.send(four[3])
    _run(topic, database, tmp_path, lateness="1 minute")
    topic.send(_later())
    _run(topic, database, tmp_path, lateness="1 minute")
    _run(topic, database, tmp_path, lateness="1 minute")
    assert _bursts(spark, database) == [("u2", 4, "q59")]
    ids = [r.alert_id for r in _stored(spark, database).collect()]
    assert len(ids) == len(set(ids)) == 2


def test_rows_behind_the_watermark_do_not_count(spark, topic, database, tmp_path):
    first = [samples.wire_row(f"a{i}", "late", at=samples.clock(i)) for i in range(3)]
    topic.send(*first, samples.wire_row("on", "x", at=samples.clock(200)))
    _run(topic, database, tmp_path, lateness="5 minutes")
    topic.send(samples.wire_row("a3", "late", at=samples.clock(30)))
    _run(topic, database, tmp_path, lateness="5 minutes")
    topic.send(_later())
    _run(topic, database, tmp_path, lateness="5 minutes")
    assert _bursts(spark, database) == [("late", 4, "a3")]
    topic.send(*[samples.wire_row(f"b{i}", "too late", at=samples.clock(i)) for i in range(4)])
    topic.send(_later(20000))
    _run(topic, database, tmp_path, lateness="5 minutes")
    assert _bursts(spark, database) == [("late", 4, "a3")]


def test_bad_messages_go_to_the_rejects(spark, topic, database, tmp_path):
    topic.send(samples.wire_row("ok", "u", 9000.0), raw=["not json", '{"transaction_id": "x"}'])
    _run(topic, database, tmp_path)
    assert [r.transaction_id for r in _stored(spark, database).collect()] == ["ok"]
    folder = str(tmp_path / "rejects")
    detect.start_rejects(
        topic.stream(), folder, str(tmp_path / "rejects-checkpoint"), once=True
    ).awaitTermination()
    reasons = sorted(r.reject_reason for r in spark.read.json(folder).collect())
    assert reasons[0] == "malformed"
    assert reasons[1].startswith("missing: user_id")


def test_monitor_routes_audits_and_responds(spark, topic, database, tmp_path):
    topic.send(
        samples.wire_row("huge", "a", 20000.0),
        samples.wire_row("large", "b", 6000.0),
        samples.wire_row("lost", "c", 5.0, "Unknown Location"),
    )
    _run(topic, database, tmp_path)
    found = spark.readStream.table(f"{database}.{warehouse.ALERTS}")
    out = str(tmp_path / "out")
    for _ in range(2):
        running = monitor.start_monitor(found, out, str(tmp_path / "monitor"), once=True)
        for query in running.values():
            query.awaitTermination()
    sent = {(r.user_id, r.channel) for r in spark.read.json(f"{out}/notifications").collect()}
    assert sent == {("a", "email"), ("a", "sms"), ("a", "slack"), ("c", "email")}
    assert spark.read.json(f"{out}/notifications").count() == 4
    assert spark.read.json(f"{out}/audit").count() == 3
    assert [r.user_id for r in spark.read.json(f"{out}/responses").collect()] == ["a"]


def test_arrival_time_detection(spark, tmp_path):
    """Windows on the broker's clock: four rows of one minute, hours apart in event time."""
    folder = tmp_path / "arrivals"
    rows = [
        (json.dumps(dict(zip(NAMES, samples.wire_row(f"t{i}", "u", at=samples.clock(i * 4000))))), i)
        for i in range(4)
    ] + [(json.dumps(dict(zip(NAMES, _later()))), 7200)]
    spark.createDataFrame(rows, "value string, s int").selectExpr(
        "value", "timestamp'2024-05-05 10:00:00' + make_interval(0,0,0,0,0,0,s) AS timestamp"
    ).coalesce(1).write.parquet(str(folder))
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(str(folder))
    good, _ = detect.usable_transactions(stream, time_column="arrived")
    query = (
        detect.detect(good, lateness="0 seconds", time_column="arrived")
        .writeStream.format("memory")
        .queryName("arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.table("arrivals").collect()
    assert [(r.alert_type, r.transaction_count) for r in found] == [("RAPID_TRANSACTIONS", 4)]


def test_sample_stream_equals_sample_batch(spark, small, tmp_path):
    cfg = RuleConfig(rapid_window="1 day")
    query = (
        detect.detect(sample.transaction_stream(spark, small), cfg, lateness="1 day")
        .drop("alert_timestamp")
        .writeStream.format("memory")
        .queryName("sampled")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = all_alerts(sample.transactions(spark, small), cfg).drop("alert_timestamp")
    stream = spark.table("sampled")
    assert stream.exceptAll(batch).isEmpty()
    assert batch.exceptAll(stream).where(F.col("processing_date") < "2024-01-28").isEmpty()
    assert stream.where("transaction_id IS NOT NULL").count() == 102
    assert notifications(spark.table("sampled").withColumn("alert_timestamp", F.lit(None))).count()


def _drained(spark, database, tmp_path):
    detect.drain(spark, database, str(tmp_path / "checkpoint"))
    found = warehouse.alerts(spark, database).where("alert_type = 'RAPID_TRANSACTIONS'").collect()
    return sorted((r.user_id, r.transaction_count, r.last_transaction_id) for r in found)


def test_open_windows_come_out_when_the_stream_stops(spark, topic, database, tmp_path):
    """Drained, continued and drained again: each burst once, at last with its final count."""
    burst = [samples.wire_row(f"a{i}", "busy", at=samples.clock(i)) for i in range(4)]
    topic.send(*burst, *[samples.wire_row(f"c{i}", "calm", at=samples.clock(i)) for i in range(3)])
    _run(topic, database, tmp_path, lateness="1 minute")
    assert _bursts(spark, database) == []
    for _ in range(2):
        assert _drained(spark, database, tmp_path) == [("busy", 4, "a3")]
    topic.send(samples.wire_row("a9", "busy", at=samples.clock(9)), samples.wire_row("c9", "calm", at=samples.clock(9)))
    _run(topic, database, tmp_path, lateness="1 minute")
    assert _drained(spark, database, tmp_path) == [("busy", 5, "a9"), ("calm", 4, "c9")]
    topic.send(_later())
    _run(topic, database, tmp_path, lateness="1 minute")
    # Before the next drain the table's own alerts take the place of the open ones.
    found = warehouse.alerts(spark, database).where("alert_type = 'RAPID_TRANSACTIONS'")
    assert found.count() == 2 == found.select("alert_id").distinct().count()
    assert _drained(spark, database, tmp_path) == [("busy", 5, "a9"), ("calm", 4, "c9")]
    assert warehouse.open_alerts(spark, database).read(schemas.ALERT_TABLE).count() == 0


def test_a_drained_stream_equals_the_batch(spark, small, database, tmp_path):
    cfg, checkpoint = RuleConfig(rapid_window="1 day"), str(tmp_path / "c")
    found = detect.detect(sample.transaction_stream(spark, small), cfg, lateness="1 day")
    warehouse.append_stream(found, database, warehouse.ALERTS, checkpoint, once=True).awaitTermination()
    before = _stored(spark, database).count()
    detect.drain(spark, database, checkpoint, cfg)
    batch = all_alerts(sample.transactions(spark, small), cfg).drop("alert_timestamp")
    stream = warehouse.alerts(spark, database).drop("alert_timestamp")
    assert stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()
    assert stream.count() > before


def _monitored(spark, alerts, tmp_path):
    out = str(tmp_path / "out")
    for query in monitor.start_monitor(alerts, out, str(tmp_path / "monitor"), once=True).values():
        query.awaitTermination()
    sent = sorted((r.user_id, r.channel) for r in spark.read.json(f"{out}/notifications").collect())
    return sent, spark.read.json(f"{out}/audit").count()


def test_a_burst_is_notified_once_open_or_closed(spark, topic, database, tmp_path):
    topic.send(*[samples.wire_row(f"a{i}", "busy", at=samples.clock(i)) for i in range(4)])
    _run(topic, database, tmp_path, lateness="1 minute")
    detect.drain(spark, database, str(tmp_path / "checkpoint"))
    want = [("busy", "email"), ("busy", "slack")]
    assert _monitored(spark, monitor.alert_stream(spark, database), tmp_path) == (want, 1)
    topic.send(_later())
    _run(topic, database, tmp_path, lateness="1 minute")
    detect.drain(spark, database, str(tmp_path / "checkpoint"))
    assert _monitored(spark, monitor.alert_stream(spark, database), tmp_path) == (want, 2)


def test_a_replayed_message_is_notified_once(spark, tmp_path):
    """The same file twice, an alert without an id, one without a time, and an old one."""
    folder = tmp_path / "alerts"
    folder.mkdir()
    alerts = [
        {"alert_id": "x", "severity": "MEDIUM", "user_id": "a", "alert_timestamp": "2024-03-01T10:00:00"},
        {"alert_id": "y", "severity": "CRITICAL", "user_id": "b"},
        {"severity": "MEDIUM", "user_id": "c", "alert_timestamp": "2024-03-01T10:00:01"},
        {"severity": "MEDIUM", "user_id": "d", "alert_timestamp": "2024-03-01T10:00:02"},
    ]
    lines = "\n".join(map(json.dumps, alerts)) + "\n"
    want = [("a", "email"), *[("b", c) for c in ("email", "slack", "sms")], ("c", "email"), ("d", "email")]
    for number in range(3):
        (folder / f"{number}.txt").write_text(lines)
        stream = messages.decode_alerts(spark.readStream.text(str(folder)))
        assert _monitored(spark, stream, tmp_path) == (want, 4 * (number + 1))
    batch = monitor.first_of_each(messages.decode_alerts(spark.read.text(str(folder))))
    assert batch.count() == 4


def test_the_detection_rate_shows_a_rule_that_the_stream_lacks(spark, topic, database, tmp_path):
    from tillwarden.operators import enrich
    from tillwarden.plans import metrics

    rows = [samples.wire_row(f"n{i}", "u", 2000.0, hour=3) for i in range(3)] + [samples.wire_row("h", "u", 9000.0)]
    topic.send(*rows)
    warehouse.create_tables(spark, "t_blind", str(tmp_path / "blind"))
    labelled = enrich.with_label(samples.transactions(spark, rows))
    for name, cfg, rate in (("t_blind", RuleConfig(odd_hour_amount=1e12), 25.0), (database, RuleConfig(), 100.0)):
        detect.start_to_table(topic.stream(), name, str(tmp_path / f"c-{name}"), cfg, once=True).awaitTermination()
        found = metrics.detection_rate(labelled, warehouse.alerts(spark, name)).first()
        assert (found.fraud_transactions, found.detection_rate_percent) == (4, rate)


def test_response_times_of_new_alerts_are_merged_into_kept_sketches(spark, tmp_path):
    from tillwarden.plans import metrics
    from tillwarden.sources.snapshots import Snapshots

    kept = Snapshots(spark, str(tmp_path / "kept"))
    made = lambda n, kind: spark.range(n).selectExpr(
        f"'{kind}' AS alert_type", "'2024-03-01T10:00:00' AS timestamp",
        "timestamp_seconds(unix_timestamp(timestamp'2024-03-01 10:00:00') + id / 10D) AS alert_timestamp",
    )
    for n in (5000, 5000):
        metrics.add_response_times(kept, made(n, "A").unionByName(made(3, "B")))
    found = {r.alert_type: r for r in metrics.response_quantiles(kept.read(metrics.SKETCHES)).collect()}
    assert (found["A"].alerts, found["B"].alerts) == (10000, 6)
    assert abs(found["A"].p50_seconds - 250) < 500 * metrics.RANK_ERROR
    assert abs(found["A"].p95_seconds - 475) < 500 * metrics.RANK_ERROR
    assert found["B"].p50_seconds == pytest.approx(0.1)
