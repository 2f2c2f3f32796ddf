from __future__ import annotations

import datetime as dt
import json

import pytest
import samples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.functions.calendar import with_event_time
from tillwarden.operators.alerts import all_alerts
from tillwarden.sources import kafka, messages


def _messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lenient_decode_keeps_what_fits(spark):
    rows = messages.decode_transactions(
        _messages(
            spark,
            "not json",
            '{"transaction_id":"b","amount":"abc","hour_of_day":4}',
            '{"transaction_id":"c","amount":"12.5"}',
            '{"transaction_id":"d","amount":7,"hour_of_day":"4","is_weekend":"true","fraud_type":"x"}',
            '{"transaction_id":5,"amount":null}',
            '{"transaction_id":"a","amount":1.5,"hour_of_day":3,"is_weekend":true}',
            None,
        )
    ).collect()
    found = [
        (r.transaction_id, r.amount, r.hour_of_day, r.is_weekend, r[messages.CORRUPT] is not None)
        for r in rows
    ]
    assert found == [
        (None, None, None, None, True),
        ("b", None, 4, None, True),
        ("c", None, None, None, True),
        ("d", 7.0, None, None, True),
        ("5", None, None, None, False),
        ("a", 1.5, 3, True, False),
        (None, None, None, None, False),
    ]


def test_decode_can_fail_instead(spark):
    fits = _messages(spark, '{"transaction_id":"a","amount":1.5}')
    assert messages.decode_transactions(fits, fail=True).first().amount == 1.5
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        messages.decode_transactions(_messages(spark, "not json"), fail=True).collect()


def _rule_message(**changed):
    fields = {
        "transaction_id": "a",
        "user_id": "u",
        "amount": 12.5,
        "merchant_id": "m",
        "location": "X",
        "timestamp": samples.NOON,
        "hour_of_day": 12,
    }
    fields.update(changed)
    return json.dumps({k: v for k, v in fields.items() if v != "drop"})


def test_strict_decode_sets_bad_messages_aside(spark):
    decoded = messages.decode_rule_fields(
        _messages(
            spark,
            _rule_message(),
            _rule_message(transaction_id="text", amount="12.5", hour_of_day="4"),
            _rule_message(transaction_id="word", amount="abc"),
            _rule_message(transaction_id="short", location="drop", user_id="drop"),
            _rule_message(transaction_id=7, fraud_type="x"),
            "not json",
            None,
        )
    )
    good, bad = messages.split_valid(decoded)
    assert {(r.transaction_id, r.amount, r.hour_of_day) for r in good.collect()} == {
        ("a", 12.5, 12),
        ("text", 12.5, 4),
        ("7", 12.5, 12),
    }
    everything = ",".join(messages.schemas.RULE_FIELDS)
    assert sorted(r.reject_reason for r in bad.collect()) == sorted(
        ["malformed", "missing: amount", "missing: user_id,location", f"missing: {everything}"]
    )
    assert "event_time" in good.columns


def test_text_that_is_no_time_is_null(spark):
    rows = spark.createDataFrame([("garbage",), (samples.NOON,), (None,)], "timestamp string")
    found = [r.event_time for r in with_event_time(rows).collect()]
    assert found == [None, dt.datetime(2024, 3, 1, 12), None]


def test_messages_carry_key_and_no_nulls(spark):
    rows = samples.transactions(spark, [samples.wire_row("1", "u9", None)])
    record = messages.to_messages(rows, key="user_id").first()
    assert record.key == "u9"
    assert "amount" not in json.loads(record.value)
    assert json.loads(record.value)["hour_of_day"] == 12


def test_both_alert_shapes_survive_the_wire(spark):
    rows = samples.transactions(spark, [*samples.burst_rows(), samples.wire_row("x", "z", 9000.0)])
    alerts = all_alerts(rows).drop("processing_date")
    sent = messages.to_messages(alerts)
    keys = {frozenset(json.loads(r.value)) for r in sent.collect()}
    common = {"alert_id", "alert_type", "user_id", "alert_timestamp", "severity"}
    point = {"transaction_id", "amount", "merchant_id", "location", "timestamp"}
    rapid = {"transaction_count", "time_window", "last_transaction_id"}
    assert keys == {frozenset(common | point), frozenset(common | rapid)}
    back = messages.decode_alerts(sent)
    assert back.where(F.col(messages.CORRUPT).isNotNull()).isEmpty()
    columns = [c for c in alerts.columns if c != "alert_timestamp"]
    assert back.select(*columns).exceptAll(alerts.select(*columns)).isEmpty()


@pytest.mark.parametrize("read", [kafka.stream_messages, kafka.stored_messages])
def test_kafka_needs_its_connector(spark, read):
    """Without the connector on the classpath Spark says what is missing."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read(spark, "nowhere:9092")


def test_a_time_that_is_no_time_is_listed_and_kept(spark):
    text = '{"transaction_id":"t","user_id":"u","amount":6000,"merchant_id":"m","location":"X","timestamp":"yesterday","hour_of_day":3}'
    topic = spark.createDataFrame([(text,)], "value string")
    good, rejects = messages.split_valid(messages.decode_rule_fields(topic))
    assert good.first().event_time is None and good.first().amount == 6000
    assert rejects.first().reject_reason == "unreadable: timestamp"


@pytest.mark.parametrize(
    ("text", "names"),
    [("no json", ""), ('{"transaction_id": "x"}', "without a usable"), ('{"amount": "much"}', "without a usable")],
)
def test_failing_on_a_message_that_cannot_be_judged(spark, text, names):
    whole = json.dumps(dict(zip(schemas.TRANSACTION.names, samples.wire_row("t"))))
    good = spark.createDataFrame([(whole,)], "value string")
    assert messages.decode_rule_fields(good, fail=True).first().amount == 10.0
    bad = spark.createDataFrame([(whole,), (text,)], "value string")
    with pytest.raises(Exception, match=names):
        messages.decode_rule_fields(bad, fail=True).collect()
    assert messages.decode_rule_fields(bad).count() == 2
