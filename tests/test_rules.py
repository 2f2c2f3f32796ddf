from __future__ import annotations

import datetime as dt

import samples
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.config import RuleConfig
from tillwarden.functions.buckets import activity_level, amount_band
from tillwarden.operators import alerts, enrich, routing


def test_labels_at_the_boundaries(spark):
    rows = enrich.with_label(samples.boundary(spark)).collect()
    assert {r.transaction_id: r.is_fraud for r in rows} == {b[0]: b[4] for b in samples.BOUNDARY}


def test_alerts_at_the_boundaries(spark):
    rows = alerts.point_alerts(samples.boundary(spark)).collect()
    found = sorted((r.transaction_id, r.alert_type, r.severity) for r in rows)
    expected = sorted((b[0], kind, level) for b in samples.BOUNDARY for kind, level in b[5])
    assert found == expected
    assert len(found) == 12


def test_one_rule_alone_finds_the_same(spark):
    rows = samples.boundary(spark)
    together = alerts.point_alerts(rows).drop("alert_timestamp")
    for kind in ("HIGH_AMOUNT", "UNUSUAL_LOCATION", "UNUSUAL_HOUR"):
        alone = alerts.point_alerts(rows, only=[kind]).drop("alert_timestamp")
        assert alone.exceptAll(together.where(F.col("alert_type") == kind)).isEmpty()
        assert alone.count() == together.where(F.col("alert_type") == kind).count()


def test_thresholds_are_parameters(spark):
    cfg = RuleConfig(high_amount=15000.0, critical_amount=15000.0)
    rows = alerts.point_alerts(samples.boundary(spark), cfg, only=["HIGH_AMOUNT"]).collect()
    assert [(r.transaction_id, r.severity) for r in rows] == [("b12", "CRITICAL")]


def test_alert_ids_repeat_on_a_rerun(spark):
    rows = samples.boundary(spark)
    first = {r.alert_id for r in alerts.point_alerts(rows).collect()}
    again = {r.alert_id for r in alerts.point_alerts(rows.repartition(3)).collect()}
    assert first == again
    assert len(first) == 12


def test_bursts(spark):
    rows = samples.transactions(spark, samples.burst_rows())
    found = alerts.all_alerts(rows).where("alert_type = 'RAPID_TRANSACTIONS'").collect()
    assert {
        (r.user_id, r.transaction_count, r.last_transaction_id) for r in found
    } == samples.EXPECTED_BURSTS
    assert {(r.severity, r.time_window) for r in found} == {("HIGH", "1_minute")}
    assert {r.transaction_id for r in found} == {None}


def test_arrival_time_windows(spark):
    """Four rows far apart in event time but together at the broker."""
    rows = samples.transactions(
        spark, [samples.wire_row(f"a{i}", "u", at=samples.clock(i * 100)) for i in range(4)]
    ).withColumn("arrived", F.lit(dt.datetime(2024, 3, 1, 9)))
    assert alerts.rapid_alerts(enrich.with_processing_date(rows)).isEmpty()
    assert alerts.rapid_alerts(rows, time_column="arrived").count() == 1


def test_alert_table_layout(spark):
    rows = alerts.all_alerts(samples.transactions(spark, samples.burst_rows()))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in schemas.ALERT_TABLE
    ]


def test_bands_and_levels(spark):
    amounts = [99.99, 100.0, 499.99, 500.0, 999.99, 1000.0, 4999.99, 5000.0, None]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "i int, amount double")
    bands = [r.b for r in rows.orderBy("i").select(amount_band(F.col("amount")).alias("b")).collect()]
    assert bands == ["< $100"] + ["$100 - $500"] * 2 + ["$500 - $1000"] * 2 + [
        "$1000 - $5000"
    ] * 2 + ["> $5000"] * 2
    counts = spark.createDataFrame([(9,), (10,), (49,), (50,)], "n long").orderBy("n")
    levels = [r.l for r in counts.select(activity_level(F.col("n")).alias("l")).collect()]
    assert levels == ["Low Activity", "Medium Activity", "Medium Activity", "High Activity"]


def _alert(spark, **values):
    row = tuple(values.get(f.name) for f in schemas.ALERT)
    return spark.createDataFrame([row], schemas.ALERT)


def test_channels_by_severity(spark):
    expected = {
        "CRITICAL": {"email", "sms", "slack"},
        "HIGH": {"email", "slack"},
        "MEDIUM": {"email"},
        "LOW": set(),
        "NO SUCH SEVERITY": set(),
        None: set(),
    }
    for severity, channels in expected.items():
        sent = routing.notifications(_alert(spark, alert_id="a", severity=severity)).collect()
        assert {r.channel for r in sent} == channels
        assert len(sent) == len(channels)


def test_defaults_of_missing_alert_fields(spark):
    row = routing.with_defaults(_alert(spark, alert_id="a")).first()
    assert (row.alert_type, row.severity, row.user_id, row.amount) == (
        "UNKNOWN",
        "LOW",
        "UNKNOWN",
        0.0,
    )


def test_own_channel_matrix(spark):
    matrix = spark.createDataFrame([("LOW", "pager")], "severity string, channel string")
    sent = routing.notifications(_alert(spark, alert_id="a"), matrix).collect()
    assert [r.channel for r in sent] == ["pager"]


def test_only_critical_alerts_call_for_a_response(spark):
    both = _alert(spark, alert_id="a", severity="CRITICAL").union(
        _alert(spark, alert_id="b", severity="HIGH")
    )
    rows = routing.immediate_responses(both).collect()
    assert [(r.alert_id, r.action) for r in rows] == [("a", "IMMEDIATE_RESPONSE")]


def test_alerts_without_transaction_id_have_ids_of_their_own(spark):
    rows = [samples.wire_row(None, u, a) for u, a in (("u", 6000.0), ("v", 6000.0), ("u", 7000.0), (None, 7000.0))]
    frame = samples.transactions(spark, [*rows, samples.wire_row("t", "u", 6000.0)])
    first, again = ({r.alert_id for r in alerts.point_alerts(frame).collect()} for _ in range(2))
    assert len(first) == 5 and first == again
