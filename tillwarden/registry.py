"""Every operator as a query over the test tables.

Clock columns (``alert_timestamp``) are left out, so that results can be
compared. Windows of bursts are a day here: the data has no busy minutes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwarden import config as fixed
from tillwarden import schemas
from tillwarden.config import RuleConfig
from tillwarden.functions.calendar import with_calendar_features
from tillwarden.operators import alerts, enrich, learning, ranking, routing
from tillwarden.operators.lookup import stage
from tillwarden.plans import batch, metrics, reports, training
from tillwarden.session import apply_settings, shared_folder
from tillwarden.sources import messages, sample, warehouse
from tillwarden.sources.snapshots import Snapshots
from tillwarden.streaming import detect, monitor

AS_OF = dt.date(2024, 1, 30)
DAILY = RuleConfig(rapid_window="1 day")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a function under its own name."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(apply_settings(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return run


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_label(sample.transactions(spark, sf_dir))


def _categorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_label(sample.full_transactions(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.landed_transactions(spark, sf_dir)
    return enrich.enrich(raw, folder=shared_folder(spark, "enrich"))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.all_alerts(sample.transactions(spark, sf_dir), DAILY)


# Enrichment


@query
def label_fraud(spark, sf_dir):
    return _labelled(spark, sf_dir).select("transaction_id", "is_fraud")


@query
def user_stats(spark, sf_dir):
    stats = enrich.user_stats(sample.placeless_transactions(spark, sf_dir))
    return stats.withColumn("user_amount_stddev", F.round("user_amount_stddev", 4))


@query
def amount_percentile(spark, sf_dir):
    rows = sample.placeless_transactions(spark, sf_dir)
    ranks = ranking.distinct_value_ranks(rows, "amount", "amount_percentile")
    ranked = ranking.with_percentile(rows, ranks=stage(ranks, shared_folder(spark, "ranks")))
    return ranked.select("transaction_id", "amount", "amount_percentile")


@query
def enrich_transactions(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query
def merchant_category(spark, sf_dir):
    rows = enrich.with_merchant_category(sample.placeless_transactions(spark, sf_dir))
    return rows.select("transaction_id", "merchant_id", "merchant_category")


@query
def calendar_features(spark, sf_dir):
    rows = sample.placeless_transactions(spark, sf_dir).drop("hour_of_day", "is_weekend")
    return with_calendar_features(rows).select("transaction_id", "hour_of_day", "is_weekend")


# Reports


@query
def daily_fraud_stats(spark, sf_dir):
    return reports.daily_fraud_stats(_labelled(spark, sf_dir))


@query
def daily_fraud_rate(spark, sf_dir):
    return reports.daily_fraud_rate(_labelled(spark, sf_dir))


@query
def top_fraud_users(spark, sf_dir):
    return reports.top_fraud_users(_labelled(spark, sf_dir))


@query
def merchant_analysis(spark, sf_dir):
    return reports.merchant_analysis(_categorized(spark, sf_dir))


@query
def location_analysis(spark, sf_dir):
    return reports.location_analysis(_labelled(spark, sf_dir))


@query
def time_patterns(spark, sf_dir):
    return reports.time_patterns(_labelled(spark, sf_dir))


@query
def channel_card_analysis(spark, sf_dir):
    return reports.channel_card_analysis(_labelled(spark, sf_dir))


@query
def amount_bands(spark, sf_dir):
    return reports.amount_bands(_labelled(spark, sf_dir))


@query
def user_behavior(spark, sf_dir):
    return reports.user_behavior(_labelled(spark, sf_dir), AS_OF)


@query
def user_activity(spark, sf_dir):
    return reports.user_activity(_labelled(spark, sf_dir), AS_OF)


@query
def fraud_trend(spark, sf_dir):
    return reports.fraud_trend(_labelled(spark, sf_dir), AS_OF)


@query
def merchant_fraud_today(spark, sf_dir):
    return reports.merchant_fraud_on(_labelled(spark, sf_dir), AS_OF)


@query
def hourly_pattern_today(spark, sf_dir):
    return reports.hourly_pattern_on(_labelled(spark, sf_dir), AS_OF)


# Alerts


def _point(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows = sample.transactions(spark, sf_dir)
    return alerts.point_alerts(rows, only=[kind]).drop("alert_timestamp")


@query
def alert_high_amount(spark, sf_dir):
    return _point(spark, sf_dir, fixed.HIGH_AMOUNT)


@query
def alert_unusual_location(spark, sf_dir):
    return _point(spark, sf_dir, fixed.UNUSUAL_LOCATION)


@query
def alert_unusual_hour(spark, sf_dir):
    return _point(spark, sf_dir, fixed.UNUSUAL_HOUR)


@query
def alert_severity(spark, sf_dir):
    rows = alerts.point_alerts(sample.transactions(spark, sf_dir))
    return rows.select("transaction_id", "alert_type", "amount", "severity")


@query
def alert_rapid(spark, sf_dir):
    rows = alerts.rapid_alerts(sample.placeless_transactions(spark, sf_dir), DAILY)
    return rows.drop("alert_timestamp")


@query
def all_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).drop("alert_timestamp")


@query
def alerts_summary(spark, sf_dir):
    return reports.alerts_summary(_alerts(spark, sf_dir), AS_OF)


@query
def alert_routing(spark, sf_dir):
    return routing.notifications(_alerts(spark, sf_dir))


@query
def critical_alerts(spark, sf_dir):
    return routing.immediate_responses(_alerts(spark, sf_dir))


@query
def alert_audit_log(spark, sf_dir):
    """Written as JSON lines and read back."""
    folder = shared_folder(spark, "audit")
    log = routing.audit_log(_alerts(spark, sf_dir))
    log.write.mode("append").json(folder)
    return spark.read.schema(log.schema).json(folder).drop("timestamp")


# Messages and tables


@query
def decode_transactions(spark, sf_dir):
    decoded = messages.decode_transactions(sample.wire_messages(spark, sf_dir))
    corrupt = F.col(messages.CORRUPT).isNotNull().alias("is_corrupt")
    return decoded.select(*schemas.TRANSACTION.names, corrupt)


@query
def decode_strict(spark, sf_dir):
    decoded = messages.decode_rule_fields(sample.wire_messages(spark, sf_dir))
    return messages.with_reject_reason(decoded).drop(messages.CORRUPT)


def _warehouse(spark: SparkSession) -> tuple[str, str]:
    """A database of its own in the shared folder, and a checkpoint folder."""
    folder = shared_folder(spark, "warehouse")
    database = f"tillwarden_{uuid.uuid4().hex[:12]}"
    warehouse.create_tables(spark, database, folder)
    return database, f"{folder}/_checkpoints"


@query
def table_roundtrip(spark, sf_dir):
    """Processed rows written to the partitioned table and read back."""
    database, _ = _warehouse(spark)
    rows = _enriched(spark, sf_dir)
    warehouse.replace_partitions(rows, database, warehouse.PROCESSED)
    return warehouse.table(spark, database, warehouse.PROCESSED)


@query
def batch_run(spark, sf_dir):
    """Land a topic of messages, some damaged; enrich; write; the daily report of it all.

    Damaged messages are landed as far as they can be read, under no date if
    that is what they have lost.
    """
    folder = shared_folder(spark, "run")
    database = f"tillwarden_{uuid.uuid4().hex[:12]}"
    topic = sample.message_stream(spark, sf_dir)
    made = batch.run_batch(topic, database, f"{folder}/_checkpoint", AS_OF, f"{folder}/tables")
    return made["daily_summary"]


@query
def batch_rerun(spark, sf_dir):
    """Two runs under two dates, the second with the other half of the messages: as if all had come at once."""
    folder, topic = shared_folder(spark, "rerun"), shared_folder(spark, "topic")
    database = f"tillwarden_{uuid.uuid4().hex[:12]}"
    rows = sample.full_transactions(spark, sf_dir).select(*schemas.TRANSACTION.names)
    half = F.col("transaction_id").cast("bigint") % 2 == 0
    for part, day in ((half, AS_OF - dt.timedelta(days=1)), (~half, AS_OF)):
        messages.to_messages(rows.where(part)).write.mode("append").text(topic)
        stream = spark.readStream.text(topic)
        batch.run_batch(stream, database, f"{folder}/_checkpoint", AS_OF, f"{folder}/tables", processing_date=day)
    return warehouse.table(spark, database, warehouse.PROCESSED)


@query
def row_counts(spark, sf_dir):
    rows = sample.placeless_transactions(spark, sf_dir)
    return metrics.row_counts(rows, learning.is_test_row())


# Streams


def _stream_alerts(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The alert table filled by the detection stream over all events, and what it left open."""
    database, checkpoints = _warehouse(spark)
    found = detect.detect(sample.transaction_stream(spark, sf_dir), DAILY, lateness="1 day")
    warehouse.append_stream(
        found, database, warehouse.ALERTS, f"{checkpoints}/detect", once=True
    ).awaitTermination()
    detect.drain(spark, database, f"{checkpoints}/detect", DAILY)
    return database, checkpoints


@query
def stream_alerts(spark, sf_dir):
    """All alerts: those of closed windows, and of windows open at the end of the data."""
    database, _ = _stream_alerts(spark, sf_dir)
    return warehouse.alerts(spark, database).drop("alert_timestamp")


@query
def stream_notifications(spark, sf_dir):
    """Detection stream, then the monitor stream over its alerts."""
    database, checkpoints = _stream_alerts(spark, sf_dir)
    found = monitor.alert_stream(spark, database)
    folder = shared_folder(spark, "monitor")
    for running in monitor.start_monitor(found, folder, checkpoints, once=True).values():
        running.awaitTermination()
    layout = routing.notifications(spark.createDataFrame([], schemas.ALERT)).schema
    return spark.read.schema(layout).json(f"{folder}/notifications")


@query
def detection_job(spark, sf_dir):
    """The whole job on a topic with damaged messages: decode, detect, write, drain."""
    database, checkpoints = _warehouse(spark)
    topic, checkpoint = sample.message_stream(spark, sf_dir), f"{checkpoints}/job"
    running = detect.start_to_table(topic, database, checkpoint, DAILY, lateness="1 day", once=True)
    running.awaitTermination()
    detect.drain(spark, database, checkpoint, DAILY)
    return warehouse.alerts(spark, database).drop("alert_timestamp")


@query
def alert_messages(spark, sf_dir):
    """Alerts sent as keyed JSON messages, written, read back and decoded."""
    folder = shared_folder(spark, "messages")
    messages.to_messages(_alerts(spark, sf_dir), key="user_id").write.parquet(folder)
    sent = spark.read.schema("key string, value string").parquet(folder)
    keyed = sent.select("key", messages.decoded_alert("value").alias("alert"))
    same_key = F.col("key").eqNullSafe(F.col("alert.user_id")).alias("key_is_user")
    return keyed.select("alert.*", same_key).drop("alert_timestamp")


@query
def stream_rejects(spark, sf_dir):
    """Messages the detection stream cannot use, with the reason."""
    folder = shared_folder(spark, "rejects")
    detect.start_rejects(
        sample.message_stream(spark, sf_dir), f"{folder}/rows", f"{folder}/_checkpoint", once=True
    ).awaitTermination()
    layout = "transaction_id STRING, user_id STRING, reject_reason STRING"
    return spark.read.schema(layout).json(f"{folder}/rows")


# Learning


@query
def training_extract(spark, sf_dir):
    return learning.training_extract(_categorized(spark, sf_dir))


@query
def ml_features(spark, sf_dir):
    """The assembled vector, one column per feature."""
    rows = learning.training_extract(_categorized(spark, sf_dir))
    stages = learning.feature_stages().getStages()[:3]
    vector = vector_to_array("features_raw")
    assembled = Pipeline(stages=stages).fit(rows).transform(rows)
    values = [vector[i].alias(name) for i, name in enumerate(learning.FEATURES)]
    return assembled.select("transaction_id", *values).withColumn(
        "amount_log", F.round("amount_log", 6)
    )


@query
def ml_split(spark, sf_dir):
    rows = sample.placeless_transactions(spark, sf_dir)
    return rows.select("transaction_id", learning.is_test_row().alias("is_test"))


@query
def ml_string_index(spark, sf_dir):
    rows = learning.training_extract(_categorized(spark, sf_dir))
    indexed = learning.string_indexer().fit(rows).transform(rows)
    return indexed.select("transaction_id", *learning.INDEXES)


@query
def ml_scaled_amount(spark, sf_dir):
    rows = sample.placeless_transactions(spark, sf_dir).select("transaction_id", "amount")
    scaling = Pipeline(
        stages=[
            VectorAssembler(inputCols=["amount"], outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol="features"),
        ]
    )
    scaled = vector_to_array("features")[0]
    return scaling.fit(rows).transform(rows).select(
        "transaction_id", F.round(scaled, 6).alias("scaled_amount")
    )


@query
def ml_auc(spark, sf_dir):
    """How well the amount alone ranks fraud."""
    rows = _labelled(spark, sf_dir).select("amount", "is_fraud")
    auc = learning.area_under_roc(rows, score="amount")
    return rows.agg(F.count("*").alias("rows")).withColumn("auc", F.round(F.lit(auc), 6))


def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits and scoring go over these rows many times: from a table, as in a real run."""
    extract = learning.training_extract(_categorized(spark, sf_dir))
    return stage(extract, shared_folder(spark, "training"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extract(spark, sf_dir)
    _, test_rows = learning.split(rows)
    return training.train(rows).model.transform(test_rows)


@query
def ml_model_selection(spark, sf_dir):
    """What SQL can follow of the choice: the names, useful scores, the strict rule."""
    trained = training.train(_extract(spark, sf_dir))
    forest, regression = (trained.aucs[n] for n in ("RandomForest", "LogisticRegression"))
    layout = T.StructType(
        [
            T.StructField("model_name", T.StringType()),
            T.StructField("better_than_chance", T.BooleanType()),
            T.StructField("chosen_by_rule", T.BooleanType()),
        ]
    )
    wins = {"RandomForest": forest > regression, "LogisticRegression": forest <= regression}
    results = [
        (name, 0.5 < auc <= 1, wins[name] == (name == trained.name))
        for name, auc in trained.aucs.items()
    ]
    return spark.createDataFrame(results, layout)


@query
def ml_score(spark, sf_dir):
    """Every test row scored; whether its prediction and probability are sound."""
    likely = vector_to_array("probability")[1]
    return _scored(spark, sf_dir).select(
        "transaction_id",
        "is_fraud",
        F.col("prediction").isin(0.0, 1.0).alias("prediction_valid"),
        likely.between(0.0, 1.0).alias("probability_valid"),
        ((likely > 0.5) == (F.col("prediction") == 1.0)).alias("agrees"),
    )


@query
def ml_confusion(spark, sf_dir):
    """The confusion matrix summed by label: no scored row is left out."""
    matrix = learning.confusion(_scored(spark, sf_dir))
    return matrix.groupBy("label").agg(F.sum("rows").alias("rows"))


# Metrics


@query
def throughput_hourly(spark, sf_dir):
    slices = metrics.throughput(sample.placeless_transactions(spark, sf_dir))
    return slices.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query
def detection_rate(spark, sf_dir):
    """The labels of the batch against the alerts that the stream wrote."""
    database, _ = _stream_alerts(spark, sf_dir)
    return metrics.detection_rate(_labelled(spark, sf_dir), warehouse.alerts(spark, database))


@query
def response_times(spark, sf_dir):
    """Seconds to each alert on a clock that follows from its id, from sketches kept per type and hour."""
    found = _alerts(spark, sf_dir).where("transaction_id IS NOT NULL")
    waited = (F.conv(F.substring("alert_id", 1, 8), 16, 10).cast("long") % 100_000).cast("double") / 1000
    late = F.timestamp_seconds(F.try_to_timestamp("timestamp").cast("double") + waited)
    kept = Snapshots(spark, shared_folder(spark, "response"))
    rows = found.withColumn("alert_timestamp", late)
    for part in (rows.where("amount < 2000"), rows.where("amount >= 2000 OR amount IS NULL")):
        metrics.add_response_times(kept, part)
    estimated = metrics.response_quantiles(kept.read(metrics.SKETCHES))
    # The share of alerts up to each estimate is its rank; there is one estimate per rule.
    waited = rows.select("alert_type", metrics.seconds_waited().alias("seconds"))
    ranks = waited.join(F.broadcast(estimated), "alert_type").groupBy("alert_type", "alerts").agg(
        *[F.avg((F.col("seconds") <= F.col(c)).cast("int")).alias(c) for c in metrics.QUANTILES]
    )
    near = [
        (F.abs(F.col(c) - q) <= metrics.RANK_ERROR + 1 / F.col("alerts")).alias(f"{c}_in_bound")
        for c, q in metrics.QUANTILES.items()
    ]
    return ranks.select("alert_type", "alerts", *near)
