"""Transactions derived from the ``events``, ``customer`` and ``nation`` test tables.

One transaction per event: the event's value gives the amount, its key ``k`` the
merchant and card, its type the channel, and the customer's nation the place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import MERCHANT_CATEGORIES
from tillwarden.operators.enrich import with_merchant_category
from tillwarden.schemas import TRANSACTION
from tillwarden.session import shared_folder

# The channel each kind of event stands for.
CHANNELS = {
    "click": "online",
    "signup": "online",
    "view": "mobile",
    "purchase": "pos",
    "error": "atm",
}
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
CUSTOMER = "c_custkey BIGINT, c_nationkey INT"
NATION = "n_nationkey INT, n_name STRING"

MERCHANTS = [*MERCHANT_CATEGORIES, "UNKNOWN_MERCHANT"]


def _columns() -> list[str]:
    """Everything an event tells by itself."""
    merchants = ", ".join(f"'{m}'" for m in MERCHANTS)
    channels = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in CHANNELS.items())
    return [
        "cast(event_id AS string) AS transaction_id",
        # Numbers of more than four digits keep all of them.
        "concat('user_', lpad(user_id, greatest(length(user_id), 4), '0')) AS user_id",
        "round(value * 25, 2) AS amount",
        f"array({merchants})[k % {len(MERCHANTS)}] AS merchant_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS timestamp",
        "CASE WHEN k % 2 = 0 THEN 'credit' ELSE 'debit' END AS card_type",
        f"CASE event_type {channels} END AS channel",
        "weekday(ts) >= 5 AS is_weekend",
        "hour(ts) AS hour_of_day",
        "cast(ts AS timestamp) AS event_time",
        "cast(ts AS date) AS processing_date",
    ]


def _keyed(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", "try_cast(get_json_object(props, '$.k') AS int) AS k")


def _placed(events: DataFrame, sf_dir: str) -> DataFrame:
    """Events as transactions, with the customer's nation as the location.

    The joins carry no hint: Spark broadcasts a table while its files are small,
    and AQE splits the partitions of busy users once ``customer`` is not.
    """
    read = events.sparkSession.read
    customer = read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    nation = read.schema(NATION).parquet(f"{sf_dir}/nation.parquet")
    return (
        _keyed(events)
        .join(customer, F.expr("user_id = c_custkey"), "left")
        .join(nation, F.expr("c_nationkey = n_nationkey"), "left")
        .selectExpr(
            *_columns(),
            "CASE WHEN event_type = 'error' AND k < 10 THEN 'Unknown Location' ELSE n_name END"
            " AS location",
        )
    )


def placeless_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as transactions without a location, for what needs none: no join."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return _keyed(events).selectExpr(*_columns())


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as transactions, without the merchant category."""
    return _placed(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"), sf_dir)


def transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream."""
    only = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return _placed(only.parquet(sf_dir), sf_dir)


def full_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11 wire columns in order, then ``event_time`` and ``processing_date``."""
    rows = with_merchant_category(transactions(spark, sf_dir))
    return rows.select(*TRANSACTION.names, "event_time", "processing_date")


def landed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire columns written as a raw table first.

    Enrichment goes over its input several times for a column or two; from the
    written table each pass reads only those, and nothing is parsed again.
    """
    folder = shared_folder(spark, "raw")
    rows = full_transactions(spark, sf_dir).select(*TRANSACTION.names)
    rows.write.parquet(folder)
    return spark.read.schema(TRANSACTION).parquet(folder)


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions as JSON text, one message in five damaged or unusual.

    By the id modulo 20: 0 is no JSON, 1 sends the amount as text, 2 leaves it
    out, 3 adds a field nobody reads.
    """
    rows = full_transactions(spark, sf_dir)
    plain = [F.col(c) for c in TRANSACTION.names]

    def message(**changed: Column) -> Column:
        kept = [F.col(c) for c in TRANSACTION.names if c not in changed]
        return F.to_json(F.struct(*kept, *[v.alias(c) for c, v in changed.items()]))

    d = F.col("transaction_id").cast("bigint") % 20
    value = (
        F.when(d == 0, F.concat(F.lit("<"), F.to_json(F.struct(*plain))))
        .when(d == 1, message(amount=F.col("amount").cast("string")))
        .when(d == 2, message(amount=F.lit(None).cast("double")))
        .when(d == 3, message(fraud_type=F.lit("high_amount")))
        .otherwise(F.to_json(F.struct(*plain)))
    )
    return rows.select(F.col("user_id").alias("key"), value.alias("value"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream, from a folder that stands in for a topic."""
    folder = shared_folder(spark, "topic")
    wire_messages(spark, sf_dir).select("value").write.text(folder)
    return spark.readStream.text(folder)
