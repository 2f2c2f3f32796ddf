"""JSON messages: encoding, decoding, and setting aside what cannot be used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwarden import schemas
from tillwarden.functions.calendar import with_event_time

CORRUPT = "_corrupt_record"


def to_messages(rows: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON ``value`` per row, without null fields, and a ``key`` if one is named.

    The key keeps a user's messages in one topic partition, in order.
    """
    value = F.to_json(F.struct(*rows.columns)).alias("value")
    if key is None:
        return rows.select(value)
    return rows.select(F.col(key).cast("string").alias("key"), value)


def _decode(
    messages: DataFrame, layout: T.StructType, keep: Sequence[str], fail: bool = False
) -> DataFrame:
    options = {"mode": "FAILFAST"}
    if not fail:
        layout = T.StructType([*layout.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_json(F.col("value").cast("string"), layout, options)
    return messages.select(*keep, data.alias("data")).select(*keep, "data.*")


def decode_transactions(
    messages: DataFrame, keep: Sequence[str] = (), fail: bool = False
) -> DataFrame:
    """The 11 fields, and the raw text of a message that did not fit them.

    A field of the wrong type is NULL and the others are kept. ``keep`` carries
    columns of the message itself along, for example its arrival time. With
    ``fail`` a message that does not fit stops the job instead.
    """
    return _decode(messages, schemas.TRANSACTION, keep, fail)


def decode_rule_fields(
    messages: DataFrame, keep: Sequence[str] = (), fail: bool = False
) -> DataFrame:
    """The seven fields the alert rules read, lenient about numbers sent as text.

    ``"12.5"`` and ``12.5`` are the same amount; text that is no number gives NULL,
    which :func:`split_valid` then sets aside. With ``fail`` a message that is no JSON,
    or lacks one of the fields, stops the job instead, and names the field.
    """
    as_text = T.StructType([T.StructField(f, T.StringType()) for f in schemas.RULE_FIELDS])
    decoded = _decode(messages, as_text, keep, fail)
    decoded = decoded.withColumns(
        {
            "amount": F.col("amount").try_cast("double"),
            "hour_of_day": F.col("hour_of_day").try_cast("double").try_cast("int"),
        }
    )
    if not fail:
        return decoded
    lacking = lambda c: F.raise_error(F.lit(f"a message without a usable {c}"))
    needed = {c: F.when(F.col(c).isNull(), lacking(c)).otherwise(F.col(c)) for c in schemas.RULE_FIELDS}
    return decoded.withColumns(needed)


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Alerts of either shape in the columns both share."""
    return _decode(messages, schemas.ALERT, ())


def decoded_alert(value: str) -> Column:
    """An alert's text as a struct of the columns of the alert table's messages, date included."""
    return F.from_json(value, schemas.ALERT_TABLE)


def with_reject_reason(
    decoded: DataFrame, required: Sequence[str] = schemas.RULE_FIELDS
) -> DataFrame:
    """Why a message cannot be used; NULL if it can."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in required])
    malformed = F.col(CORRUPT).isNotNull()
    return decoded.withColumn(
        "reject_reason",
        F.when(malformed, "malformed").when(
            missing != "", F.concat(F.lit("missing: "), missing)
        ),
    )


def split_valid(
    decoded: DataFrame, required: Sequence[str] = schemas.RULE_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and what cannot be used with the reason: a bad message never stops the job.

    A row whose time is no time is in both: its own alerts can be raised, but no
    event-time window counts it, and the rejects say so.
    """
    judged = with_reject_reason(decoded, required)
    good = with_event_time(judged.where("reject_reason IS NULL").drop("reject_reason", CORRUPT))
    unreadable = F.col("event_time").isNull() & F.col("timestamp").isNotNull()
    reason = F.coalesce("reject_reason", F.when(unreadable, "unreadable: timestamp"))
    rejects = with_event_time(judged).withColumn("reject_reason", reason)
    return good, rejects.where(F.col("reject_reason").isNotNull()).drop("event_time")
