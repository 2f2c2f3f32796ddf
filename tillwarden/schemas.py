"""Row layouts, each declared once."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_BOOL, _DATE, _TIME = T.BooleanType(), T.DateType(), T.TimestampType()


def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TRANSACTION = _layout(
    transaction_id=_STRING,
    user_id=_STRING,
    amount=_DOUBLE,
    merchant_id=_STRING,
    merchant_category=_STRING,
    location=_STRING,
    timestamp=_STRING,
    card_type=_STRING,
    channel=_STRING,
    is_weekend=_BOOL,
    hour_of_day=_INT,
)

PROCESSED = T.StructType(
    TRANSACTION.fields
    + _layout(
        amount_percentile=_DOUBLE,
        user_avg_amount=_DOUBLE,
        user_transaction_count=_LONG,
        is_unusual_amount=_BOOL,
        is_unusual_location=_BOOL,
        is_fraud=_INT,
        processing_date=_DATE,
    ).fields
)

# Point alerts leave the three rapid-only columns null, rapid alerts the five
# transaction columns; ``to_json`` drops nulls, so each goes out in its own shape.
ALERT = _layout(
    alert_id=_STRING,
    alert_type=_STRING,
    transaction_id=_STRING,
    user_id=_STRING,
    amount=_DOUBLE,
    merchant_id=_STRING,
    location=_STRING,
    timestamp=_STRING,
    alert_timestamp=_TIME,
    severity=_STRING,
    transaction_count=_LONG,
    time_window=_STRING,
    last_transaction_id=_STRING,
)

ALERT_TABLE = T.StructType(ALERT.fields + _layout(processing_date=_DATE).fields)

# What the alert rules read; a message without one of these cannot be judged.
RULE_FIELDS = (
    "transaction_id",
    "user_id",
    "amount",
    "merchant_id",
    "location",
    "timestamp",
    "hour_of_day",
)
