"""The expected result of each registered query, as SQL for another engine.

Money and rates are computed in whole cents and rounded by integer division, so
that no result depends on how an engine rounds a double.
"""

from __future__ import annotations

from tillwarden.config import MERCHANT_CATEGORIES
from tillwarden.sources.sample import CHANNELS, MERCHANTS

TODAY = "DATE '2024-01-30'"


def _case(column: str, mapping: dict[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


_names = ", ".join(f"'{m}'" for m in MERCHANTS)

TX = f"""
tx0 AS (
  SELECT event_id, ts, cast(event_id AS varchar) AS transaction_id,
    printf('user_%04d', user_id) AS user_id, round(value * 25, 2) AS amount,
    [{_names}][k % {len(MERCHANTS)} + 1] AS merchant_id,
    CASE WHEN event_type = 'error' AND k < 10 THEN 'Unknown Location' ELSE n_name END AS location,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    CASE WHEN k % 2 = 0 THEN 'credit' ELSE 'debit' END AS card_type,
    {_case("event_type", CHANNELS)} AS channel,
    isodow(ts) >= 6 AS is_weekend, cast(hour(ts) AS integer) AS hour_of_day,
    cast(ts AS date) AS processing_date
  FROM (SELECT *, cast(props::json->>'$.k' AS integer) AS k FROM events) e
  LEFT JOIN customer ON c_custkey = e.user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey),
tx AS (
  SELECT *, {_case("merchant_id", MERCHANT_CATEGORIES, "'other'")} AS merchant_category,
    cast(round(amount * 100) AS bigint) AS c,
    CASE WHEN amount > 5000 OR location = 'Unknown Location'
      OR (hour_of_day BETWEEN 2 AND 5 AND amount > 1000) THEN 1 ELSE 0 END AS is_fraud
  FROM tx0)"""

WIRE = (
    "transaction_id, user_id, amount, merchant_id, merchant_category, location, "
    '"timestamp", card_type, channel, is_weekend, hour_of_day'
)


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(p.strip() for p in parts)}\n{select.strip()}"


def _tx(select: str) -> str:
    return _with(TX, select=select)


def _cents(total: str) -> str:
    return f"cast({total} AS double) / 100"


def _mean(total: str = "sum(c)", rows: str = "count(c)") -> str:
    """Mean of non-negative cents, rounded half up."""
    return f"cast((2 * {total} + {rows}) // (2 * {rows}) AS double) / 100"


def _pct(part: str = "sum(is_fraud)", whole: str = "count(*)") -> str:
    return f"cast((20000 * {part} + {whole}) // (2 * {whole}) AS double) / 100"


COUNTS = (
    "count(*) AS total_transactions, cast(sum(is_fraud) AS bigint) AS fraud_transactions, "
    f"{_pct()} AS fraud_rate_percent"
)

STATS = """
stats AS (
  SELECT user_id, round(cast(sum(cast(amount AS decimal(18, 4))) AS double) * 10000)
      / (10000 * count(amount)) AS user_avg_amount,
    count(*) AS user_transaction_count, stddev_samp(amount) AS sd
  FROM tx GROUP BY user_id)"""

ENRICHED = f"""
ranked AS (
  SELECT *, percent_rank() OVER (ORDER BY amount NULLS FIRST) AS amount_percentile FROM tx),
enriched AS (
  SELECT {", ".join("r." + c.strip() for c in WIRE.split(","))}, r.amount_percentile,
    s.user_avg_amount, s.user_transaction_count,
    r.amount > s.user_avg_amount * 5 AS is_unusual_amount,
    r.location = 'Unknown Location' AS is_unusual_location, r.is_fraud, r.processing_date
  FROM ranked r LEFT JOIN stats s ON s.user_id = r.user_id)"""

POINT = """
hits AS (
  SELECT *, 'HIGH_AMOUNT' AS alert_type FROM tx WHERE amount > 5000
  UNION ALL
  SELECT *, 'UNUSUAL_LOCATION' FROM tx WHERE location = 'Unknown Location'
  UNION ALL
  SELECT *, 'UNUSUAL_HOUR' FROM tx WHERE amount > 1000 AND hour_of_day BETWEEN 2 AND 5),
point AS (
  SELECT sha256(alert_type || '|' || transaction_id) AS alert_id, alert_type, transaction_id,
    user_id, amount, merchant_id, location, "timestamp",
    CASE WHEN alert_type <> 'HIGH_AMOUNT' THEN 'MEDIUM'
      WHEN amount > 10000 THEN 'CRITICAL' ELSE 'LOW' END AS severity, processing_date
  FROM hits)"""

RAPID = """
rapid AS (
  SELECT sha256('RAPID_TRANSACTIONS|' || user_id || '|' || processing_date || 'T00:00:00')
      AS alert_id,
    'RAPID_TRANSACTIONS' AS alert_type, user_id, 'HIGH' AS severity,
    count(*) AS transaction_count, '1_day' AS time_window,
    last(transaction_id ORDER BY ts, transaction_id) AS last_transaction_id, processing_date
  FROM tx GROUP BY user_id, processing_date HAVING count(*) > 3)"""

ALERTS = """
alerts AS (SELECT * FROM point UNION ALL BY NAME SELECT * FROM rapid)"""

NOTIFY = """
SELECT alert_id, alert_type, a.severity, user_id, coalesce(amount, 0) AS amount, channel
FROM alerts a JOIN (VALUES ('CRITICAL', 'email'), ('CRITICAL', 'sms'), ('CRITICAL', 'slack'),
  ('HIGH', 'email'), ('HIGH', 'slack'), ('MEDIUM', 'email')) m(severity, channel)
  ON m.severity = a.severity"""

AUDIT = "alert_id, alert_type, severity, user_id, transaction_id, amount, location, merchant_id"


def _alerts(select: str) -> str:
    return _with(TX, POINT, RAPID, ALERTS, select=select)


def _point(kind: str) -> str:
    return _with(TX, POINT, select=f"SELECT * FROM point WHERE alert_type = '{kind}'")


def _report(keys: str, more: str = "", tail: str = "", where: str = "true") -> str:
    return _tx(f"SELECT {keys}, {COUNTS}{more} FROM tx WHERE {where} GROUP BY {keys} {tail}")


AVG = f", {_mean()} AS avg_amount"
LAST_30 = f"processing_date >= {TODAY} - INTERVAL 30 DAY"

BEHAVIOR = f"""
users AS (
  SELECT user_id, count(*) AS transaction_count,
    count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT location) AS unique_locations,
    (2 * sum(c) + count(c)) // (2 * count(c)) AS avg_cents,
    round(stddev_samp(amount), 2) AS amount_stddev, cast(sum(is_fraud) AS bigint) AS fraud_count
  FROM tx WHERE {LAST_30} GROUP BY user_id)"""


def _index(column: str) -> str:
    """Position of each value by falling frequency, then by name."""
    return (
        f"{column}_ix AS (SELECT {column}, cast(row_number() OVER "
        f"(ORDER BY count(*) DESC, {column}) - 1 AS double) AS {column}_idx "
        f"FROM tx GROUP BY {column})"
    )


CATEGORIES = ["merchant_category", "location", "channel", "card_type"]
INDEXES = ", ".join(_index(c) for c in CATEGORIES)
INDEX_JOINS = " ".join(f"JOIN {c}_ix USING ({c})" for c in CATEGORIES)
INDEX_COLUMNS = ", ".join(f"{c}_idx" for c in CATEGORIES)

SPLIT = "cast('0x' || substr(md5(transaction_id), 1, 4) AS integer) % 5 = 0"


def _wire(column: str) -> str:
    """What is left of a field once the messages are damaged."""
    lost = "m = 0"
    if column.strip() == "amount":
        lost = "m IN (0, 1, 2)"
    return f"CASE WHEN {lost} THEN NULL ELSE {column} END AS {column}"


DAMAGED = "(SELECT *, event_id % 20 AS m FROM tx)"
STRICT_TEXT = ["transaction_id", "user_id", "merchant_id", "location", '"timestamp"', "hour_of_day"]

ORACLE: dict[str, str] = {
    "label_fraud": _tx("SELECT transaction_id, is_fraud FROM tx"),
    "user_stats": _with(
        TX,
        STATS,
        select="""SELECT user_id, user_avg_amount, user_transaction_count,
            round(sd, 4) AS user_amount_stddev FROM stats""",
    ),
    "amount_percentile": _with(
        TX,
        STATS,
        ENRICHED,
        select="SELECT transaction_id, amount, amount_percentile FROM ranked",
    ),
    "enrich_transactions": _with(TX, STATS, ENRICHED, select="SELECT * FROM enriched"),
    "table_roundtrip": _with(TX, STATS, ENRICHED, select="SELECT * FROM enriched"),
    "merchant_category": _tx("SELECT transaction_id, merchant_id, merchant_category FROM tx"),
    "calendar_features": _tx("SELECT transaction_id, hour_of_day, is_weekend FROM tx"),
    "daily_fraud_stats": _report(
        "processing_date",
        f", {_mean()} AS avg_transaction_amount, "
        f"{_cents('sum(CASE WHEN is_fraud = 1 THEN c ELSE 0 END)')} AS total_fraud_amount",
    ),
    "daily_fraud_rate": _report("processing_date"),
    "top_fraud_users": _report(
        "user_id",
        f"{AVG}, {_cents('sum(c)')} AS total_amount",
        "HAVING sum(is_fraud) > 0 ORDER BY fraud_transactions DESC, user_id LIMIT 20",
    ),
    "merchant_analysis": _report(
        "merchant_id, merchant_category",
        AVG,
        "HAVING count(*) >= 10 "
        "ORDER BY fraud_rate_percent DESC, merchant_id, merchant_category LIMIT 20",
    ),
    "location_analysis": _report("location", AVG, "HAVING count(*) >= 5"),
    "time_patterns": _report("hour_of_day, is_weekend"),
    "channel_card_analysis": _report("channel, card_type", AVG),
    "amount_bands": _tx(f"""
        SELECT amount_range, {COUNTS} FROM (
          SELECT *, CASE WHEN amount < 100 THEN '< $100' WHEN amount < 500 THEN '$100 - $500'
            WHEN amount < 1000 THEN '$500 - $1000' WHEN amount < 5000 THEN '$1000 - $5000'
            ELSE '> $5000' END AS amount_range FROM tx)
        GROUP BY amount_range"""),
    "user_behavior": _with(
        TX,
        BEHAVIOR,
        select="""SELECT user_id, transaction_count, unique_merchants, unique_locations,
            cast(avg_cents AS double) / 100 AS avg_amount, amount_stddev, fraud_count
            FROM users""",
    ),
    "user_activity": _with(
        TX,
        BEHAVIOR,
        select=f"""
        SELECT CASE WHEN transaction_count < 10 THEN 'Low Activity'
            WHEN transaction_count < 50 THEN 'Medium Activity' ELSE 'High Activity' END
            AS activity_level,
          count(*) AS user_count,
          {_mean("sum(avg_cents)", "count(*)")} AS avg_transaction_amount,
          cast(sum(fraud_count) AS bigint) AS total_fraud_transactions,
          {_pct("sum(fraud_count)", "sum(transaction_count)")} AS fraud_rate_percent
        FROM users GROUP BY 1""",
    ),
    "fraud_trend": _tx(f"""
        SELECT processing_date, total_transactions, fraud_transactions,
          cast(rate AS double) / 100 AS fraud_rate_percent,
          cast(before AS double) / 100 AS prev_fraud_rate,
          cast(rate - before AS double) / 100 AS fraud_rate_change
        FROM (
          SELECT *, lag(rate) OVER (ORDER BY processing_date) AS before FROM (
            SELECT processing_date, count(*) AS total_transactions,
              cast(sum(is_fraud) AS bigint) AS fraud_transactions,
              (20000 * sum(is_fraud) + count(*)) // (2 * count(*)) AS rate
            FROM tx WHERE {LAST_30} GROUP BY processing_date))"""),
    "merchant_fraud_today": _report(
        "merchant_id",
        tail="HAVING count(*) >= 10 ORDER BY fraud_rate_percent DESC, merchant_id LIMIT 10",
        where=f"processing_date = {TODAY}",
    ),
    "hourly_pattern_today": _report("hour_of_day", where=f"processing_date = {TODAY}"),
    "alert_high_amount": _point("HIGH_AMOUNT"),
    "alert_unusual_location": _point("UNUSUAL_LOCATION"),
    "alert_unusual_hour": _point("UNUSUAL_HOUR"),
    "alert_severity": _with(
        TX, POINT, select="SELECT transaction_id, alert_type, amount, severity FROM point"
    ),
    "alert_rapid": _with(TX, RAPID, select="SELECT * FROM rapid"),
    "all_alerts": _alerts("SELECT * FROM alerts"),
    "alerts_summary": _alerts(f"""
        SELECT alert_type, severity, count(*) AS alert_count,
          count(DISTINCT user_id) AS affected_users,
          CASE WHEN count(amount) > 0 THEN {_mean(
              "sum(cast(round(amount * 100) AS bigint))", "count(amount)"
          )} END AS avg_amount
        FROM alerts WHERE processing_date >= {TODAY} - INTERVAL 7 DAY
        GROUP BY alert_type, severity"""),
    "alert_routing": _alerts(NOTIFY),
    "critical_alerts": _alerts(
        f"SELECT {AUDIT}, 'IMMEDIATE_RESPONSE' AS action FROM alerts WHERE severity = 'CRITICAL'"
    ),
    "alert_audit_log": _alerts(f"SELECT {AUDIT} FROM alerts"),
    "stream_alerts": _alerts("SELECT * FROM alerts"),
    "stream_notifications": _alerts(NOTIFY),
    "decode_transactions": _tx(
        f"SELECT {', '.join(_wire(c) for c in WIRE.split(','))}, m IN (0, 1) AS is_corrupt "
        f"FROM {DAMAGED}"
    ),
    "decode_strict": _tx(
        f"SELECT {', '.join(_wire(c) for c in STRICT_TEXT)}, "
        "CASE WHEN m IN (0, 2) THEN NULL ELSE amount END AS amount, "
        "CASE m WHEN 0 THEN 'malformed' WHEN 2 THEN 'missing: amount' END AS reject_reason "
        f"FROM {DAMAGED}"
    ),
    "batch_run": _with(
        TX,
        f"""
        landed AS (
          SELECT CASE WHEN m > 0 THEN processing_date END AS processing_date,
            CASE WHEN m > 2 THEN amount END AS amount, CASE WHEN m > 2 THEN c END AS c,
            CASE WHEN m > 0 THEN location END AS location,
            CASE WHEN m > 0 THEN hour_of_day END AS hour_of_day
          FROM {DAMAGED}),
        judged AS (
          SELECT *, CASE WHEN amount > 5000 OR location = 'Unknown Location'
            OR (hour_of_day BETWEEN 2 AND 5 AND amount > 1000) THEN 1 ELSE 0 END AS is_fraud
          FROM landed)""",
        select=f"""
        SELECT processing_date, {COUNTS},
          CASE WHEN count(c) > 0 THEN {_mean()} END AS avg_transaction_amount,
          {_cents('sum(CASE WHEN is_fraud = 1 THEN c ELSE 0 END)')} AS total_fraud_amount
        FROM judged GROUP BY processing_date""",
    ),
    "batch_rerun": _with(
        TX,
        STATS,
        ENRICHED,
        select=f"SELECT * REPLACE ({TODAY} AS processing_date) FROM enriched",
    ),
    "detection_job": _with(
        TX,
        f"usable AS (SELECT * EXCLUDE m FROM {DAMAGED} WHERE m NOT IN (0, 2))",
        POINT.replace("FROM tx", "FROM usable"),
        RAPID.replace("FROM tx", "FROM usable"),
        ALERTS,
        select="SELECT * FROM alerts",
    ),
    "alert_messages": _alerts("SELECT *, true AS key_is_user FROM alerts"),
    "response_times": _with(
        TX,
        POINT,
        select="""SELECT alert_type, count(*) AS alerts, true AS p50_seconds_in_bound,
            true AS p95_seconds_in_bound, true AS p99_seconds_in_bound
            FROM point GROUP BY alert_type""",
    ),
    "stream_rejects": _tx(
        "SELECT CASE WHEN m > 0 THEN transaction_id END AS transaction_id, "
        "CASE WHEN m > 0 THEN user_id END AS user_id, "
        "CASE m WHEN 0 THEN 'malformed' ELSE 'missing: amount' END AS reject_reason "
        f"FROM {DAMAGED} WHERE m IN (0, 2)"
    ),
    "row_counts": _tx(
        f"SELECT count(*) AS total_rows, count(*) FILTER (NOT {SPLIT}) AS train_rows, "
        f"count(*) FILTER ({SPLIT}) AS test_rows FROM tx"
    ),
    "training_extract": _tx("""
        SELECT transaction_id, user_id, amount, merchant_category, location, hour_of_day,
          is_weekend, channel, card_type, is_fraud
        FROM tx WHERE is_fraud IS NOT NULL"""),
    "ml_features": _with(
        TX,
        INDEXES,
        select=f"""
        SELECT transaction_id, amount, round(ln(amount + 1), 6) AS amount_log,
          cast(hour_of_day AS double) AS hour_of_day, cast(is_weekend AS double) AS is_weekend,
          cast(amount > 1000 AS double) AS is_high_amount,
          cast(hour_of_day >= 22 OR hour_of_day <= 6 AS double) AS is_night_transaction,
          {INDEX_COLUMNS}
        FROM tx {INDEX_JOINS}""",
    ),
    "ml_split": _tx(f"SELECT transaction_id, {SPLIT} AS is_test FROM tx"),
    "ml_score": _tx(f"""
        SELECT transaction_id, is_fraud, true AS prediction_valid, true AS probability_valid,
          true AS agrees
        FROM tx WHERE {SPLIT}"""),
    "ml_confusion": _tx(f"""
        SELECT is_fraud AS label, count(*) AS rows FROM tx WHERE {SPLIT} GROUP BY is_fraud"""),
    "ml_model_selection": """
        SELECT model_name, true AS better_than_chance, true AS chosen_by_rule
        FROM (VALUES ('RandomForest'), ('LogisticRegression')) names(model_name)""",
    "ml_string_index": _with(
        TX, INDEXES, select=f"SELECT transaction_id, {INDEX_COLUMNS} FROM tx {INDEX_JOINS}"
    ),
    "ml_scaled_amount": _tx("""
        SELECT transaction_id, round(amount / (SELECT stddev_samp(amount) FROM tx), 6)
          AS scaled_amount
        FROM tx"""),
    "ml_auc": _tx("""
        SELECT count(*) AS rows, round(
          (sum(place) FILTER (is_fraud = 1) - sum(is_fraud) * (sum(is_fraud) + 1) / 2)
            / (sum(is_fraud) * sum(1 - is_fraud)), 6) AS auc
        FROM (SELECT is_fraud, rank() OVER (ORDER BY amount)
            + (count(*) OVER (PARTITION BY amount) - 1) / 2 AS place FROM tx)"""),
    "throughput_hourly": _tx("""
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
          count(*) AS transactions
        FROM tx GROUP BY 1"""),
    "detection_rate": _with(
        TX,
        POINT,
        select=f"""
        SELECT count(*) AS fraud_transactions, sum(found)::bigint AS detected,
          {_pct("sum(found)")} AS detection_rate_percent
        FROM (SELECT cast(transaction_id IN (SELECT transaction_id FROM point) AS integer) AS found
          FROM tx WHERE is_fraud = 1)""",
    ),
}
