from __future__ import annotations

import math

import datetime as dt
import random

import pytest
import samples
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.functions import money
from tillwarden.operators import enrich
from tillwarden.operators.lookup import attach_per_key
from tillwarden.operators.ranking import with_percentile


def _amounts(spark, amounts):
    rows = [(str(i), a) for i, a in enumerate(amounts)]
    return spark.createDataFrame(rows, "transaction_id string, amount double").repartition(3)


def _mixed(n, seed):
    pick = random.Random(seed)
    special = [None, float("nan"), -5.0, 0.0, -0.0, 7.25, float("inf"), 1e300]
    return [
        pick.choice(special) if pick.random() < 0.4 else round(pick.uniform(-50, 5000), 2)
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "amounts",
    [
        [3.5],
        [4.0] * 9,
        [None] * 5,
        [None, 1.0],
        [1.0, 2.0, 2.0, 3.0],
        _mixed(206, 1),
        _mixed(1500, 2),
        [12.5] * 400 + _mixed(800, 3),
        [float(i) for i in range(2000)],
        [float(i) for i in range(1, 400)] * 3 + [0.0, -0.0, float("nan"), float("inf"), None],
    ],
    ids=[
        "one",
        "ties",
        "nulls",
        "null-first",
        "simple",
        "mixed",
        "larger",
        "hot",
        "distinct",
        "special-values-not-heavy",
    ],
)
def test_percentile_equals_the_window_function(spark, amounts):
    rows = _amounts(spark, amounts)
    plain = rows.withColumn("expected", F.percent_rank().over(W.orderBy("amount")))
    ours = with_percentile(rows)
    wrong = (
        ours.join(plain.select("transaction_id", "expected"), "transaction_id")
        .where(~F.col("amount_percentile").eqNullSafe(F.col("expected")))
        .collect()
    )
    assert wrong == []
    assert ours.count() == len(amounts)


@pytest.mark.parametrize("heavy_keys", [1, 3, 1000])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_attach_equals_a_plain_left_join(spark, heavy_keys, broadcast):
    """A third of the rows on one key, copies of one row, and rows without a key."""
    data = [(f"t{i}", "hot") for i in range(300)] + [("copy", "hot2")] * 100
    data += [(f"n{i}", None) for i in range(50)] + [(f"c{i}", f"u{i % 97}") for i in range(450)]
    rows = spark.createDataFrame(data, "transaction_id string, user_id string").repartition(5)
    counts = rows.groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("transaction_id").alias("latest")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        ours = attach_per_key(rows, counts, "user_id", "n", "transaction_id", heavy_keys)
        plain = rows.join(counts, "user_id", "left").select(*ours.columns)
        assert ours.exceptAll(plain).isEmpty()
        assert ours.count() == len(data)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_user_statistics(spark):
    rows = samples.transactions(
        spark,
        [
            samples.wire_row("1", "a", 10.0),
            samples.wire_row("2", "a", 20.0),
            samples.wire_row("3", "a", None),
            samples.wire_row("4", "b", 5.0),
            samples.wire_row("5", None, 7.0),
        ],
    )
    stats = {r.user_id: r for r in enrich.user_stats(rows).collect()}
    assert (stats["a"].user_avg_amount, stats["a"].user_transaction_count) == (15.0, 3)
    assert stats["a"].user_amount_stddev == pytest.approx(7.0710678)
    assert stats["b"].user_amount_stddev is None
    joined = {r.transaction_id: r for r in enrich.with_user_stats(rows).collect()}
    assert len(joined) == 5
    assert joined["5"].user_avg_amount is None
    assert joined["5"].user_transaction_count is None


def test_unusual_amount_needs_more_than_five_rows(spark):
    def rows(n):
        small = [samples.wire_row(f"s{i}", "a", 1.0) for i in range(n - 1)]
        return samples.transactions(spark, [*small, samples.wire_row("big", "a", 1000.0)])

    flags = {
        n: [r.transaction_id for r in enrich.enrich(rows(n)).where("is_unusual_amount").collect()]
        for n in (5, 6)
    }
    assert flags == {5: [], 6: ["big"]}


def test_unknowns_stay_unknown(spark):
    rows = {r.transaction_id: r for r in enrich.enrich(samples.boundary(spark)).collect()}
    assert rows["b13"].is_unusual_amount is None
    assert rows["b15"].is_unusual_location is None
    assert {i: r.is_fraud for i, r in rows.items()} == {b[0]: b[4] for b in samples.BOUNDARY}


def test_processed_layout_and_dates(spark):
    rows = enrich.enrich(samples.boundary(spark))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in schemas.PROCESSED
    ]
    assert {r.processing_date for r in rows.collect()} == {dt.date(2024, 3, 1)}
    stamped = enrich.enrich(samples.boundary(spark), dt.date(2025, 1, 2))
    assert {r.processing_date for r in stamped.collect()} == {dt.date(2025, 1, 2)}


def test_merchant_categories(spark):
    rows = spark.createDataFrame([("Shell",), ("Nobody",), (None,)], "merchant_id string")
    found = {r.merchant_id: r.merchant_category for r in enrich.with_merchant_category(rows).collect()}
    assert found == {"Shell": "gas", "Nobody": "other", None: "other"}
    own = spark.createDataFrame([("Nobody", "x")], "merchant_id string, merchant_category string")
    found = {
        r.merchant_id: r.merchant_category for r in enrich.with_merchant_category(rows, own).collect()
    }
    assert found == {"Shell": "other", "Nobody": "x", None: "other"}


def test_money_does_not_depend_on_order(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "amount double")
    row = rows.select(
        money.total("amount").alias("t"),
        money.mean("amount").alias("m"),
        money.rounded_mean("amount").alias("r"),
    ).first()
    assert (row.t, row.m, row.r) == (0.6, 0.2, 0.2)
    none = rows.where("amount IS NULL").select(
        money.total("amount").alias("t"), money.mean("amount").alias("m")
    )
    assert tuple(none.first()) == (None, None)
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "amount double")
    assert math.isnan(odd.select(money.mean("amount").alias("m")).first().m)


def test_money_loses_no_amount(spark):
    rows = spark.createDataFrame(
        [("big", 1e18), ("big", 1.0), ("cents", 10.005), ("small", 0.004), ("huge", 1e300), ("huge", None)],
        "user string, amount double",
    )
    made = rows.groupBy("user").agg(money.mean("amount").alias("m"), money.total("amount").alias("t"))
    found = {r.user: (r.m, r.t) for r in made.collect()}
    assert found == {
        "big": ((1e18 + 1.0) / 2, 1e18 + 1.0),
        "cents": (10.005, 10.005),
        "small": (0.004, 0.004),
        "huge": (1e300, 1e300),
    }
