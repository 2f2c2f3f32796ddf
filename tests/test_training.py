from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwarden.operators import enrich, learning
from tillwarden.plans import metrics, training
from tillwarden.sources import sample

QUICK = {"trees": 5, "depth": 4, "iterations": 10}


@pytest.fixture(scope="module")
def rows(spark):
    from conftest import SMALL

    labelled = enrich.with_label(sample.full_transactions(spark, SMALL))
    return learning.training_extract(labelled).cache()


@pytest.fixture(scope="module")
def trained(rows):
    return training.train(rows, **QUICK)


def _rank_sum(scored, score):
    """Tie-corrected Mann-Whitney form of the area under the curve."""
    tied = W.partitionBy("s")
    ranked = scored.select(F.col(learning.LABEL).alias("y"), score.alias("s")).select(
        "y", (F.rank().over(W.orderBy("s")) + (F.count("*").over(tied) - 1) / 2).alias("place")
    )
    row = ranked.agg(
        F.sum(F.col("place") * F.col("y")).alias("r"), F.sum("y").alias("p"), F.count("*").alias("n")
    ).first()
    return (row.r - row.p * (row.p + 1) / 2) / (row.p * (row.n - row.p))


def test_extract_leaves_out_unlabelled_rows(rows):
    unlabelled = rows.withColumn(learning.LABEL, F.when(F.col("amount") > 100, 1))
    kept = learning.training_extract(unlabelled)
    assert kept.columns == learning.EXTRACT
    assert kept.count() == rows.where("amount > 100").count()


def test_split_is_stable_and_complete(rows):
    train, test = learning.split(rows)
    assert train.count() + test.count() == rows.count()
    assert 0.15 < test.count() / rows.count() < 0.25
    again = learning.split(rows.repartition(7))[1]
    assert again.exceptAll(test).isEmpty()
    counts = metrics.row_counts(rows, learning.is_test_row()).first()
    assert (counts.train_rows, counts.test_rows) == (train.count(), test.count())


def test_a_row_without_id_is_still_split(spark, rows):
    lost = rows.limit(1).withColumn("transaction_id", F.lit(None).cast("string"))
    train, test = learning.split(lost)
    assert train.count() + test.count() == 1


def test_area_under_curve(rows):
    auc = learning.area_under_roc(rows, score="amount")
    assert auc == pytest.approx(_rank_sum(rows, F.col("amount")), abs=1e-9)


def test_selection(trained):
    assert set(trained.aucs) == {"RandomForest", "LogisticRegression"}
    assert trained.auc == max(trained.aucs.values())
    assert learning.better(0.9, 0.8) == "RandomForest"
    assert learning.better(0.8, 0.9) == "LogisticRegression"
    assert learning.better(0.9, 0.9) == "LogisticRegression"


def test_model_auc_matches_the_rank_sum(rows, trained):
    from pyspark.ml.functions import vector_to_array

    _, test = learning.split(rows)
    scored = trained.model.transform(test)
    score = vector_to_array("rawPrediction")[1]
    assert trained.auc == pytest.approx(_rank_sum(scored, score), abs=1e-9)


def test_saved_model_scores_raw_rows(spark, rows, trained, tmp_path):
    folder = str(tmp_path / "models")
    path = training.save(spark, trained, folder)
    training.save(spark, trained, folder)
    wire = rows.drop(learning.LABEL)
    unseen = wire.limit(5).withColumn("location", F.lit("Atlantis"))
    scored = training.load(path).transform(wire.union(unseen))
    assert scored.where("prediction IS NULL").isEmpty()
    assert scored.count() == rows.count() + 5
    about = spark.read.json(f"{folder}/metadata").collect()
    assert len(about) == 2
    assert about[0].model_name == trained.name
    assert about[0].features == learning.FEATURES
    assert about[0].auc == pytest.approx(trained.auc)


def test_saved_model_scores_a_stream(spark, rows, trained, tmp_path):
    path = training.save(spark, trained, str(tmp_path / "models"))
    rows.limit(20).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        training.load(path)
        .transform(stream)
        .select("transaction_id", "prediction")
        .writeStream.format("memory")
        .queryName("scored")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("scored").count() == 20


def test_nothing_to_learn_from(rows, tmp_path):
    empty = rows.where("amount < 0")
    assert training.run_training(empty, str(tmp_path)) is None


def test_confusion_counts_every_row(rows, trained):
    _, test = learning.split(rows)
    table = learning.confusion(trained.model.transform(test)).collect()
    assert sum(r.rows for r in table) == test.count()


def test_response_time(spark):
    rows = spark.createDataFrame(
        [("HIGH_AMOUNT", "2024-03-01T12:00:00", 10), ("HIGH_AMOUNT", "2024-03-01T12:00:00", 30)]
        + [("RAPID_TRANSACTIONS", None, 5)],
        "alert_type string, timestamp string, later int",
    ).selectExpr(
        "alert_type",
        "timestamp",
        "timestamp'2024-03-01 12:00:00' + make_interval(0,0,0,0,0,0,later) AS alert_timestamp",
    )
    found = metrics.response_time(rows).collect()
    assert [(r.alert_type, r.p50_seconds, r.p99_seconds) for r in found] == [
        ("HIGH_AMOUNT", 10.0, 30.0)
    ]


def test_missing_numbers_are_filled_and_no_row_is_lost(spark, rows):
    odd = rows.limit(40).withColumns(
        {
            "amount": F.when(F.rand(1) < 0.5, F.lit(float("nan"))).when(F.rand(2) < 0.5, F.lit(-5.0)),
            "hour_of_day": F.lit(None).cast("int"),
            "is_weekend": F.lit(None).cast("boolean"),
            "location": F.lit(None).cast("string"),
            "transaction_id": F.concat(F.lit("odd"), "transaction_id"),
        }
    )
    mixed = rows.unionByName(odd)
    made = training.train(mixed, **QUICK)
    assert made.filled_rows == learning.split(odd)[0].count()
    scored = made.model.transform(odd)
    assert scored.where("prediction IN (0.0, 1.0)").count() == 40
    assert scored.where("amount IS NULL OR isnan(amount) OR amount = -5").count() == 40


def test_the_fit_does_not_depend_on_how_rows_come(rows):
    one = training.train(rows.repartition(2), **QUICK, rows_per_partition=200)
    other = training.train(rows.repartition(5), **QUICK, rows_per_partition=200)
    assert one.aucs["RandomForest"] == other.aucs["RandomForest"]
    assert abs(one.aucs["LogisticRegression"] - other.aucs["LogisticRegression"]) < 1e-9


def test_rows_are_fitted_in_the_order_of_their_features(rows, monkeypatch):
    """Neighbours take the same ways through the trees; rows that share an id have a place of their own too."""
    shared = rows.withColumn("transaction_id", F.substring("transaction_id", 1, 1))
    seen = []

    class Spy:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, fit_on):
            seen.append([[tuple(r.features) for r in part] for part in fit_on.rdd.glom().collect()])
            return self.estimator.fit(fit_on)

    monkeypatch.setattr(
        learning, "classifiers", lambda *_: {"RandomForest": Spy(learning.random_forest(2, 2)), "LogisticRegression": Spy(learning.logistic_regression(2))}
    )
    for parts in (2, 5):
        training.train(shared.repartition(parts), rows_per_partition=200)
    assert sum(map(len, seen[0])) == learning.split(shared)[0].count()
    assert all(part == sorted(part) for part in seen[0])
    assert all([[[f"{x:.9g}" for x in r] for r in part] for part in one] == [[[f"{x:.9g}" for x in r] for r in part] for part in seen[0]] for one in seen)


def test_fits_and_scoring_read_one_table(spark, small, monkeypatch):
    """The transactions are derived once; what is scored is the table the fits have read."""
    from tillwarden import registry

    derived, train = [], training.train

    def counted(*args):
        derived.append(args)
        return registry.enrich.with_label(sample.full_transactions(*args))

    monkeypatch.setattr(registry, "_categorized", counted)
    monkeypatch.setattr(training, "train", lambda extract: train(extract, **QUICK))
    scored = registry.QUERIES["ml_score"](spark, small)
    assert len(derived) == 1
    assert not any("events.parquet" in f or "customer.parquet" in f for f in scored.inputFiles())
    everything = learning.training_extract(enrich.with_label(sample.full_transactions(spark, small)))
    want = learning.split(everything)[1].select("transaction_id", learning.LABEL)
    got = scored.where("prediction_valid AND probability_valid AND agrees").select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_million_categories_stay_out_of_the_driver(spark, tmp_path, monkeypatch):
    """Places by falling count, then by name, for more values than are ever collected."""
    from pyspark.sql import DataFrame

    from tillwarden.operators.categories import CategoryIndexer

    n = 1_000_000
    rows = spark.range(n + 5000).selectExpr(
        "cast(id AS string) AS transaction_id",
        f"CASE WHEN id < {n} THEN concat('place ', lpad(id, 7, '0')) WHEN id < {n} + 3000 THEN 'place 0500000' "
        f"WHEN id < {n} + 4000 THEN 'a' WHEN id < {n} + 4900 THEN 'b' END AS location",
    )

    def refused(self, *_):
        raise AssertionError("rows were brought to the driver")

    with monkeypatch.context() as patch:
        for name in ("collect", "toPandas"):
            patch.setattr(DataFrame, name, refused)
        model = CategoryIndexer(["location"], ["location_idx"]).fit(rows)
        indexed = model.transform(rows)
    assert model.getOrDefault(model.sizes) == [n + 2]
    found = indexed.groupBy("location").agg(F.max("location_idx").alias("i"), F.min("location_idx").alias("j"))
    asked = ["place 0500000", "a", "b", "place 0000000", "place 0000001", "place 0500001", "place 0999999"]
    got = {r.location: (r.i, r.j) for r in found.where(F.col("location").isNull() | F.col("location").isin(asked)).collect()}
    want = [0, 1, 2, 3, 4, 500003, n + 1]
    assert got == {**{v: (float(i), float(i)) for v, i in zip(asked, want)}, None: (float(n + 2), float(n + 2))}
    assert indexed.count() == n + 5000
