"""Train both classifiers, keep the better, save it with its description."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import RuleConfig
from tillwarden.operators import learning
from tillwarden.operators.categories import CategoryModel


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    aucs: dict[str, float]
    filled_rows: int = 0

    @property
    def auc(self) -> float:
        return self.aucs[self.name]


def train(
    rows: DataFrame,
    cfg: RuleConfig = RuleConfig(),
    trees: int = 100,
    depth: int = 10,
    iterations: int = 100,
    rows_per_partition: int = 50_000,
) -> Trained:
    """Fit features and both models on the training rows, judge on the test rows.

    Only label and feature vector are kept for the iterations, in memory as far
    as they fit and else on disk; lost blocks are computed again. The label
    follows from three of the features, so a high score is expected.
    Training rows are placed by a hash of their id and sorted by all their features,
    in as many partitions as their number asks for, so that neither the cores nor the
    files they came in decide the fit, even if ids repeat. Rows alike in their features
    are then neighbours and take the same ways through the trees, which the forest goes
    through sooner. Rows that lack a number stay; they are counted.
    """
    train_rows, test_rows = learning.split(rows)
    counts = train_rows.agg(
        F.count("*").alias("rows"), F.count_if(learning.needs_filling()).alias("filled")
    ).first()
    *making, scaler = learning.feature_stages(cfg).getStages()
    made = Pipeline(stages=making).fit(train_rows)
    partitions = max(1, -(-counts.rows // rows_per_partition))
    raw = (
        made.transform(train_rows)
        .repartition(partitions, "transaction_id")
        .sortWithinPartitions(*learning.model_inputs(), learning.LABEL)
        .select(learning.LABEL, "features_raw")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    scaling = scaler.fit(raw)
    features = PipelineModel(stages=[*made.stages, scaling])
    wanted = [learning.LABEL, "features"]
    fit_on = scaling.transform(raw).select(*wanted)
    judge_on = features.transform(test_rows).select(*wanted)
    judge_on = judge_on.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models, aucs = {}, {}
        for name, estimator in learning.classifiers(trees, depth, iterations).items():
            models[name] = estimator.fit(fit_on)
            aucs[name] = learning.area_under_roc(models[name].transform(judge_on))
    finally:
        raw.unpersist()
        judge_on.unpersist()
    best = learning.better(aucs["RandomForest"], aucs["LogisticRegression"])
    model = learning.with_classifier(features, models[best])
    return Trained(best, model, aucs, counts.filled)


def save(spark: SparkSession, trained: Trained, folder: str) -> str:
    """Overwrite the model of that name; append a line about it to ``metadata``.

    The dictionaries of its categories are copied to a folder of their own beside it,
    so that a model loaded before still finds those it was saved with.
    """
    path = f"{folder.rstrip('/')}/{trained.name.lower()}"
    place = f"{folder.rstrip('/')}/categories/{uuid.uuid4().hex}"
    stages = [s.kept_in(spark, place) if isinstance(s, CategoryModel) else s for s in trained.model.stages]
    PipelineModel(stages).write().overwrite().save(path)
    about = spark.range(1).select(
        F.lit(trained.name).alias("model_name"),
        F.lit(path).alias("model_path"),
        F.current_timestamp().alias("training_timestamp"),
        F.array(*[F.lit(f) for f in learning.FEATURES]).alias("features"),
        F.lit(trained.auc).alias("auc"),
        F.lit(trained.filled_rows).cast("long").alias("filled_rows"),
    )
    about.coalesce(1).write.mode("append").json(f"{folder.rstrip('/')}/metadata")
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_training(
    processed: DataFrame, folder: str, cfg: RuleConfig = RuleConfig(), **sizes: int
) -> Trained | None:
    """Extract, train, save; None when there is nothing to learn from."""
    rows = learning.training_extract(processed)
    if rows.isEmpty():
        return None
    trained = train(rows, cfg, **sizes)
    save(processed.sparkSession, trained, folder)
    return trained
