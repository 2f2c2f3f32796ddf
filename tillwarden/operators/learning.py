"""Features, split, models and their scores on MLlib."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.config import RuleConfig
from tillwarden.operators.categories import CategoryIndexer

LABEL = "is_fraud"
CATEGORIES = ["merchant_category", "location", "channel", "card_type"]
INDEXES = [f"{c}_idx" for c in CATEGORIES]

# The features in the order the models see them.
FEATURES = [
    "amount",
    "amount_log",
    "hour_of_day",
    "is_weekend",
    "is_high_amount",
    "is_night_transaction",
    "merchant_category_idx",
    "location_idx",
    "channel_idx",
    "card_type_idx",
]

# The columns of the training extract.
EXTRACT = [
    "transaction_id",
    "user_id",
    "amount",
    "merchant_category",
    "location",
    "hour_of_day",
    "is_weekend",
    "channel",
    "card_type",
    LABEL,
]


def training_extract(processed: DataFrame) -> DataFrame:
    return processed.where(F.col(LABEL).isNotNull()).select(*EXTRACT)


# What the models see of numbers that may be missing; the rows keep their own.
FILLED = {"amount": "amount_filled", "hour_of_day": "hour_filled", "is_weekend": "weekend_filled"}


def needs_filling() -> Column:
    """Whether a number the models need is missing, NaN or infinite."""
    finite = F.abs("amount") < float("inf")
    known = F.col("hour_of_day").isNotNull() & F.col("is_weekend").isNotNull()
    return ~(F.coalesce(finite, F.lit(False)) & known)


def derive(cfg: RuleConfig = RuleConfig()) -> SQLTransformer:
    """The computed features as a stage, so that a saved model scores raw rows.

    An amount that is missing, NaN or infinite counts as 0, a missing hour as -1,
    a missing weekend as no; the logarithm of an amount of -1 or less as 0.
    """
    return SQLTransformer(
        statement=f"""
            SELECT *,
                   if(amount_filled > -1, log1p(amount_filled), 0D) AS amount_log,
                   cast(amount_filled > {cfg.feature_high_amount} AS int) AS is_high_amount,
                   cast(coalesce(hour_of_day >= {cfg.night_from} OR hour_of_day <= {cfg.night_to}, false)
                       AS int) AS is_night_transaction
            FROM (SELECT *,
                      if(coalesce(abs(amount) < double('infinity'), false), amount, 0D) AS amount_filled,
                      coalesce(hour_of_day, -1) AS hour_filled,
                      coalesce(is_weekend, false) AS weekend_filled
                  FROM __THIS__)"""
    )


def string_indexer() -> CategoryIndexer:
    """Most frequent value first, ties alphabetical; a value not seen in training is kept."""
    return CategoryIndexer(CATEGORIES, INDEXES)


def model_inputs() -> list[str]:
    """The columns the feature vector is made of, in the order of ``FEATURES``."""
    return [FILLED.get(f, f) for f in FEATURES]


def feature_stages(cfg: RuleConfig = RuleConfig()) -> Pipeline:
    return Pipeline(
        stages=[
            derive(cfg),
            string_indexer(),
            VectorAssembler(inputCols=model_inputs(), outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol="features"),
        ]
    )


def is_test_row() -> Column:
    """One row in five, by a digest of its id: the same split on any cluster."""
    digest = F.substring(F.md5(F.coalesce("transaction_id", F.lit(""))), 1, 4)
    return F.conv(digest, 16, 10).cast("int") % 5 == 0


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where(~is_test_row()), rows.where(is_test_row())


def random_forest(trees: int = 100, depth: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=42
    )


def logistic_regression(iterations: int = 100) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=iterations)


def classifiers(trees: int = 100, depth: int = 10, iterations: int = 100) -> dict[str, Estimator]:
    return {
        "RandomForest": random_forest(trees, depth),
        "LogisticRegression": logistic_regression(iterations),
    }


def area_under_roc(scored: DataFrame, score: str = "rawPrediction") -> float:
    """Exact: every distinct score is a point of the curve."""
    return BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=LABEL, metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def better(forest_auc: float, regression_auc: float) -> str:
    """The forest must be strictly better to be chosen."""
    return "RandomForest" if forest_auc > regression_auc else "LogisticRegression"


def with_classifier(features: PipelineModel, classifier: Model) -> PipelineModel:
    """One model from raw rows to predictions."""
    return PipelineModel(stages=[*features.stages, classifier])


def confusion(scored: DataFrame) -> DataFrame:
    label, predicted = F.col(LABEL).alias("label"), F.col("prediction").cast("int")
    counts = scored.groupBy(label, predicted.alias("prediction")).agg(F.count("*").alias("rows"))
    return counts.orderBy("label", "prediction")
