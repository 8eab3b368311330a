"""Propensity and product models: fit, score, keep."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import argmax, lookup
from .metrics import class_range

LABEL = "label"
FEATURES = "features"
PROBABILITY = "probability"
PREDICTION = "prediction"
_VECTOR = "_vector"
_RAW = "_raw"


def _as_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn(_VECTOR, array_to_vector(F.col(features)))


def fit_propensity(df: DataFrame, features: str = FEATURES, seed: int = 7, **params) -> GBTClassificationModel:
    """Binary gradient-boosted trees."""
    trainer = GBTClassifier(labelCol=LABEL, featuresCol=_VECTOR, predictionCol="_class", seed=seed,
                            **{"maxIter": 20, "maxDepth": 4, **params})
    return trainer.setProbabilityCol(_RAW).setRawPredictionCol("_margin").fit(_as_vector(df.select(features, LABEL), features))


def with_labels(df: DataFrame, labels: dict[str, int], product: str = "prod_id") -> DataFrame:
    """Class of the product; products without a class or with one below 0 are left out."""
    known = {p: c for p, c in labels.items() if c >= 0}
    return df.withColumn(LABEL, lookup(F.col(product), known)).where(F.col(LABEL).isNotNull())


def pad_classes(df: DataFrame, classes: int, width: int, features: str = FEATURES) -> DataFrame:
    """One zero row for every class that has no sample, so that the model knows all classes."""
    rows = df.select(features, F.col(LABEL).cast("int").alias(LABEL))
    missing = class_range(df.sparkSession, classes, LABEL).join(rows.select(LABEL).distinct(), LABEL, "left_anti")
    return rows.unionByName(missing.select(F.array_repeat(F.lit(0.0), width).alias(features), LABEL))


def fit_products(df: DataFrame, classes: int, features: str = FEATURES, max_iter: int = 20):
    """Multinomial model over the product classes."""
    width = df.select(F.size(features)).first()[0]
    padded = pad_classes(df, classes, width, features)
    trainer = LogisticRegression(labelCol=LABEL, featuresCol=_VECTOR, predictionCol="_class", probabilityCol=_RAW,
                                 rawPredictionCol="_margin", family="multinomial", maxIter=max_iter, regParam=0.01)
    return trainer.fit(_as_vector(padded, features))


def score(df: DataFrame, model, features: str = FEATURES) -> DataFrame:
    """Add probabilities per class and the most likely class. Rows without features get
    probability 0 for every class."""
    width, classes = model.numFeatures, model.numClasses
    zeros = F.array_repeat(F.lit(0.0), width)
    ready = df.withColumn("_filled", F.coalesce(F.col(features), zeros))
    scored = model.transform(_as_vector(ready, "_filled"))
    values = F.when(F.col(features).isNotNull(), vector_to_array(_RAW)).otherwise(F.array_repeat(F.lit(0.0), classes))
    return scored.select(*df.columns, values.alias(PROBABILITY)).withColumn(PREDICTION, argmax(F.col(PROBABILITY)))


def score_pool(users: DataFrame, model, features: str = "user_features") -> DataFrame:
    """Users with the probability of class 1 as score."""
    scored = score(users, model, features)
    kept = [c for c in users.columns if c != features]
    return scored.select(*kept, F.get(PROBABILITY, 1).alias("score"))


def save_model(model, path: str, day: str) -> None:
    """Current version and a copy under the day."""
    model.write().overwrite().save(f"{path}/current")
    model.write().overwrite().save(f"{path}/{day}")


def load_propensity(path: str, day: str = "current") -> GBTClassificationModel:
    return GBTClassificationModel.load(f"{path}/{day}")


def load_products(path: str, day: str = "current") -> LogisticRegressionModel:
    return LogisticRegressionModel.load(f"{path}/{day}")


def write_inference(df: DataFrame, model, path: str, features: str = FEATURES, key: str = "user_id") -> DataFrame:
    """Score, write key, prediction and probabilities as parquet, and read them back."""
    score(df, model, features).select(key, PREDICTION, PROBABILITY).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def item_columns(labels: Sequence[int]) -> list:
    """Probability columns of single classes, for reports."""
    return [F.get(PROBABILITY, label).alias(f"p{label}") for label in labels]
