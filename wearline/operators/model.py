"""Remaining-life model on Spark ML: fit, predict and score without collecting rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X

# The forest of the baseline model.
FOREST = {"numTrees": 100, "maxDepth": 12, "minInstancesPerNode": 5, "seed": 42}
# Memory for split statistics of one task, and an executor runs several: 2,048 ended executors of 1,800 MB heap.
# More lets one pass over the rows grow more nodes. The forest stays the same.
PASS_MEMORY_MB = 256


def feature_vectors(
    df: DataFrame,
    features: Sequence[str] = S.FEATURES,
    output: str = "features",
    invalid: str = "error",
) -> DataFrame:
    """Features as one vector.

    Of rows that lack one, ``invalid="skip"`` leaves them out and ``"null"``
    keeps them without a vector.
    """
    kept = "keep" if invalid == "null" else invalid
    assembler = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=kept)
    vectors = assembler.transform(df)
    if invalid != "null":
        return vectors
    lacking = X.any_null(features) | X.any_nan(features)
    return vectors.withColumn(output, F.when(~lacking, F.col(output)))


def train_rul(
    train: DataFrame, features: Sequence[str] = S.FEATURES, label: str = "rul", **forest
) -> RandomForestRegressionModel:
    """Fit a forest on the (scaled) train rows; every split may use every feature.

    Rows remember their node of each tree, so that no pass goes down from the roots again.
    """
    passes = {"maxMemoryInMB": PASS_MEMORY_MB, "cacheNodeIds": True}
    settings = {**FOREST, "featureSubsetStrategy": "all", **passes, **forest}
    learner = RandomForestRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", **settings
    )
    rows = feature_vectors(train, features)
    return learner.fit(rows.select("features", F.col(label).cast("double").alias("label")))


def predict(
    model: RandomForestRegressionModel,
    test: DataFrame,
    features: Sequence[str] = S.FEATURES,
    label: str = "rul",
) -> DataFrame:
    """Actual and predicted remaining life of the test rows."""
    predicted = model.transform(feature_vectors(test, features))
    return predicted.select(
        *S.KEY, "cycle", F.col(label).cast("double").alias("label"), "prediction"
    )


def evaluate(
    predictions: DataFrame,
    by: Sequence[str] = ("dataset_id",),
    label: str | Column = "label",
    prediction: str | Column = "prediction",
    digits: int | None = None,
) -> DataFrame:
    """RMSE and mean absolute error per dataset, in one aggregate."""
    def column(c):
        return F.col(c) if isinstance(c, str) else c

    def shown(c):
        return c if digits is None else F.round(c, digits)

    error = column(prediction) - column(label)
    return predictions.groupBy(*by).agg(
        shown(F.sqrt(F.avg(error * error))).alias("rmse"),
        shown(F.avg(F.abs(error))).alias("mae"),
    )


def display_sample(
    df: DataFrame, n: int, by: Sequence[str] = ("dataset_id",), key: Sequence[str] = (*S.KEY, "cycle")
) -> DataFrame:
    """The ``n`` rows of each group whose keys have the least hashes; equal hashes go by content.

    Which rows these are depends on the keys alone. A task sends at most ``n``
    rows of a group on: Spark limits the groups before it moves them, as long as
    ``n`` is not over ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000).
    """
    hashed = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in key)))
    order = Window.partitionBy(*by).orderBy("__hash", *(c for c in df.columns if c not in by))
    placed = df.withColumn("__hash", hashed).withColumn("__place", F.row_number().over(order))
    return placed.filter(F.col("__place") <= n).drop("__hash", "__place")
