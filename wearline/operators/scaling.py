"""Standardization as aggregates and lookups: globally or per operating condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X

BY_CONDITION = ("dataset_id", "op_cond")
BY_DATASET = ("dataset_id",)


def with_op_condition(
    df: DataFrame, settings: Sequence[str] = S.SETTINGS[:2], digits: int = 2
) -> DataFrame:
    return df.withColumn("op_cond", X.operating_condition(settings, digits))


def complete_rows(df: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Rows with every feature present; NULL and NaN both count as absent."""
    return df.dropna(subset=list(features))


def _mean(feature: str) -> str:
    return f"{feature}__mean"


def _scale(feature: str) -> str:
    return f"{feature}__scale"


def fit_scaler(
    train: DataFrame,
    features: Sequence[str] = S.FEATURES,
    by: Sequence[str] = BY_CONDITION,
) -> DataFrame:
    """One row per group: mean and population deviation of each feature.

    A constant feature gets scale 1, so that it maps to 0 and not to NULL.
    """
    statistics = []
    for feature in features:
        spread = F.stddev_pop(feature)
        statistics += [
            F.avg(feature).alias(_mean(feature)),
            F.when(spread == 0, 1.0).otherwise(spread).alias(_scale(feature)),
        ]
    return train.groupBy(*by).agg(*statistics)


def fit_fallback(
    scaler: DataFrame, features: Sequence[str] = S.FEATURES, by: Sequence[str] = BY_DATASET
) -> DataFrame:
    """Mean over groups of the means and of the scales; each group counts once."""
    columns = [c for f in features for c in (_mean(f), _scale(f))]
    return scaler.groupBy(*by).agg(*(F.avg(c).alias(c) for c in columns))


def scaler_rows(
    scaler: DataFrame,
    features: Sequence[str] = S.FEATURES,
    by: Sequence[str] = BY_CONDITION,
    digits: int | None = None,
) -> DataFrame:
    """A scaler in long form, one row per group and feature, for reports."""
    entries = (
        F.struct(
            F.lit(f).alias("feature"),
            X.rounded(F.col(_mean(f)), digits).alias("mean"),
            X.rounded(F.col(_scale(f)), digits).alias("scale"),
        )
        for f in features
    )
    return scaler.select(*by, F.inline(F.array(*entries)))


def _standard(value: Column, mean: Column, scale: Column) -> Column:
    return F.try_divide(value - mean, scale)


def apply_scaler(
    df: DataFrame,
    scaler: DataFrame,
    features: Sequence[str] = S.FEATURES,
    by: Sequence[str] = BY_CONDITION,
    fallback: DataFrame | None = None,
    eps: float = 1e-8,
) -> DataFrame:
    """Replace the features by their standardized values.

    Groups without a scaler use the fallback of their dataset, with ``eps``
    added to its scale, and stay NULL if there is none. Both lookups are plain
    left joins: written tables carry their size, so small ones are broadcast
    by Spark and large ones sort-merged with adaptive skew handling.
    """
    known = scaler.withColumn("__known", F.lit(True))
    looked_up = df.join(known, list(by), "left")
    if fallback is not None:
        spare = [c for f in features for c in (_mean(f), _scale(f))]
        renamed = fallback.select(
            *BY_DATASET, *(F.col(c).alias(f"__spare_{c}") for c in spare)
        )
        looked_up = looked_up.join(renamed, list(BY_DATASET), "left")
    scaled = {}
    for f in features:
        value = F.when(
            F.col("__known"), _standard(F.col(f), F.col(_mean(f)), F.col(_scale(f)))
        )
        if fallback is not None:
            value = value.otherwise(
                _standard(
                    F.col(f),
                    F.col(f"__spare_{_mean(f)}"),
                    F.col(f"__spare_{_scale(f)}") + F.lit(eps),
                )
            )
        scaled[f] = value
    return looked_up.select(*(scaled[c].alias(c) if c in scaled else c for c in df.columns))


def condition_count(train: DataFrame) -> DataFrame:
    """Operating conditions seen in training, per dataset."""
    seen = train.select(*BY_CONDITION).distinct()
    return seen.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("conditions"))


def unseen_conditions(test: DataFrame, scaler: DataFrame) -> DataFrame:
    """Conditions of the test rows that have no scaler."""
    return test.select(*BY_CONDITION).distinct().join(scaler, list(BY_CONDITION), "left_anti")


def label_distribution(train: DataFrame, label: str = "rul") -> DataFrame:
    return train.groupBy("dataset_id").agg(
        F.min(label).alias(f"min_{label}"),
        F.max(label).alias(f"max_{label}"),
        F.avg(label).alias(f"mean_{label}"),
    )
