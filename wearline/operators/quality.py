"""Declared data-quality checks, evaluated in one aggregate pass per table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators.series import SPAN, SeriesShape, series_windows


@dataclass(frozen=True)
class Check:
    """``not_null``, or ``accepted_values`` when values are given (NULL then passes)."""

    column: str
    accepted: tuple[str, ...] = ()

    @property
    def kind(self) -> str:
        return "accepted_values" if self.accepted else "not_null"

    def fails(self, column: Column | None = None) -> Column:
        column = F.col(self.column) if column is None else column
        return ~column.isin(*self.accepted) if self.accepted else column.isNull()


def not_null(*columns: str) -> tuple[Check, ...]:
    return tuple(Check(c) for c in columns)


# 17 not_null and 2 accepted_values checks.
STAGING_CHECKS = (*not_null("engine_id", "cycle", "status"), Check("status", S.STATUSES))
HEALTH_CHECKS = (
    *not_null("dataset_id", "engine_id", "total_cycles", "life_category"),
    Check("life_category", S.LIFE_CATEGORIES),
)
FEATURE_CHECKS = not_null("dataset_id", "engine_id", "cycle", "rul", "cycle_pct")
DRIFT_CHECKS = not_null("dataset_id", "engine_id", "s02_drift", "s04_drift", "s11_drift")
# Name in the report and checks of each checked Gold table.
GOLD_CHECKS = {
    "engine_health": ("health", HEALTH_CHECKS),
    "ml_features": ("features", FEATURE_CHECKS),
    "sensor_drift": ("drift", DRIFT_CHECKS),
}


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check with the number of failing rows."""
    counted = df.agg(*(X.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(checks)))
    rows = (
        F.struct(
            F.lit(model).alias("model"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_kind"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    )
    return counted.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Report:
    """Checks that were counted while a table was written."""

    model: str
    checks: tuple[Check, ...]
    observation: Observation

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per check with the number of failing rows, once the write is done."""
        counts = self.observation.get
        rows = [(self.model, c.column, c.kind, counts[f"c{i}"]) for i, c in enumerate(self.checks)]
        return spark.createDataFrame(rows, "model string, column_name string, check_kind string, failures long")


def observed(
    df: DataFrame, model: str, checks: Sequence[Check], view: dict[str, Column] | None = None
) -> tuple[DataFrame, Report]:
    """The table with its checks attached to whatever writes it next, and their report.

    ``view`` replaces columns in the checks only (see ``staging_view``).
    """
    view = view or {}
    counts = (X.count_if(c.fails(view.get(c.column))).alias(f"c{i}") for i, c in enumerate(checks))
    observation = Observation(f"{model}-{uuid.uuid4().hex}")
    return df.observe(observation, *counts), Report(model, tuple(checks), observation)


def staging_view() -> dict[str, Column]:
    """Ids as the staging checks look at them: of valid rows only, since others may lack them on purpose."""
    return {c: F.when(F.col("status") == S.VALID, F.col(c)).otherwise(0) for c in ("engine_id", "cycle")}


def check_staging(silver: DataFrame, strict: bool = False) -> DataFrame:
    """Checks of the row-status table.

    Rows with missing ids are kept there on purpose, so the two id checks look
    at valid rows only, unless ``strict``.
    """
    if strict:
        return run_checks(silver, "staging", STAGING_CHECKS)
    seen = silver.select("status", *(value.alias(c) for c, value in staging_view().items()))
    return run_checks(seen, "staging", STAGING_CHECKS)


def rul_violations(
    df: DataFrame, shape: SeriesShape | None = None, span: int = SPAN
) -> DataFrame:
    """Per series: readings and readings whose remaining life did not fall since the last one."""
    narrow = df.select(*S.KEY, "cycle", "max_cycle", "rul")
    before = {"before": lambda w: F.lag("rul", 1).over(w)}
    return (
        series_windows(narrow, before, 1, shape, span)
        .groupBy(*S.KEY)
        .agg(
            F.count(F.lit(1)).alias("readings"),
            X.count_if(F.col("rul") >= F.col("before")).alias("violations"),
        )
    )


def late_stage_is_highest(stages: DataFrame) -> DataFrame:
    """One row telling whether the late life stage has the highest anomaly rate.

    A report, not a failure: it says whether the scores follow degradation.
    """
    rate = F.col("anomaly_rate_pct")
    late = F.max(F.when(F.col("life_stage") == S.LATE_STAGE, rate))
    return stages.agg(
        late.alias("late_rate_pct"),
        F.max(rate).alias("highest_rate_pct"),
        (late >= F.max(rate)).alias("late_is_highest"),
    )
