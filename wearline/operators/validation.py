"""Silver row status: every reading is kept and labelled, none is dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X


@dataclass(frozen=True)
class Rules:
    """Columns that must be present and columns that must be above zero."""

    required: tuple[str, ...]
    positive: tuple[str, ...] = ()


# The three rule sets in use.
PRESETS = {
    "full": Rules(required=("engine_id", "cycle", *S.KEY_SENSORS), positive=S.KEY_SENSORS),
    "nulls_only": Rules(required=("engine_id", "cycle", *S.KEY_SENSORS)),
    "staging": Rules(required=("engine_id", "cycle"), positive=("sensor_02", "sensor_04")),
}


def validate(df: DataFrame, rules: str | Rules = "full", reject_nan: bool = False) -> DataFrame:
    """Add ``status``; a missing value takes precedence over a range error.

    ``NaN <= 0`` is false, so NaN counts as valid unless ``reject_nan`` is set.
    Row-local, hence also usable on a stream.
    """
    chosen = PRESETS[rules] if isinstance(rules, str) else rules
    missing = X.any_null(chosen.required)
    if reject_nan:
        doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
        watched = dict.fromkeys((*chosen.required, *chosen.positive))
        missing = missing | X.any_nan(c for c in watched if c in doubles)
    status = F.when(missing, S.INVALID_NULL)
    if chosen.positive:
        status = status.when(X.any_nonpositive(chosen.positive), S.INVALID_RANGE)
    return df.withColumn("status", status.otherwise(S.VALID))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == S.VALID)


def rows_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def engine_count(df: DataFrame) -> DataFrame:
    """Exact number of series, as one row."""
    return df.agg(F.count_distinct(*(F.col(c) for c in S.KEY)).alias("engines"))
