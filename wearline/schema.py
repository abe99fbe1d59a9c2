"""Names, schemas and fixed values of the reading tables."""

from __future__ import annotations

from pyspark.sql import types as T

# A series is one engine of one dataset: engine ids repeat across datasets.
KEY = ("dataset_id", "engine_id")

SETTINGS = tuple(f"op_setting_{i}" for i in (1, 2, 3))
SENSORS = tuple(f"sensor_{i:02d}" for i in range(1, 22))

READING_SCHEMA = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in ("engine_id", "cycle")]
    + [T.StructField(name, T.DoubleType()) for name in (*SETTINGS, *SENSORS)]
)

DATASET_FIELD = T.StructField("dataset_id", T.StringType())
CORRUPT_FIELD = T.StructField("_corrupt_record", T.StringType())

# One JSON line of the feed; the corrupt-record field receives unparsable lines.
STREAM_SCHEMA = T.StructType(
    [
        *READING_SCHEMA.fields,
        DATASET_FIELD,
        T.StructField("emitted_at", T.TimestampType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [
        *READING_SCHEMA.fields,
        DATASET_FIELD,
        T.StructField("load_timestamp", T.TimestampType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA.fields,
        T.StructField("status", T.StringType()),
        T.StructField("max_cycle", T.IntegerType()),
        T.StructField("cycle_pct", T.DoubleType()),
        T.StructField("rul", T.IntegerType()),
        T.StructField("silver_timestamp", T.TimestampType()),
    ]
)

# They decide results and must not be changed.
KEY_SENSORS = ("sensor_02", "sensor_03", "sensor_04", "sensor_07", "sensor_11")
VALID = "valid"
INVALID_NULL = "invalid_null"
INVALID_RANGE = "invalid_sensor_range"
STATUSES = (VALID, INVALID_NULL, INVALID_RANGE)
LONG_LIFE = "long_life"
MEDIUM_LIFE = "medium_life"
SHORT_LIFE = "short_life"
LIFE_CATEGORIES = (SHORT_LIFE, MEDIUM_LIFE, LONG_LIFE)
EARLY_STAGE = "early (RUL > 100)"
MID_STAGE = "mid (RUL 30-100)"
LATE_STAGE = "late (RUL < 30)"
FEATURES = (
    "sensor_02",
    "sensor_04",
    "sensor_11",
    "s02_mean_10",
    "s02_std_10",
    "s02_delta",
    "s04_delta",
    "cycle_pct",
)
RUL_CAP = 125
# Rounding of (rolling mean, rolling deviation, delta) in each feature variant.
FEATURE_DIGITS = {"gold": (3, 4, 4), "model": (4, 5, 5), "mart": None}


def short_name(sensor: str) -> str:
    """``sensor_02`` -> ``s02``, the prefix of derived columns."""
    return sensor.replace("sensor_", "s")
