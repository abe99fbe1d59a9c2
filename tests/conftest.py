import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from wearline import schema as S  # noqa: E402
from wearline.workspace import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("local[8]", "wearline-tests")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def folder():
    """A fresh folder path per test."""
    return tempfile.mkdtemp(prefix="wearline-test-")


DEFAULTS = {
    "dataset_id": "FD001",
    "engine_id": 1,
    "cycle": 1,
    **{name: 0.5 for name in S.SETTINGS},
    **{name: 100.0 for name in S.SENSORS},
}


@pytest.fixture
def make_readings(spark):
    """Readings from dictionaries; fields not given have a valid default."""
    schema = "dataset_id string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in S.READING_SCHEMA.fields
    )

    def build(rows):
        return spark.createDataFrame([{**DEFAULTS, **row} for row in rows], schema)

    return build


@pytest.fixture
def series(make_readings):
    """Readings of one engine from a list of sensor_02 values, at cycles 1, 2, ..."""

    def build(values, **fixed):
        return make_readings(
            {"cycle": i, "sensor_02": v, **fixed} for i, v in enumerate(values, start=1)
        )

    return build


@pytest.fixture
def silver():
    """Turn readings into valid Silver rows."""
    from wearline.operators.validation import valid_rows
    from wearline.plans.medallion import build_silver

    return lambda readings, **options: valid_rows(build_silver(readings, **options))


@pytest.fixture
def rows_of():
    """Rows as sorted tuples of the named columns."""

    def collect(df, *columns):
        return sorted(
            (tuple(r) for r in df.select(*(F.col(c) for c in columns)).collect()), key=str
        )

    return collect
