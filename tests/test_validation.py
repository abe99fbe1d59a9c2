"""Row status, lifetime columns and label expressions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators import lifetime, validation
from wearline.plans.medallion import build_silver

NAN = float("nan")


def status(df, rules="full", **options):
    return [r["status"] for r in validation.validate(df, rules, **options).collect()]


@pytest.mark.parametrize(
    "row, full, nulls_only, staging",
    [
        ({}, "valid", "valid", "valid"),
        ({"engine_id": None}, "invalid_null", "invalid_null", "invalid_null"),
        ({"cycle": None}, "invalid_null", "invalid_null", "invalid_null"),
        # A missing value wins over a range error under the full rules only.
        ({"sensor_02": None, "sensor_04": 0.0}, "invalid_null", "invalid_null", "invalid_sensor_range"),
        # NULL <= 0 is unknown: a missing sensor passes the staging rules.
        ({"sensor_02": None, "sensor_04": 5.0}, "invalid_null", "invalid_null", "valid"),
        ({"sensor_07": -1.0}, "invalid_sensor_range", "valid", "valid"),
        ({"sensor_04": 0.0}, "invalid_sensor_range", "valid", "invalid_sensor_range"),
        ({"sensor_05": None}, "valid", "valid", "valid"),
    ],
)
def test_presets(make_readings, row, full, nulls_only, staging):
    df = make_readings([row])
    assert status(df) == [full]
    assert status(df, "nulls_only") == [nulls_only]
    assert status(df, "staging") == [staging]


def test_nan_is_valid_unless_rejected(make_readings):
    df = make_readings([{"sensor_02": NAN}])
    assert status(df) == ["valid"]
    assert status(df, reject_nan=True) == ["invalid_null"]


def test_every_row_keeps_one_status(make_readings):
    df = make_readings([{}, {"sensor_02": None}, {"sensor_02": -1.0}, {"engine_id": None}])
    counts = validation.rows_by(validation.validate(df), "status").collect()
    assert {r["status"] for r in counts} <= set(S.STATUSES)
    assert sum(r["row_count"] for r in counts) == 4


def test_last_cycle_counts_invalid_rows(series, rows_of):
    df = series([1.0, 2.0, None])
    silver = build_silver(df)
    assert rows_of(silver, "cycle", "max_cycle", "cycle_pct", "rul", "status") == [
        (1, 3, 0.333, 2, "valid"),
        (2, 3, 0.667, 1, "valid"),
        (3, 3, 1.0, 0, "invalid_null"),
    ]


def test_same_engine_id_in_two_datasets(make_readings, rows_of):
    df = make_readings(
        [{"dataset_id": "FD001", "cycle": 5}, {"dataset_id": "FD002", "cycle": 9}]
    )
    derived = lifetime.add_lifetime(df)
    assert rows_of(derived, "dataset_id", "max_cycle") == [("FD001", 5), ("FD002", 9)]


def test_readings_without_engine_stay(make_readings, rows_of):
    df = make_readings([{"engine_id": None, "cycle": 3}, {"engine_id": None, "cycle": 8}])
    derived = lifetime.add_lifetime(df)
    assert rows_of(derived, "cycle", "max_cycle") == [(3, 8), (8, 8)]


def test_zero_last_cycle_has_no_fraction(make_readings):
    row = build_silver(make_readings([{"cycle": 0}])).first()
    assert row["cycle_pct"] is None and row["rul"] == 0


@pytest.mark.parametrize(
    "expression, pairs",
    [
        (X.life_category, [(130, S.SHORT_LIFE), (131, S.MEDIUM_LIFE), (200, S.MEDIUM_LIFE), (201, S.LONG_LIFE)]),
        (X.life_stage, [(100, S.MID_STAGE), (101, S.EARLY_STAGE), (30, S.LATE_STAGE), (31, S.MID_STAGE)]),
        (lambda c: X.capped(c, 125), [(124, 124), (125, 125), (126, 125), (None, None)]),
        (lambda c: X.capped(c, None), [(126, 126)]),
    ],
)
def test_edges(spark, expression, pairs):
    df = spark.createDataFrame([(v,) for v, _ in pairs], "v int")
    assert [r[0] for r in df.select(expression(F.col("v"))).collect()] == [e for _, e in pairs]


def test_operating_condition_has_no_signed_zero(make_readings):
    df = make_readings(
        [
            {"op_setting_1": -0.0007, "op_setting_2": 0.0},
            {"op_setting_1": 0.0007, "op_setting_2": -0.001},
            {"op_setting_1": 42.0049, "op_setting_2": 0.8449},
        ]
    )
    labels = [r[0] for r in df.select(X.operating_condition()).collect()]
    assert labels == ["0.00_0.00", "0.00_0.00", "42.00_0.84"]


def test_engine_count_uses_both_keys(make_readings):
    df = make_readings(
        [{"dataset_id": d, "engine_id": e} for d in ("FD001", "FD002") for e in (1, 2)]
    )
    assert validation.engine_count(df).first()["engines"] == 4
