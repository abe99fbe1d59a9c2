"""Gold tables on hand-written series."""

import math

import pytest
from pyspark.sql import functions as F

from wearline.operators import gold
from wearline.plans.medallion import build_silver
from wearline.operators.validation import valid_rows


def close(row, expected):
    assert all(
        (a is None and b is None) or a == pytest.approx(b) for a, b in zip(row, expected)
    ), (row, expected)


def test_partial_frames_at_the_start(series, silver):
    df = gold.rolling_averages(silver(series([1.0, 2.0, 6.0])), digits=None).orderBy("cycle")
    means = [r["sensor_02_avg_10"] for r in df.collect()]
    assert means == [1.0, 1.5, 3.0]


def test_frames_hold_their_number_of_readings(series, silver):
    df = gold.rolling_averages(silver(series([float(i) for i in range(1, 41)])))
    last = df.orderBy(F.desc("cycle")).first()
    assert last["sensor_02_avg_10"] == 35.5
    assert last["sensor_02_avg_30"] == 25.5
    assert df.columns == [
        "dataset_id", "engine_id", "cycle", "sensor_02", "sensor_04", "sensor_11",
        "sensor_02_avg_10", "sensor_02_avg_30", "sensor_04_avg_10",
    ]


def test_rounding_is_half_up(series, silver):
    df = gold.rolling_averages(silver(series([1.0, 1.001])), digits=3).orderBy("cycle")
    assert [r["sensor_02_avg_10"] for r in df.collect()] == [1.0, 1.001]


def test_features_of_first_and_second_reading(series, silver):
    first, second, third = gold.ml_features(silver(series([3.0, 5.0, 4.0]))).orderBy("cycle").collect()
    close((first["s02_mean_10"], first["s02_std_10"], first["s02_delta"]), (3.0, None, None))
    close((second["s02_mean_10"], second["s02_std_10"], second["s02_delta"]), (4.0, math.sqrt(2), 2.0))
    close((third["s02_mean_10"], third["s02_std_10"], third["s02_delta"]), (4.0, 1.0, -1.0))
    assert [r["rul"] for r in (first, second, third)] == [2, 1, 0]


def test_delta_skips_invalid_readings(series, silver):
    rows = gold.ml_features(silver(series([3.0, None, 4.0]))).orderBy("cycle").collect()
    assert [(r["cycle"], r["s02_delta"]) for r in rows] == [(1, None), (3, 1.0)]


def test_feature_rounding_and_cap(series, silver):
    rows = silver(series([1.0 + i / 7 for i in range(130)]))
    table = gold.ml_features(rows, digits=(3, 4, 4), rul_cap=125)
    row = table.filter("cycle = 2").first()
    assert (row["s02_mean_10"], row["s02_std_10"], row["s02_delta"]) == (1.071, 0.101, 0.1429)
    assert row["rul"] == 125
    assert table.agg(F.max("rul")).first()[0] == 125
    assert gold.ml_features(rows).agg(F.max("rul")).first()[0] == 129


def test_health_counts_valid_cycles_only(series, silver):
    df = gold.engine_health(silver(series([2.0, 4.0, None]))).first()
    assert df["total_cycles"] == 2 and df["avg_sensor_02"] == 3.0
    assert df["stddev_sensor_02"] == 1.414
    assert df["life_category"] == "short_life"


def test_datasets_do_not_share_frames(make_readings, silver):
    """The result on a union equals the union of the results."""
    parts = {
        d: make_readings(
            {"dataset_id": d, "cycle": c, "sensor_02": base + c} for c in range(1, 35)
        )
        for d, base in (("FD001", 10.0), ("FD002", 900.0))
    }
    both = parts["FD001"].unionByName(parts["FD002"])
    for make in (gold.rolling_averages, gold.ml_features, gold.engine_health, gold.sensor_drift):
        joint = set(make(silver(both)).collect())
        assert joint == {r for p in parts.values() for r in make(silver(p)).collect()}


def test_drift_windows_overlap_in_short_lives(series, silver):
    """40 cycles: early is 1..30, late is 10..40 (31 cycles)."""
    df = silver(series([float(i) for i in range(1, 41)]))
    assert gold.early_means(df).first()["s02_early"] == 15.5
    assert gold.late_means(df).first()["s02_late"] == 25.0
    assert gold.sensor_drift(df).first()["s02_drift"] == 9.5


def test_drift_needs_both_periods(make_readings, silver, rows_of):
    rows = [{"engine_id": 1, "cycle": c} for c in range(50, 90)]
    rows += [{"engine_id": 2, "cycle": c, "sensor_02": 1.0 + c} for c in range(1, 71)]
    df = silver(make_readings(rows))
    one, joined = gold.sensor_drift(df), gold.sensor_drift_join(df)
    assert rows_of(one, "engine_id") == rows_of(joined, "engine_id") == [(2,)]
    assert one.collect() == joined.select(*one.columns).collect()


def test_top_drift_breaks_ties_by_key(spark):
    df = spark.createDataFrame(
        [("FD002", 1, -2.0), ("FD001", 2, 2.0), ("FD001", 1, 1.0)],
        "dataset_id string, engine_id int, s02_drift double",
    )
    assert [(r[0], r[1]) for r in gold.top_drift(df, n=2).collect()] == [("FD001", 2), ("FD002", 1)]


def test_engine_trace(series, silver):
    rows = gold.engine_trace(silver(series([5.0] * 8)), "FD001", 1, ["cycle", "rul"], 5).collect()
    assert [(r["cycle"], r["rul"]) for r in rows] == [(1, 7), (2, 6), (3, 5), (4, 4), (5, 3)]


def test_staging_rules_feed_the_marts(series):
    """A missing sensor is valid under the staging rules and is skipped by the means."""
    staged = valid_rows(build_silver(series([2.0, None, 4.0]), rules="staging"))
    assert gold.engine_health(staged).first()["avg_sensor_02"] == 3.0
