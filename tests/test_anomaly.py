"""Rolling z-scores and summaries."""

import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wearline.operators import anomaly, quality


def scored(series, silver, values, **options):
    return anomaly.rolling_zscore(silver(series(values)), **options).orderBy("cycle").collect()


def test_single_reading(series, silver):
    (row,) = scored(series, silver, [5.0])
    assert row["s02_rolling_std"] is None
    assert row["s02_zscore"] == 0.0 and row["s02_anomaly"] is False


def test_constant_sensor(series, silver):
    rows = scored(series, silver, [5.0] * 25)
    assert {r["s02_rolling_std"] for r in rows[1:]} == {0.0}
    assert {r["s02_zscore"] for r in rows} == {0.0}
    assert not any(r["s02_anomaly"] for r in rows)


@pytest.mark.parametrize("place, z, flagged", [(5, 1.789, False), (6, 2.041, True)])
def test_jump(series, silver, place, z, flagged):
    row = scored(series, silver, [5.0] * (place - 1) + [9.0])[-1]
    assert row["s02_zscore"] == pytest.approx(z, abs=1e-3)
    assert row["s02_anomaly"] is flagged


def test_score_is_bounded_by_the_frame(series, silver):
    rng = random.Random(1)
    values = [math.exp(rng.gauss(0, 2)) for _ in range(200)]
    for row in scored(series, silver, values):
        n = min(row["cycle"], 20)
        assert abs(row["s02_zscore"]) <= (n - 1) / math.sqrt(n) + 1e-9
        assert not (row["s02_anomaly"] and row["cycle"] <= 5)


def test_threshold_and_window_are_parameters(series, silver):
    rows = scored(series, silver, [5.0] * 4 + [9.0], threshold=1.5, window=5)
    assert rows[-1]["s02_anomaly"] is True


def test_nan_is_flagged(series, silver):
    """NaN passes validation by default and compares above every threshold."""
    rows = scored(series, silver, [1.0, 2.0, float("nan")])
    assert rows[-1]["s02_anomaly"] is True


def test_table_columns(series, silver):
    df = anomaly.rolling_zscore(silver(series([1.0, 2.0])))
    assert df.columns == [
        "dataset_id", "engine_id", "cycle", "rul",
        "sensor_02", "s02_rolling_mean", "s02_rolling_std", "s02_zscore", "s02_anomaly",
        "sensor_11", "s11_rolling_mean", "s11_rolling_std", "s11_zscore", "s11_anomaly",
    ]


@pytest.fixture
def flags(spark):
    rows = [("FD001", 1, rul, rul % 3 == 0, rul == 40) for rul in (120, 60, 40, 20, 10, 9)]
    rows += [("FD002", 1, 120, False, False)]
    return spark.createDataFrame(
        rows, "dataset_id string, engine_id int, rul int, s02_anomaly boolean, s11_anomaly boolean"
    )


def test_summaries(flags):
    summary = anomaly.anomaly_summary(flags).orderBy("dataset_id").collect()
    assert [tuple(r) for r in summary] == [("FD001", 1, 6, 3, 1, 50.0), ("FD002", 1, 1, 0, 0, 0.0)]
    assert anomaly.anomaly_rate(flags).first() == Row(
        anomalies=3, total_readings=7, anomaly_rate_pct=42.9
    )
    stages = {r["life_stage"]: tuple(r)[1:] for r in anomaly.anomaly_by_life_stage(flags).collect()}
    assert stages == {
        "early (RUL > 100)": (2, 1, 50.0),
        "mid (RUL 30-100)": (2, 1, 50.0),
        "late (RUL < 30)": (3, 1, 33.33),
    }
    assert anomaly.anomaly_points(flags).count() == 3


def test_top_engines_break_ties_by_key(flags):
    one = flags.filter("dataset_id = 'FD001'")
    doubled = one.unionByName(one.withColumn("dataset_id", F.lit("FD000")))
    top = anomaly.top_anomalous_engines(anomaly.anomaly_summary(doubled), 2).collect()
    assert [r["dataset_id"] for r in top] == ["FD000", "FD001"]


def test_late_stage_report(flags):
    report = quality.late_stage_is_highest(anomaly.anomaly_by_life_stage(flags)).first()
    assert (report["late_rate_pct"], report["late_is_highest"]) == (33.33, False)
