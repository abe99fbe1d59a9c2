"""Stateful stream work: restarts, late and repeated readings, NaN, missing keys, and the one landing sink."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import anomaly
from wearline.operators.validation import valid_rows, validate
from wearline.sources import layers
from wearline.streaming import ingest, stateful

QUICK = {"availableNow": True}


def line(engine, cycle, minute=None, **changes):
    row = {f.name: 1.5 for f in S.READING_SCHEMA.fields}
    row |= {"engine_id": engine, "cycle": cycle, "dataset_id": "FD001"}
    if minute is not None:
        row["emitted_at"] = f"2024-05-01T{10 + minute // 60:02d}:{minute % 60:02d}:00Z"
    return json.dumps(row | changes)


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landing, self.out, self.state = (f"{folder}/{n}" for n in ("landing", "out", "state"))
        os.makedirs(self.landing)
        self.files = 0

    def drop(self, *lines):
        self.files += 1
        with open(f"{self.folder}/part", "w") as out:
            out.write("\n".join(lines))
        os.rename(f"{self.folder}/part", f"{self.landing}/{self.files}.json")

    def stream(self, **options):
        return ingest.read_stream(self.spark, self.landing, **options)

    def readings(self):
        return ingest.good_lines(self.stream())

    def rows(self):
        return layers.read_layer(self.spark, self.out).collect()


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder)


def run_scores(feed):
    valid = valid_rows(stateful.silver_status(feed.readings()))
    assert stateful.start_score_stream(valid, feed.out, feed.state, QUICK, window=4).awaitTermination(180)


def test_scores_go_on_after_a_restart(feed, spark):
    values = [3.0, 3.0, 3.0, 9.0, 1.0, 2.0, 7.0, 7.0, 7.0, 7.0, 0.5]
    lines = [line(e, c, sensor_02=v + e) for e in (1, 2) for c, v in enumerate(values, 1)]
    nameless = line(1, 1, dataset_id=None, sensor_02=5.0)
    feed.drop(*(x for x in lines if json.loads(x)["cycle"] <= 5), nameless, line(None, 3), line(1, 4, sensor_02=-1.0))
    run_scores(feed)
    feed.drop(*reversed([x for x in lines if json.loads(x)["cycle"] > 5]))  # out of order inside a batch
    run_scores(feed)
    found = {(r["dataset_id"], r["engine_id"], r["cycle"]): r for r in feed.rows()}
    assert len(found) == len(lines) + 1 and not any(r["late"] for r in found.values())
    for e in (1, 2):
        for c in range(1, len(values) + 1):
            frame = np.array(values[max(0, c - 4) : c]) + e
            row = found["FD001", e, c]
            assert row["s02_rolling_mean"] == pytest.approx(frame.mean(), abs=1e-12)
            if c == 1:
                assert row["s02_rolling_std"] is None and row["s02_zscore"] == 0.0
            else:
                assert row["s02_rolling_std"] == pytest.approx(frame.std(ddof=1), abs=1e-12)
    assert found["FD001", 1, 10]["s02_rolling_std"] == 0.0 and found["FD001", 1, 10]["s02_zscore"] == 0.0
    assert spark.conf.get(stateful.STORE, None) != stateful.ROCKSDB  # the session keeps its own setting


def test_late_and_equal_cycles(feed):
    feed.drop(line(1, 1, sensor_02=1.0), line(1, 5, sensor_02=5.0), line(1, 5, sensor_02=4.0))
    run_scores(feed)
    feed.drop(line(1, 3, sensor_02=9.0), line(1, 5, sensor_02=6.0), line(1, 6, sensor_02=7.0))
    run_scores(feed)
    rows = sorted((r["cycle"], r["sensor_02"], r["late"], r["s02_rolling_mean"]) for r in feed.rows())
    assert rows == [
        (1, 1.0, False, 1.0), (3, 9.0, True, 5.0), (5, 4.0, False, 2.5), (5, 5.0, False, pytest.approx(10 / 3)),
        (5, 6.0, False, 6.0), (6, 7.0, False, 5.5),
    ]


def test_rolling_moments_equal_the_batch_columns(spark):
    """NaN, flat windows and single readings, as Spark's own windows have them."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(30, 0.1), rng.normal(500, 1e-3, 50), [np.nan], rng.normal(size=40)])
    rows = [("d", 1, c, 10, *[float(v)] * 2, *[1.0] * 4) for c, v in enumerate(values.tolist())]
    names = "dataset_id string, engine_id int, cycle int, rul int, sensor_02 double, sensor_11 double"
    df = spark.createDataFrame(rows, names + ", op_setting_1 double, op_setting_2 double, sensor_04 double, max_cycle double")
    batch = anomaly.rolling_zscore(df.withColumn("max_cycle", F.lit(200))).orderBy("cycle").collect()
    mean, deviation = stateful.rolling_moments(values, 20)
    for k, row in enumerate(batch):
        if math.isnan(row["s02_rolling_mean"]):
            assert math.isnan(mean[k]) and math.isnan(deviation[k])
        else:
            assert row["s02_rolling_mean"] == pytest.approx(mean[k], rel=1e-12)
            assert row["s02_rolling_std"] == pytest.approx(deviation[k], rel=1e-9, abs=0) if k else math.isnan(deviation[k])


def run_once(feed, delay="10 minutes"):
    once = stateful.without_repeats(feed.readings(), delay)
    assert ingest.start_sink(once, feed.out, feed.state, QUICK).awaitTermination(180)


def test_repeats_inside_the_delay_go_and_nothing_undated_does(feed):
    feed.drop(line(1, 1, 0), line(1, 1, 0), line(1, 2, 1), line(1, 9), line(1, 9), line(None, 3, 1), line(None, 3, 1))
    run_once(feed)
    feed.drop(line(1, 2, 5, sensor_02=2.0), line(1, 3, 60), line(2, 2, 1))  # known; new; another engine
    run_once(feed)
    feed.drop(line(1, 4, 61), line(1, 5, 2), line(2, 5, 200))  # new; older than the watermark; new
    run_once(feed)
    feed.drop(line(1, 3, 210), line(2, 5, 205))  # the first was forgotten, the second not
    run_once(feed)
    found = sorted((str(r["engine_id"]), r["cycle"]) for r in feed.rows())
    assert found == [
        ("1", 1), ("1", 2), ("1", 3), ("1", 3), ("1", 4), ("1", 9), ("1", 9), ("2", 2), ("2", 5), ("None", 3), ("None", 3),
    ]


def test_one_sink_keeps_broken_lines_and_logs_every_batch(feed, spark):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(name, "2")
    try:
        for k in range(4):
            feed.drop(line(1, k), line(None, k, sensor_05="worn"), line(1, k)[: 30 + k])
        query = ingest.start_landing_stream(feed.stream(max_files_per_trigger=1), feed.out, feed.state, QUICK)
        assert query.awaitTermination(180) and len(query.recentProgress) <= 2
    finally:
        spark.conf.unset(name)
    landed = ingest.read_landed(spark, feed.out)
    log = ingest.landing_log(landed).orderBy("load_timestamp").collect()
    assert [tuple(r)[1:] for r in log] == [(2, 1, 1, 1)] * 4
    assert sorted(len(r["_corrupt_record"]) for r in ingest.broken_of(landed).collect()) == [30, 31, 32, 33]
    bronze = ingest.readings_of(landed)
    assert bronze.columns == [*S.STREAM_SCHEMA.names, "load_timestamp"] and bronze.count() == 8


def test_second_hop_goes_on_where_it_was(feed, spark, folder):
    silver, state = f"{folder}/silver", f"{folder}/silver-state"

    def run():
        ingest.start_landing_stream(feed.stream(), feed.out, feed.state, QUICK).awaitTermination(180)
        bronze = ingest.readings_of(ingest.stream_landed(spark, feed.out, max_files_per_trigger=1))
        checked = stateful.silver_status(bronze)
        assert ingest.start_sink(checked, silver, state, QUICK, by="dataset_id").awaitTermination(180)
        return layers.read_layer(spark, silver)

    feed.drop(line(1, 1), line(1, 2, sensor_04=0.0), "{broken", line(None, 3))
    assert run().count() == 3
    feed.drop(line(1, 4, dataset_id="FD002"))
    found = run()
    batch = validate(ingest.readings_of(ingest.read_landed(spark, feed.out)))
    shown = [sorted((r["cycle"], r["status"]) for r in df.select("cycle", "status").collect()) for df in (found, batch)]
    assert shown[0] == shown[1] == [(1, "valid"), (2, "invalid_sensor_range"), (3, "invalid_null"), (4, "valid")]
