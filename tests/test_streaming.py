"""The stream ingest: restart, quarantine, log, and equality with batch."""

import json
import os

import pytest

from wearline import schema as S
from wearline.operators.validation import validate
from wearline.sources import layers
from wearline.streaming import ingest, stateful

QUICK = {"availableNow": True}


def line(engine, cycle, **changes):
    row = {f.name: 1.5 for f in S.READING_SCHEMA.fields}
    row |= {"engine_id": engine, "cycle": cycle, "dataset_id": "FD001"}
    row |= {"emitted_at": "2024-05-01T10:00:00.250000+00:00"}
    return json.dumps(row | changes)


class Feed:
    """A landing directory with its Bronze and quarantine outputs."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landing = self._make("landing")
        self.bronze, self.quarantine = self._make("bronze"), self._make("quarantine")

    def _make(self, name):
        path = f"{self.folder}/{name}"
        os.makedirs(path)
        return path

    def drop(self, name, *lines):
        """Write beside the landing directory, then move the complete file in."""
        with open(f"{self.folder}/{name}.part", "w") as out:
            out.write("\n".join(lines))
        os.rename(f"{self.folder}/{name}.part", f"{self.landing}/{name}")

    def run(self, **options):
        feed = ingest.read_stream(self.spark, self.landing, **options)
        query = ingest.start_bronze_stream(feed, self.bronze, f"{self.folder}/state", QUICK)
        assert query.awaitTermination(120)
        return query

    def run_quarantine(self):
        feed = ingest.read_stream(self.spark, self.landing)
        query = ingest.start_quarantine_stream(feed, self.quarantine, f"{self.folder}/state-q", QUICK)
        assert query.awaitTermination(120)

    def cycles(self):
        return sorted(r["cycle"] for r in layers.read_layer(self.spark, self.bronze).collect())


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder)


def test_restart_neither_repeats_nor_loses(feed):
    feed.drop("a.json", line(1, 1), line(1, 2))
    feed.run()
    assert feed.cycles() == [1, 2]
    feed.run()
    assert feed.cycles() == [1, 2]
    feed.drop("b.json", line(1, 3), "", line(1, 4))
    feed.run()
    assert feed.cycles() == [1, 2, 3, 4]


def test_lines_added_to_a_read_file_are_not_read(feed):
    feed.drop("a.json", line(1, 1))
    feed.run()
    with open(f"{feed.landing}/a.json", "a") as out:
        out.write("\n" + line(1, 2))
    feed.run()
    assert feed.cycles() == [1]


def test_half_written_line_goes_to_quarantine(feed):
    half = line(1, 3)[:40]
    feed.drop("a.json", line(1, 1), half, line(1, 2))
    feed.run()
    feed.run_quarantine()
    assert feed.cycles() == [1, 2]
    (row,) = layers.read_layer(feed.spark, feed.quarantine).collect()
    assert row["_corrupt_record"] == half and row["load_timestamp"] is not None


def test_missing_id_is_kept_and_flagged(feed):
    feed.drop("a.json", line(None, 1), line(2, 2))
    feed.run()
    bronze = layers.read_layer(feed.spark, feed.bronze)
    statuses = {r["cycle"]: r["status"] for r in validate(bronze).collect()}
    assert statuses == {1: "invalid_null", 2: "valid"}


def test_status_is_also_available_on_the_stream(feed):
    feed.drop("a.json", line(1, 1), line(1, 2, sensor_04=0.0), line(None, 3))
    stream = validate(ingest.good_lines(ingest.read_stream(feed.spark, feed.landing)))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{feed.folder}/state-v")
        .trigger(**QUICK)
        .start(f"{feed.folder}/checked")
    )
    assert query.awaitTermination(120)
    checked = layers.read_layer(feed.spark, f"{feed.folder}/checked").collect()
    assert {r["cycle"]: r["status"] for r in checked} == {
        1: "valid", 2: "invalid_sensor_range", 3: "invalid_null",
    }


def test_one_bad_value_does_not_lose_a_reading(feed):
    feed.drop(
        "a.json", line(1, 1), line(1, 2, sensor_21="worn"), line(1, 3.0), line(1, 4, emitted_at="soon"),
        line(1, 5)[:-7], line(1, 6.5),
    )
    query = feed.run()
    feed.run_quarantine()
    rows = {r["cycle"]: r for r in layers.read_layer(feed.spark, feed.bronze).collect()}
    assert len(rows) == 5 and rows[2]["sensor_21"] is None and rows[3]["sensor_04"] == 1.5 and rows[4]["emitted_at"] is None
    assert rows[None]["engine_id"] == 1  # a cycle that is no whole number is missing, not rounded
    assert layers.read_layer(feed.spark, feed.quarantine).count() == 1
    (batch,) = [b for b in ingest.ingest_log(query) if b["rows"]]
    assert (batch["rows"], batch["rows_with_misfits"], batch["broken_lines"]) == (5, 3, 1)


def test_load_log_has_every_batch(feed):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    feed.spark.conf.set(name, "2")
    try:
        for k in range(4):
            feed.drop(f"{k}.json", line(1, k), line(None, k))
        query = feed.run(max_files_per_trigger=1)
        assert len(ingest.ingest_log(query)) <= 2
    finally:
        feed.spark.conf.unset(name)
    log = ingest.load_log(layers.read_layer(feed.spark, feed.bronze)).collect()
    assert [(r["rows"], r["rows_without_id"]) for r in log] == [(2, 1)] * 4


def test_types_times_and_log(feed):
    feed.drop("a.json", line(1, 1, sensor_03=7), line(None, 2))
    feed.drop("b.json", line(1, 3))
    query = feed.run(max_files_per_trigger=1)
    log = ingest.ingest_log(query)
    assert sum(b["rows"] for b in log) == 3
    assert sum(b["rows_without_id"] for b in log) == 1
    bronze = layers.read_layer(feed.spark, feed.bronze)
    types = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    assert types["engine_id"] == types["cycle"] == "int"
    assert types["sensor_03"] == "double" and types["emitted_at"] == "timestamp"
    # One load time per micro-batch, and both batches ran.
    assert len({r["load_timestamp"] for r in bronze.collect()}) == len([b for b in log if b["rows"]])
    assert bronze.first()["emitted_at"].microsecond == 250_000


def test_polling_trigger_runs_until_stopped(feed):
    feed.drop("a.json", line(1, 1))
    stream = ingest.read_stream(feed.spark, feed.landing)
    query = ingest.start_bronze_stream(stream, feed.bronze, f"{feed.folder}/state")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert feed.cycles() == [1]


def test_filters_do_not_parse_a_line_again(spark, folder):
    """Status and key filters ask for many fields; each line is parsed by one expression all the same."""
    spark.createDataFrame([('{"engine_id": 1, "cycle": 2}',)], "value string").write.mode("append").text(folder)
    feed = ingest.good_lines(ingest.read_stream(spark, folder))
    for wanted in (feed.filter("engine_id IS NOT NULL AND cycle > 1"), stateful.silver_status(feed).filter("status = 'valid'")):
        query = wanted.writeStream.format("noop").option("checkpointLocation", f"{folder}-{id(wanted)}")
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        assert plan.count("from_json(") == 1
