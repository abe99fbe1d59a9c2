"""Text files, layer tables, unions and the event adapter."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.sources import events, layers, text

FIELDS = ["3", "7", "0.1", "0.2", "100", *(str(float(i)) for i in range(1, 22))]


def write(folder, name, *lines):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


def values(row):
    return [row[f.name] for f in S.READING_SCHEMA.fields]


WHOLE = [3, 7, 0.1, 0.2, 100.0, *(float(i) for i in range(1, 22))]


@pytest.mark.parametrize(
    "line",
    [
        " ".join(FIELDS),
        " ".join(FIELDS) + "  ",
        "  " + "  ".join(FIELDS),
        "\t".join(FIELDS) + "\t",
        " ".join(FIELDS) + " 99 extra",
    ],
)
def test_separators(spark, folder, line):
    path = write(folder, "train_FD003.txt", line)
    for mode in ("permissive", "skip"):
        row = text.read_readings(spark, path, mode=mode).first()
        assert values(row) == WHOLE and row["dataset_id"] == "FD003"


def test_short_line_is_padded(spark, folder):
    path = write(folder, "train_FD001.txt", " ".join(FIELDS[:20]))
    row = text.read_readings(spark, path, mode="skip").first()
    assert values(row) == WHOLE[:20] + [None] * 6


def test_broken_fields(spark, folder):
    lines = [" ".join(["x", *FIELDS[1:]]), " ".join([*FIELDS[:6], "?", *FIELDS[7:]]), "", "   "]
    path = write(folder, "train_FD001.txt", *lines, " ".join(FIELDS))
    rows = text.read_readings(spark, path).collect()
    assert len(rows) == 3
    assert [r["engine_id"] for r in rows] == [None, 3, 3]
    assert [r["sensor_02"] for r in rows] == [2.0, None, 2.0]
    assert [values(r) for r in text.read_readings(spark, path, mode="skip").collect()] == [WHOLE]
    with pytest.raises(ValueError):
        text.read_readings(spark, path, mode="strict")


def test_ids_from_file_names_and_literal_tag(spark, folder):
    for name in ("train_FD001.txt", "train_FD002.txt", "notes.txt"):
        write(folder, name, " ".join(FIELDS))
    named = text.read_readings(spark, f"{folder}/train_FD*.txt")
    assert sorted(r["dataset_id"] for r in named.collect()) == ["FD001", "FD002"]
    tagged = text.read_readings(spark, f"{folder}/notes.txt", dataset_id="lab")
    assert tagged.first()["dataset_id"] == "lab"
    assert tagged.columns == [*(f.name for f in S.READING_SCHEMA.fields), "dataset_id"]


def test_only_needed_fields_are_parsed(spark, folder):
    path = write(folder, "train_FD001.txt", " ".join(FIELDS))
    plan = text.read_readings(spark, path).select("cycle", "sensor_02")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("try_cast") <= 2


def test_bronze_appends_and_rebuilds(spark, folder, make_readings):
    path = f"{folder}/bronze"
    load = text.with_load_time(make_readings([{"cycle": c} for c in (1, 2)]))
    layers.append_bronze(load, path)
    layers.append_bronze(load, path)
    bronze = layers.read_layer(spark, path, S.BRONZE_SCHEMA)
    assert bronze.count() == 4
    assert os.path.isdir(f"{path}/dataset_id=FD001")
    layers.append_bronze(load, path, mode="overwrite")
    assert layers.read_layer(spark, path, S.BRONZE_SCHEMA).count() == 2


def test_numeric_dataset_ids_stay_text(spark, folder, make_readings):
    path = f"{folder}/bronze"
    layers.append_bronze(text.with_load_time(make_readings([{"dataset_id": "007"}])), path)
    assert layers.read_layer(spark, path, S.BRONZE_SCHEMA).first()["dataset_id"] == "007"


def test_union_by_name_with_stream_bronze(spark, make_readings):
    batch = text.with_load_time(make_readings([{}]))
    stream = batch.select(
        "load_timestamp", "dataset_id", *(f.name for f in S.READING_SCHEMA.fields)
    ).withColumns(
        {
            "emitted_at": F.lit("2024-05-01T10:00:00+00:00"),
            "engine_id": F.lit(9).cast("long"),
        }
    )
    both = layers.union_bronze(batch, stream)
    assert both.schema["emitted_at"].dataType.typeName() == "timestamp"
    assert both.schema["engine_id"].dataType.typeName() == "integer"
    rows = {r["engine_id"]: r["emitted_at"] for r in both.collect()}
    assert rows[1] is None and rows[9].hour == 10


def test_stream_values_of_another_type_become_null(make_readings):
    batch = text.with_load_time(make_readings([{}]))
    stream = batch.withColumn("engine_id", F.lit("x"))
    rows = layers.union_bronze(batch, stream).select("engine_id").collect()
    assert sorted(str(r["engine_id"]) for r in rows) == ["1", "None"]


def test_numbering_equals_one_window(spark):
    df = spark.range(400).select(
        F.lit("FD001").alias("dataset_id"),
        F.expr("cast(if(id % 3 = 0, 1, id % 7) as int)").alias("engine_id"),
        F.expr("timestamp_seconds(id * 7919 % 100000)").alias("ts"),
        F.col("id").alias("event_id"),
    )
    whole = F.row_number().over(Window.partitionBy(*S.KEY).orderBy("ts", "event_id"))
    expected = set(df.withColumn("cycle", whole).select("event_id", "cycle").collect())
    periods = {1000: (None,), 160: ("day",), 30: ("hour",), 1: ("minute", "second")}
    for limit, period in periods.items():
        assert events.finest_period(df, "ts", limit) in period
        numbered = events.number_readings(df, limit=limit)
        assert set(numbered.select("event_id", "cycle").collect()) == expected
