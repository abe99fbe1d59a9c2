"""Growing warehouse: repeated and broken-off loads, untouched files, and tables from merged moments."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import gold, moments, scaling, split
from wearline.plans.loads import Warehouse, load_identities
from wearline.plans.medallion import build_silver


@pytest.fixture
def rows(make_readings):
    """Two datasets with several engines; values change from cycle to cycle, some readings are not valid."""

    def build(cycles, dataset="FD001", engines=(1, 2, 3)):
        return [
            {
                "dataset_id": dataset, "engine_id": e, "cycle": c, "op_setting_1": float(c % 2),
                "sensor_02": 500.0 + (c * 7 % 13) + e, "sensor_04": 40.0 + c / 8,
                "sensor_11": 0.1 if c % 9 else None,
            }
            for e in engines for c in cycles
        ]

    return lambda *parts: make_readings([r for p in parts for r in build(**p)])


def files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def content(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


READING = [*S.READING_SCHEMA.names, "dataset_id"]
SILVER = [*S.KEY, "cycle", "status", "max_cycle", "cycle_pct", "rul"]


def test_identity_is_of_the_content(rows):
    load = rows({"cycles": range(1, 9)}, {"cycles": range(3), "dataset": None})
    first = {r["dataset_id"]: (r["load"], r["rows"]) for r in load_identities(load).collect()}
    again = {r["dataset_id"]: (r["load"], r["rows"]) for r in load_identities(load.repartition(5, "cycle")).collect()}
    assert first == again and set(first) == {"FD001", None} and first["FD001"][1] == 24
    moved = load.withColumns({"sensor_05": F.lit(None).cast("double"), "sensor_06": F.col("sensor_05")})
    assert {r["load"] for r in load_identities(moved).collect()}.isdisjoint(x for x, _ in first.values())
    assert load_identities(load.union(load)).filter("dataset_id = 'FD001'").first()["load"] != first["FD001"][0]


def test_repeats_and_untouched_files(spark, folder, rows):
    house = Warehouse(spark, folder)
    first = rows({"cycles": range(1, 40)}, {"cycles": range(1, 30), "dataset": "FD002"}, {"cycles": range(1, 4), "dataset": None})
    assert house.load(first).count() == 3
    before = files(folder)
    assert house.load(first).isEmpty() and files(folder) == before
    second = rows({"cycles": range(40, 75), "engines": (2, 4)})
    # A known dataset beside a new one: only the new one is taken in.
    assert house.load(second.union(rows({"cycles": range(1, 30), "dataset": "FD002"}))).count() == 1
    after = files(folder)
    kept = [p for p in before if "dataset_id=FD001" not in p]
    assert kept and all(after[p] == before[p] for p in kept)
    assert {p for p in after if p not in before and "dataset_id=" in p and "dataset_id=FD001" not in p} == set()
    everything = first.union(second)
    assert content(house.bronze, READING) == content(everything, READING)
    assert content(house.silver, SILVER) == content(build_silver(everything), SILVER)


def same(found, wanted, key):
    found, wanted = ({tuple(r[k] for k in key): r.asDict() for r in df.collect()} for df in (found, wanted))
    assert set(found) == set(wanted) and found
    for place, row in wanted.items():
        for name, value in row.items():
            other = found[place][name]
            if isinstance(value, float) and not math.isnan(value):
                assert other == pytest.approx(value, rel=1e-9, abs=1e-9), (place, name)
            else:
                assert str(other) == str(value), (place, name)


def test_tables_from_moments_equal_a_rebuild(spark, folder, rows, silver):
    """Lives that go on, begin and are left alone; late cycles move; a load brings cycles out of order."""
    loads = [
        rows({"cycles": range(1, 50)}, {"cycles": range(1, 45), "dataset": "FD002", "engines": range(1, 8)}),
        rows({"cycles": range(50, 90), "engines": (1, 5)}, {"cycles": [200], "dataset": "FD002", "engines": (3,)}),
        rows({"cycles": range(60, 70), "dataset": "FD002", "engines": (3, 9)}, {"cycles": [1], "dataset": "FD003"}),
    ]
    house, everything = Warehouse(spark, folder), None
    for load in loads:
        house.load(load)
        everything = load if everything is None else everything.union(load)
        valid = silver(everything)
        same(house.engine_health(digits=(9, 9)), gold.engine_health(valid, digits=(9, 9)), S.KEY)
        same(house.sensor_drift(digits=9), gold.sensor_drift(valid, digits=9), S.KEY)
        features = scaling.with_op_condition(scaling.complete_rows(gold.ml_features(valid)))
        train = split.mark_split(features, split.split_cuts(valid)).filter("is_train")
        wanted = scaling.scaler_rows(scaling.fit_scaler(train))
        same(scaling.scaler_rows(house.scaler()), wanted, (*scaling.BY_CONDITION, "feature"))


def test_a_broken_off_load_is_given_again(spark, folder, rows, monkeypatch):
    house, load = Warehouse(spark, folder), rows({"cycles": range(1, 40)})
    monkeypatch.setattr(Warehouse, "_keep_conditions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        house.load(load)
    monkeypatch.undo()
    assert house.manifest.isEmpty()
    assert house.load(load).count() == 1 and house.load(load).isEmpty()
    assert content(house.bronze, READING) == content(load, READING)
    assert house.engine_health().count() == 3 and not house.scaler().isEmpty()


def test_nothing_to_load(spark, folder, rows):
    house = Warehouse(spark, folder)
    assert house.load(rows({"cycles": []})).isEmpty() and house.bronze.isEmpty()
    assert house.engine_health().isEmpty() and house.sensor_drift().isEmpty()


def test_merge_is_exact_for_constants_and_nan(spark):
    rows = [("a", k % 4, 0.1, float(k)) for k in range(99)] + [("b", 0, float("nan"), None), ("b", 1, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, part int, x double, y double")
    merged = moments.merge(moments.moments(df, ("g", "part"), ("x", "y")), ("g",), ("x", "y"))
    found = {r["g"]: r for r in merged.select("g", moments.mean("x").alias("mx"), moments.deviation("x").alias("dx"), moments.mean("y").alias("my"), moments.deviation("y", sample=True).alias("dy")).collect()}
    assert (found["a"]["mx"], found["a"]["dx"], found["a"]["my"]) == (0.1, 0.0, 49.0)
    assert found["a"]["dy"] == pytest.approx(28.72281323269014, rel=1e-14)
    assert math.isnan(found["b"]["mx"]) and found["b"]["my"] is None and found["b"]["dy"] is None
