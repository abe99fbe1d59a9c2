"""Engine split, scalers and metrics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wearline.operators import model, scaling, split

F1 = ("f",)


def engines(spark, ids, dataset="FD001"):
    return spark.createDataFrame(
        [(dataset, i) for i in ids], "dataset_id string, engine_id int"
    )


@pytest.mark.parametrize("count, train", [(249, 199), (260, 208), (100, 80), (1, 0), (4, 3)])
def test_split_sizes(spark, count, train):
    df = split.engine_split(engines(spark, range(1, count + 1)))
    assert df.filter("is_train").count() == train and df.count() == count


def test_split_follows_id_order_over_the_whole_int_range(spark):
    rng = random.Random(2)
    ids = sorted(rng.sample(range(-(2**31), 2**31), 300) + [-1, 0, 65_535, 65_536])
    df = split.engine_split(engines(spark, ids * 2))
    marked = {r["engine_id"]: r["is_train"] for r in df.collect()}
    cut = int(len(ids) * 0.8)
    assert marked == {e: place < cut for place, e in enumerate(ids)}


def test_split_is_per_dataset(spark):
    both = engines(spark, range(1, 11)).unionByName(engines(spark, range(101, 106), "FD002"))
    train = split.engine_split(both).filter("is_train")
    assert {(r[0], r[1]) for r in train.collect()} == {("FD001", i) for i in range(1, 9)} | {
        ("FD002", i) for i in range(101, 105)
    }


def test_fixed_split_keeps_every_engine(spark):
    both = engines(spark, [1, 80, 81, 100, 101]).unionByName(engines(spark, [1, 90], "FD002"))
    rows = split.engine_split_fixed(both, dataset_id="FD001").collect()
    assert sorted((r["dataset_id"], r["engine_id"], r["part"]) for r in rows) == [
        ("FD001", 1, "train"), ("FD001", 80, "train"), ("FD001", 81, "test"), ("FD001", 100, "test"),
        ("FD001", 101, "neither"), ("FD002", 1, "neither"), ("FD002", 90, "neither"),
    ]


def test_missing_settings_are_conditions_of_their_own(spark):
    values = [(None, 0.1), (0.1, None), (float("nan"), 0.1), (None, None), (-0.001, 0.001)]
    df = spark.createDataFrame(values, "op_setting_1 double, op_setting_2 double")
    labels = [r["op_cond"] for r in scaling.with_op_condition(df).collect()]
    assert labels == ["null_0.10", "0.10_null", "nan_0.10", "null_null", "0.00_0.00"]


def test_rows_of_listed_engines(spark):
    """Membership by list gives what the marked split gives."""
    df = engines(spark, [1, 1, 2, 3, 4, 5]).unionByName(engines(spark, [1, 9], "FD002"))
    train = split.engine_split(df).filter("is_train")
    marked = split.mark_split(df, split.split_cuts(df)).filter("is_train")
    listed = split.rows_of(df, train)
    assert sorted(map(tuple, listed.collect())) == sorted(
        (r["dataset_id"], r["engine_id"]) for r in marked.collect()
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, "dataset_id string, op_cond string, f double")


def test_scaler_uses_population_deviation(spark):
    train = frame(spark, [("FD001", "a", 1.0), ("FD001", "a", 3.0), ("FD001", "b", 7.0)])
    rows = scaling.scaler_rows(scaling.fit_scaler(train, F1), F1).orderBy("op_cond").collect()
    assert [tuple(r) for r in rows] == [
        ("FD001", "a", "f", 2.0, 1.0),
        ("FD001", "b", "f", 7.0, 1.0),  # no spread: scale 1
    ]


def test_fallback_counts_each_condition_once(spark):
    train = frame(spark, [("FD001", "a", 0.0)] * 9 + [("FD001", "b", 8.0), ("FD001", "b", 12.0)])
    scaler = scaling.fit_scaler(train, F1)
    fallback = scaling.fit_fallback(scaler, F1)
    assert tuple(fallback.first()) == ("FD001", 5.0, 1.5)
    test = frame(spark, [("FD001", "new", 8.0), ("FD001", "b", 14.0), ("FD002", "a", 1.0)])
    scaled = scaling.apply_scaler(test, scaler, F1, fallback=fallback)
    values = {(r["dataset_id"], r["op_cond"]): r["f"] for r in scaled.collect()}
    assert values["FD001", "new"] == pytest.approx(3.0 / (1.5 + 1e-8))
    assert values["FD001", "b"] == 2.0
    assert values["FD002", "a"] is None
    unseen = scaling.unseen_conditions(test, scaler).collect()
    assert {tuple(r) for r in unseen} == {("FD001", "new"), ("FD002", "a")}
    assert scaling.condition_count(train).first()["conditions"] == 2


def test_one_condition_equals_the_global_scaler(spark):
    rng = random.Random(4)
    train = frame(spark, [("FD001", "a", rng.random()) for _ in range(50)])
    per_condition = scaling.apply_scaler(train, scaling.fit_scaler(train, F1), F1)
    scaler = scaling.fit_scaler(train, F1, by=scaling.BY_DATASET)
    globally = scaling.apply_scaler(train, scaler, F1, by=scaling.BY_DATASET)
    a, b = ([r["f"] for r in d.orderBy("f").collect()] for d in (per_condition, globally))
    assert a == pytest.approx(b)


def test_complete_rows_drop_null_and_nan(spark):
    df = frame(spark, [("FD001", "a", None), ("FD001", "a", float("nan")), ("FD001", "a", 1.0)])
    assert scaling.complete_rows(df, F1).count() == 1


def test_metrics(spark):
    df = spark.createDataFrame(
        [("FD001", 1.0, 4.0), ("FD001", 5.0, 4.0), ("FD002", 2.0, 2.0)],
        "dataset_id string, label double, prediction double",
    )
    rows = {r["dataset_id"]: (r["rmse"], r["mae"]) for r in model.evaluate(df).collect()}
    assert rows["FD001"] == (pytest.approx(math.sqrt(5)), 2.0)
    assert rows["FD002"] == (0.0, 0.0)
    labels = scaling.label_distribution(df.withColumnRenamed("label", "rul")).orderBy("dataset_id")
    assert tuple(labels.first()) == ("FD001", 1.0, 5.0, 3.0)
