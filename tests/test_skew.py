"""One engine or condition with a third of all rows, and large lookup tables."""

import pytest
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import gold, lifetime, scaling
from wearline.operators.series import measure_series
from wearline.operators.validation import valid_rows
from wearline.plans.medallion import build_silver
from wearline.workspace import settle


@pytest.fixture
def large_data(spark):
    """Lookups too large to broadcast, a low bar for skew, and no merging of small partitions."""
    changed = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 readings, a third of them of one engine, in a written table."""
    import tempfile

    hot = F.col("id") % 3 == 0
    engine = F.when(hot, 1).otherwise(F.col("id") % 200 + 2).cast("int")
    df = spark.range(0, 60_000, 1, 16).select(
        F.lit("FD001").alias("dataset_id"),
        engine.alias("engine_id"),
        F.when(hot, F.col("id") / 3).otherwise(F.col("id") / 200).cast("int").alias("cycle"),
        *(F.lit(0.5).alias(c) for c in S.SETTINGS),
        *((F.xxhash64("id", F.lit(c)) % 1000 / 10 + 101).alias(c) for c in S.SENSORS),
    )
    path = tempfile.mkdtemp(prefix="wearline-test-") + "/skewed"
    df.write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_engine_is_split_in_the_lifetime_join(spark, skewed, large_data):
    lives = settle(lifetime.engine_lifetimes(skewed), "lives")
    plan = final_plan(lifetime.add_lifetime(skewed, lives).select(*S.KEY, "rul", *S.SENSORS))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_condition_is_split_in_the_scaler_join(spark, skewed, large_data):
    rows = skewed.withColumn("op_cond", F.concat(F.lit("c"), "engine_id"))
    features = ("sensor_02", "sensor_04")
    scaler = settle(scaling.fit_scaler(rows, features), "scaler")
    assert "SortMergeJoin(skew=true)" in final_plan(scaling.apply_scaler(rows, scaler, features))


def test_hot_engine_is_spread_over_window_tasks(spark, skewed, large_data):
    """Blocks of 500 cycles: the rows of the hot engine land in many partitions."""
    # Input that already lies by engine must not keep its layout.
    valid = valid_rows(build_silver(skewed)).repartition(*S.KEY)
    assert measure_series(valid, 500).last_block == 39
    rolled = gold.rolling_averages(valid, digits=None, span=500)
    spread = (
        rolled.filter("engine_id = 1")
        .groupBy(F.spark_partition_id().alias("task"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    assert sum(r["n"] for r in spread) == 20_000
    assert max(r["n"] for r in spread) < 10_000
    plain = gold.rolling_averages(valid, digits=None)
    assert rolled.exceptAll(plain).isEmpty() and plain.exceptAll(rolled).isEmpty()


def test_copies_of_one_reading_are_spread(spark, skewed, large_data):
    """20,000 copies of one reading: no task holds more than a few pieces of them."""
    valid = valid_rows(build_silver(skewed)).filter("engine_id = 2").orderBy("cycle").limit(300)
    some = settle(valid, "some")
    copies = settle(some.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20_000)))), "copies")
    table = some.unionByName(copies.drop("n"))
    rolled = settle(
        gold.rolling_averages(table, digits=None, span=500).withColumn(
            "task", F.spark_partition_id()
        ),
        "rolled",
    )
    assert rolled.count() == table.count() > 20_000
    assert rolled.groupBy("task").count().agg(F.max("count")).first()[0] < 6_000
    plain = gold.rolling_averages(table, digits=None)
    rolled = rolled.drop("task")
    assert rolled.exceptAll(plain).isEmpty() and plain.exceptAll(rolled).isEmpty()
