"""Written layers, plans of the main tables, views, the study, and the entry points."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parity import connect, differences
from wearline import schema as S
from wearline.plans import queries as Q
from wearline.plans.medallion import build_layers, open_layers, register_views
from wearline.plans.study import Study
from wearline.workspace import settle, shared_folder

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Q.tables(spark, SMALL)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return re.findall(r"FileScan parquet .*", physical(df))


def test_silver_keeps_every_bronze_row(tables):
    assert tables.bronze.count() == tables.silver.count() == 1000
    # The partition column comes last in a table read from disk.
    assert set(tables.silver.schema.fields) == set(S.SILVER_SCHEMA.fields)


def test_layers_reopen(spark, tables):
    again = open_layers(spark, tables.root)
    assert again.shape == tables.shape
    assert again.valid.count() == tables.valid.count()


def test_bronze_appends_across_loads(spark, folder, tables):
    readings = tables.bronze.drop("load_timestamp")
    odd = F.col("engine_id") % 2 == 1
    build_layers(readings.filter(odd), folder)
    both = build_layers(readings.filter(~odd), folder)
    assert both.silver.count() == 1000
    # Silver is derived from all of Bronze, not from the last load alone.
    same = ["dataset_id", "engine_id", "cycle", "status", "max_cycle", "rul"]
    assert both.silver.select(same).exceptAll(tables.silver.select(same)).isEmpty()


def test_lifetime_lookup_does_not_shuffle_readings(tables):
    df = Q.silver_derived(tables.spark, SMALL)
    plan = physical(df)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["rolling_averages", "ml_features", "anomaly_scores"])
def test_row_frames_need_one_exchange_and_one_window(tables, name):
    df = getattr(tables, name)()
    plan = physical(df)
    assert plan.count("Exchange ") == 1 and len(re.findall(r"\bWindow \[", plan)) == 1
    (scan,) = scans(df)
    assert "sensor_21" not in scan and "EqualTo(status,valid)" in scan


def test_summary_reuses_the_window_partitioning(tables):
    from wearline.operators.anomaly import anomaly_summary

    assert physical(anomaly_summary(tables.anomaly_scores())).count("Exchange ") == 1


def test_drift_is_one_scan(tables):
    df = tables.sensor_drift()
    assert len(scans(df)) == 1 and "Join" not in physical(df)


def test_aggregates_combine_before_the_exchange(tables):
    plan = physical(tables.engine_health())
    assert plan.count("HashAggregate") == 2 and "partial_avg" in plan


def test_no_table_goes_through_one_task(tables):
    for name, df in tables.gold_tables().items():
        assert "SinglePartition" not in physical(df), name


def test_one_dataset_reads_one_directory(tables):
    (scan,) = scans(tables.silver.filter("dataset_id = 'FD002'").select("cycle"))
    assert "PartitionFilters: [isnotnull(dataset_id" in scan


def test_top_k_takes_ordered(tables):
    from wearline.operators.gold import top_drift

    assert "TakeOrderedAndProject" in physical(top_drift(tables.sensor_drift()))


def test_long_series_give_the_same_tables(spark, tables):
    """The same Silver cut into blocks of 16 cycles."""
    cut = open_layers(spark, tables.root, span=16)
    assert cut.shape.last_block > 0
    for name in ("rolling_averages", "ml_features", "anomaly_scores"):
        a, b = getattr(cut, name)(), getattr(tables, name)()
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_views(spark, tables):
    views = register_views(tables)
    assert set(views) >= {
        "silver_sensors", "gold_rolling_averages", "gold_engine_health", "gold_ml_features",
        "gold_sensor_drift", "anomaly_scores", "stg_sensor_readings", "mart_engine_health",
        "mart_ml_features", "mart_sensor_drift",
    }
    counts = spark.sql(
        "SELECT (SELECT count(*) FROM mart_ml_features) AS staged,"
        " (SELECT count(*) FROM gold_ml_features) AS strict,"
        " (SELECT max(rul) FROM mart_ml_features) AS cap"
    ).first()
    assert counts["staged"] >= counts["strict"] and counts["cap"] == 125
    assert len(spark.table("stg_sensor_readings").columns) == 31


def test_gold_is_written(spark, tables, folder):
    """Written tables share one pass and equal the single ones."""
    root = tables.write_gold(f"{folder}/gold")
    for name, table in tables.gold_tables().items():
        written = spark.read.schema(table.schema).parquet(f"{root}/{name}").select(table.columns)
        assert written.exceptAll(table).isEmpty() and table.exceptAll(written).isEmpty(), name


def test_a_table_is_the_same_alone_and_with_others(tables):
    """Also where readings share a cycle."""
    from wearline.operators import anomaly, gold
    from wearline.operators.series import frame_table, frames_of

    folded = tables.valid.withColumn("cycle", F.floor(F.col("cycle") / 3).cast("int"))
    specs = [gold.rolling_table(), gold.feature_table(), anomaly.score_table()]
    shared = frames_of(folded, specs)
    for spec in specs:
        a, b = spec.show(shared), frame_table(folded, spec)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_row_frame_tables_share_one_window(tables):
    from wearline.operators import anomaly, gold
    from wearline.operators.series import frames_of

    specs = [gold.rolling_table(), gold.feature_table(), anomaly.score_table()]
    plan = physical(frames_of(tables.valid, specs, tables.shape))
    assert plan.count("Exchange ") == 1 and len(re.findall(r"\bWindow \[", plan)) == 1


def test_settled_table_is_broadcast_by_size(spark, tables):
    small = settle(tables.lifetimes, "test")
    joined = tables.bronze.join(small, list(S.KEY))
    assert "BroadcastHashJoin" in physical(joined)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in physical(tables.bronze.join(small, list(S.KEY)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_shared_folder_is_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_study(spark):
    """A small forest beats the mean and knows all engines of its split."""
    source = Q.tables(spark, "/root/testdata/sf0.01")
    study = Study(source, forest={"numTrees": 5, "maxDepth": 5})
    results = {r["dataset_id"]: r for r in study.results.collect()}
    assert set(results) == {"FD001", "FD002", "FD003", "FD004"}
    spread = study.test.groupBy("dataset_id").agg(F.stddev_pop("rul").alias("sd")).collect()
    assert all(results[r["dataset_id"]]["rmse"] < 0.6 * r["sd"] for r in spread)
    assert study.predictions.count() == study.test.count()
    weights = study.importance.groupBy("dataset_id").agg(F.sum("importance").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in weights)
    overlap = study.train.select(*S.KEY).distinct().join(study.test, list(S.KEY), "left_semi")
    assert overlap.isEmpty()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 7
    assert set(entry.oracle_sql()) <= set(entry.queries())
    only_rows = set(entry.queries()) - set(entry.oracle_sql())
    own = {name for name in only_rows if name in Q.all_queries()}
    assert own == {"rul_predictions", "rul_results", "rul_against_mean", "feature_importance"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_parity(spark, name):
    df = entry.queries()[name](spark, SMALL)
    assert differences(df, connect(SMALL), entry.oracle_sql()[name]) == ""
