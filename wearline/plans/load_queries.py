"""Registered queries of the growing warehouse: the whole table in two loads, the first one given twice.

The first load has the beginning of every life in two datasets, all of a third
and nothing of the others; the second one the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import scaling
from wearline.plans.loads import READING, Warehouse
from wearline.plans.medallion import Medallion, layers_of
from wearline.sources.events import events_as_readings
from wearline.workspace import new_folder

GROUP = 9
_warehouses: dict[str, Warehouse] = {}


def _tables(spark: SparkSession, sf_dir: str) -> Medallion:
    path = f"{sf_dir}/events.parquet"
    return layers_of(spark, path, lambda: events_as_readings(spark, path))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Built once per input: load one, load one again, load two, load one again."""
    tables = _tables(spark, sf_dir)
    if tables.root not in _warehouses:
        found = Warehouse(spark, new_folder(spark, "warehouse"))
        dataset = F.coalesce("dataset_id", F.lit(""))
        early = (F.col("cycle") * 5 <= F.col("max_cycle") * 3) & dataset.isin("FD001", "FD002") | (dataset == "FD003")
        marked = tables.silver.select(*READING, "dataset_id", F.coalesce(early, F.lit(False)).alias("early"))
        first, second = marked.filter("early"), marked.filter("NOT early")
        for load in (first, first, second, first):
            found.load(load)
        _warehouses[tables.root] = found
    return _warehouses[tables.root]


def load_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after repeated loads: every reading once."""
    return warehouse(spark, sf_dir).bronze.select(*READING, "dataset_id")


def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that were taken in, and their rows, per dataset."""
    found = warehouse(spark, sf_dir).manifest.groupBy("dataset_id")
    return found.agg(F.count(F.lit(1)).alias("loads"), F.sum("rows").alias("row_count"))


def load_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after the loads: as if derived from everything at once."""
    return warehouse(spark, sf_dir).silver.select(*S.KEY, "cycle", "status", "max_cycle", "cycle_pct", "rul")


def load_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).engine_health(digits=(GROUP, GROUP))


def load_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).sensor_drift(digits=GROUP)


def load_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.scaler_rows(warehouse(spark, sf_dir).scaler(), digits=GROUP)


QUERIES = {q.__name__: q for q in (load_bronze, load_manifest, load_silver, load_health, load_drift, load_scaler)}


def oracle_sql(bodies: dict[str, str], silver: str) -> dict[str, str]:
    """The same as SQL: what the whole table gives at once."""
    parts = (
        "CASE WHEN dataset_id IN ('FD001', 'FD002') THEN cycle * 5 <= max_cycle * 3"
        " ELSE dataset_id = 'FD003' END AS early"
    )
    return {
        "load_bronze": bodies["scan_readings"],
        "load_manifest": f"{silver}, parts AS (SELECT dataset_id, {parts} FROM silver) SELECT dataset_id,"
        " count(DISTINCT early) AS loads, count(*) AS row_count FROM parts GROUP BY dataset_id",
        "load_silver": f"{silver} SELECT dataset_id, engine_id, cycle, status, max_cycle, cycle_pct, rul FROM silver",
        "load_health": bodies["engine_health"],
        "load_drift": bodies["sensor_drift"],
        "load_scaler": bodies["scaler_per_condition"],
    }
