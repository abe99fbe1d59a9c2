"""Bronze, Silver and Gold as written tables, and the views over them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import anomaly, gold, lifetime, quality, validation
from wearline.operators.series import SPAN, SeriesShape, frames_of, measure_series
from wearline.workspace import new_folder
from wearline.sources import layers
from wearline.sources.text import with_load_time


def build_silver(
    bronze: DataFrame,
    rules: str | validation.Rules = "full",
    lifetimes: DataFrame | None = None,
    reject_nan: bool = False,
) -> DataFrame:
    """Status, lifetime columns and audit time for every Bronze row of all datasets."""
    checked = validation.validate(bronze, rules, reject_nan)
    derived = lifetime.add_lifetime(checked, lifetimes)
    return derived.withColumn("silver_timestamp", F.current_timestamp())


@dataclass(frozen=True)
class Medallion:
    """The written layers of one input."""

    spark: SparkSession
    root: str
    shape: SeriesShape
    span: int = SPAN

    @cached_property
    def bronze(self) -> DataFrame:
        return layers.read_layer(self.spark, f"{self.root}/bronze", S.BRONZE_SCHEMA)

    @cached_property
    def lifetimes(self) -> DataFrame:
        return layers.read_layer(self.spark, f"{self.root}/lifetimes")

    @cached_property
    def silver(self) -> DataFrame:
        return layers.read_layer(self.spark, f"{self.root}/silver", S.SILVER_SCHEMA)

    @property
    def valid(self) -> DataFrame:
        """Valid Silver readings, the input of every Gold table."""
        return validation.valid_rows(self.silver)

    def _frames(self) -> dict:
        return {"shape": self.shape, "span": self.span}

    def rolling_averages(self, **options) -> DataFrame:
        return gold.rolling_averages(self.valid, **self._frames(), **options)

    def engine_health(self, **options) -> DataFrame:
        return gold.engine_health(self.valid, **options)

    def ml_features(self, **options) -> DataFrame:
        return gold.ml_features(self.valid, **self._frames(), **options)

    def sensor_drift(self, **options) -> DataFrame:
        return gold.sensor_drift(self.valid, **options)

    def anomaly_scores(self, **options) -> DataFrame:
        return anomaly.rolling_zscore(self.valid, **self._frames(), **options)

    def gold_tables(self) -> dict[str, DataFrame]:
        """The Gold tables with the rounding they are published with."""
        return {
            "rolling_averages": self.rolling_averages(),
            "engine_health": self.engine_health(),
            "ml_features": self.ml_features(digits=S.FEATURE_DIGITS["gold"]),
            "sensor_drift": self.sensor_drift(),
            "anomaly_scores": self.anomaly_scores(),
        }

    def write_gold(self, root: str | None = None) -> str:
        """Write every Gold table; returns their folder."""
        return self.write_gold_checked(root)[0]

    def write_gold_checked(self, root: str | None = None) -> tuple[str, list[quality.Report]]:
        """Write every Gold table, with the declared checks counted by the writes themselves.

        The three row-frame tables share one pass over Silver: their columns
        are written once and each table is a projection of that, so Silver is
        shuffled and sorted one time and not three.
        """
        root = root or f"{self.root}/gold"
        shared = {
            "rolling_averages": gold.rolling_table(),
            "ml_features": gold.feature_table(digits=S.FEATURE_DIGITS["gold"]),
            "anomaly_scores": anomaly.score_table(),
        }
        frames = frames_of(self.valid, shared.values(), **self._frames())
        layers.overwrite_layer(frames, f"{root}/frames")
        stored = layers.read_layer(self.spark, f"{root}/frames", frames.schema)
        tables = {n: table.show(stored) for n, table in shared.items()}
        tables |= {"engine_health": self.engine_health(), "sensor_drift": self.sensor_drift()}
        reports = []
        for name, table in tables.items():
            if name in quality.GOLD_CHECKS:
                table, report = quality.observed(table, *quality.GOLD_CHECKS[name])
                reports.append(report)
            layers.overwrite_layer(table, f"{root}/{name}")
        return root, reports


def build_layers(
    readings: DataFrame, root: str | None = None, span: int = SPAN, bronze_mode: str = "append"
) -> Medallion:
    """Load readings into Bronze and derive Silver from the whole of Bronze."""
    spark = readings.sparkSession
    root = root or new_folder(spark, "layers")
    layers.append_bronze(with_load_time(readings), f"{root}/bronze", bronze_mode)
    bronze = layers.read_layer(spark, f"{root}/bronze", S.BRONZE_SCHEMA)
    lifetime.engine_lifetimes(bronze).write.mode("overwrite").parquet(f"{root}/lifetimes")
    lives = layers.read_layer(spark, f"{root}/lifetimes")
    layers.overwrite_layer(build_silver(bronze, lifetimes=lives), f"{root}/silver")
    silver = layers.read_layer(spark, f"{root}/silver", S.SILVER_SCHEMA)
    return Medallion(spark, root, measure_series(silver, span), span)


def open_layers(spark: SparkSession, root: str, span: int = SPAN) -> Medallion:
    """Use layers written by an earlier run."""
    silver = layers.read_layer(spark, f"{root}/silver", S.SILVER_SCHEMA)
    return Medallion(spark, root, measure_series(silver, span), span)


def model_views(tables: Medallion) -> dict[str, DataFrame]:
    """The SQL models: one staging table and three marts over it.

    Staging has its own, laxer rules; the marts use its valid rows.
    """
    staging = validation.validate(tables.silver.drop("status"), "staging").drop(
        "load_timestamp", "silver_timestamp"
    )
    valid = validation.valid_rows(staging)
    frames = {"shape": tables.shape, "span": tables.span}
    return {
        "stg_sensor_readings": staging,
        "mart_engine_health": gold.engine_health(valid),
        "mart_ml_features": gold.ml_features(valid, rul_cap=S.RUL_CAP, **frames),
        "mart_sensor_drift": gold.sensor_drift(valid),
    }


def register_views(tables: Medallion) -> dict[str, DataFrame]:
    """Make layers, Gold tables and SQL models available to ``spark.sql``."""
    views = {"bronze_readings": tables.bronze, "silver_readings": tables.silver}
    views["silver_sensors"] = tables.valid
    views |= {
        (name if name == "anomaly_scores" else f"gold_{name}"): table
        for name, table in tables.gold_tables().items()
    }
    views |= model_views(tables)
    for name, table in views.items():
        table.createOrReplaceTempView(name)
    return views


_built: dict[tuple, Medallion] = {}


def version_of(spark: SparkSession, source: str) -> str:
    """Files of an input with their sizes and times, as one text; nothing of them is read.

    A single file is asked for at its file system. Folders and globs are listed by a Spark job.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(path) and system.getFileStatus(path).isFile():
        status = system.getFileStatus(path)
        return f"{status.getModificationTime()}-{status.getLen()}"
    files = spark.read.format("binaryFile").load(source)
    named = F.xxhash64("path", "modificationTime", "length")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(named).alias("x")).first()
    return f"{row['n']}-{row['x']}"


def layers_of(spark: SparkSession, source: str, load: Callable[[], DataFrame]) -> Medallion:
    """Layers of an input, built once per application and version of the input."""
    key = (spark.sparkContext.applicationId, source, version_of(spark, source))
    if key not in _built:
        _built[key] = build_layers(load())
    return _built[key]
