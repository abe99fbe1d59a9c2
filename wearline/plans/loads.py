"""A warehouse that grows by loads: a load costs what it brings, and giving it twice changes nothing.

A load is known by its content: per dataset the number of its rows and two
order-free sums of their hashes. Loads in the manifest are skipped by an
anti-join. Of a new one

* Bronze gets a folder of its own per dataset, ``dataset_id=.../load=...``;
* ``lives`` and ``series`` get the last cycles and the moments of its engines, in
  such folders too, merged with those of other loads when read;
* Silver is derived again for the datasets that it touches and for no other;
* ``conditions`` gets the feature moments of the engines that it touches, since
  their position in life has changed; for every engine the latest ones count.

All of these replace their folders, and the manifest is written last. So a load
that broke off half way is given again and ends the same; until then its rows
may be seen.

Tables: health, drift and scalers come from the stored moments; no reading is
scanned for them. Drift needs the last cycles of a life, which later loads move:
a load keeps moments of its own last ``period + 1`` cycles one by one, and those
inside the last cycles of the whole life count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators import gold, lifetime, moments, scaling, split, validation
from wearline.sources import layers
from wearline.sources.text import with_load_time
from wearline.plans.medallion import build_silver
from wearline.workspace import settle

READING = tuple(f.name for f in S.READING_SCHEMA.fields)
LOAD = T.StructField("load", T.StringType())
MANIFEST_SCHEMA = T.StructType(
    [S.DATASET_FIELD, LOAD, T.StructField("rows", T.LongType()), T.StructField("load_timestamp", T.TimestampType())]
)
ALL, EARLY, TAIL = "all", "early", "tail"


def load_identities(readings: DataFrame) -> DataFrame:
    """``dataset_id``, ``load``, ``rows``: one row per dataset of a load, the same for the same rows in any order."""
    values = [F.col(c) for c in READING] + [F.col(c).isNull() for c in READING]  # hashes skip nulls
    hashes = F.xxhash64(*values), F.xxhash64(F.lit(1), *values)
    parts = (F.count(F.lit(1)), F.sum(hashes[0].cast("decimal(20,0)")), F.bit_xor(hashes[1]))
    return readings.groupBy("dataset_id").agg(
        F.sha2(F.concat_ws(" ", *(p.cast("string") for p in parts)), 256).substr(1, 32).alias("load"),
        parts[0].alias("rows"),
    )


def _is(column: str, value: str | None) -> Column:
    return F.col(column).eqNullSafe(F.lit(value))


class Warehouse:
    """The tables of one root folder."""

    def __init__(self, spark: SparkSession, root: str, period: int = 30):
        self.spark, self.root, self.period = spark, root, period

    # --- stored tables ------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        """A table with a declared schema; one that was never written is empty."""
        try:
            return layers.read_layer(self.spark, self._path(name), schema)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _replace(self, df: DataFrame, name: str, by: tuple[str, ...]) -> None:
        """Write a table's touched folders anew; the others stay as they are."""
        order = [c for c in (*S.KEY, "cycle") if c in df.columns]
        writer = df.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self._path(name))

    @property
    def manifest(self) -> DataFrame:
        return self._read("manifest", MANIFEST_SCHEMA)

    @property
    def _bronze(self) -> DataFrame:
        return self._read("bronze", T.StructType([*S.BRONZE_SCHEMA.fields, LOAD]))

    @property
    def bronze(self) -> DataFrame:
        return self._bronze.drop("load")

    @property
    def silver(self) -> DataFrame:
        return self._read("silver", S.SILVER_SCHEMA)

    @property
    def lives(self) -> DataFrame:
        """Last cycle of every engine over all loads."""
        fields = [S.DATASET_FIELD, LOAD, S.READING_SCHEMA["engine_id"], T.StructField("max_cycle", T.IntegerType())]
        stored = self._read("lives", T.StructType(fields))
        return stored.groupBy(*S.KEY).agg(F.max("max_cycle").alias("max_cycle"))

    @property
    def series(self) -> DataFrame:
        """Moments of every load's engines: of all valid readings, of early ones, and of the last cycles."""
        fields = [S.DATASET_FIELD, LOAD, S.READING_SCHEMA["engine_id"], T.StructField("part", T.StringType())]
        fields += [T.StructField(c, T.IntegerType()) for c in ("cycle", "last_cycle")]
        return self._read("series", T.StructType([*fields, *_moment_fields(gold.DRIFT_SENSORS)]))

    @property
    def conditions(self) -> DataFrame:
        """Feature moments per engine and operating condition, as last worked out for the engine."""
        fields = [S.DATASET_FIELD, LOAD, S.READING_SCHEMA["engine_id"], T.StructField("op_cond", T.StringType())]
        fields.append(T.StructField("worked_out", T.TimestampType()))
        stored = self._read("conditions", T.StructType([*fields, *_moment_fields(S.FEATURES)]))
        latest = stored.groupBy(*S.KEY).agg(F.max("worked_out").alias("worked_out"))
        current = moments.join_same(stored, latest, (*S.KEY, "worked_out"), "left_semi")
        return current.filter(F.col("op_cond").isNotNull())  # engines without complete rows leave a mark only

    # --- loads --------------------------------------------------------------

    def load(self, readings: DataFrame) -> DataFrame:
        """Take in the datasets of a load that are not known yet; returns their ``dataset_id``, ``load``, ``rows``."""
        found = settle(load_identities(readings), "load")
        new = settle(moments.join_same(found, self.manifest, ("dataset_id", "load"), "left_anti"), "new-load")
        if new.isEmpty():
            return new
        fresh = moments.join_same(readings.select(*READING, "dataset_id"), new.drop("rows"), ("dataset_id",))
        self._replace(with_load_time(fresh), "bronze", ("dataset_id", "load"))
        # One row per dataset of the load: as literals they prune folders.
        folders = [(r["dataset_id"], r["load"]) for r in new.collect()]
        landed = self._bronze.filter(X.any_of(_is("dataset_id", d) & _is("load", k) for d, k in folders))
        touched = X.any_of(_is("dataset_id", d) for d, _ in folders)
        self._keep_lives(landed)
        self._keep_series(landed)
        self._derive(touched)
        self._keep_conditions(landed, touched)
        with_load_time(new).select(*MANIFEST_SCHEMA.names).write.mode("append").parquet(self._path("manifest"))
        return new

    def _keep_lives(self, landed: DataFrame) -> None:
        lives = landed.groupBy(*S.KEY, "load").agg(F.max("cycle").alias("max_cycle"))
        self._replace(lives, "lives", ("dataset_id", "load"))

    def _keep_series(self, landed: DataFrame) -> None:
        """One pass over the load's valid readings for health and drift together."""
        own = settle(landed.groupBy(*S.KEY).agg(F.max("cycle").alias("own_last")), "own-lives")
        valid = moments.join_same(validation.valid_rows(validation.validate(landed)), own, S.KEY)
        cycle, none = F.col("cycle"), F.lit(None).cast("int")

        def part(name: str, at: Column) -> Column:
            return F.struct(F.lit(name).alias("part"), at.alias("cycle"))

        parts = F.array_compact(
            F.array(
                part(ALL, none),
                F.when(cycle <= self.period, part(EARLY, none)),
                F.when(cycle >= F.col("own_last") - self.period, part(TAIL, cycle)),
            )
        )
        rows = valid.select(*S.KEY, "load", *gold.DRIFT_SENSORS, cycle.alias("reading_cycle"), F.explode(parts).alias("p"))
        rows = rows.select("*", "p.part", "p.cycle").drop("p")
        found = moments.moments(
            rows, (*S.KEY, "load", "part", "cycle"), gold.DRIFT_SENSORS, F.max("reading_cycle").alias("last_cycle")
        )
        self._replace(found, "series", ("dataset_id", "load"))

    def _derive(self, touched: Column) -> None:
        """Silver of the touched datasets."""
        lives = settle(self.lives.filter(touched), "lives")
        self._replace(build_silver(self.bronze.filter(touched), lifetimes=lives), "silver", ("dataset_id",))

    def _keep_conditions(self, landed: DataFrame, touched: Column) -> None:
        """Feature moments of the touched engines, from their whole series in Silver."""
        engines = settle(landed.select(*S.KEY, "load").distinct(), "touched-engines")
        valid = validation.valid_rows(self.silver.filter(touched))
        whole = moments.join_same(valid, engines.drop("load"), S.KEY, "left_semi")
        features = scaling.complete_rows(gold.ml_features(whole))
        rows = scaling.with_op_condition(features)
        found = moments.moments(rows, (*S.KEY, "op_cond"), S.FEATURES)
        marked = moments.join_same(engines, found, S.KEY, "left").withColumn("worked_out", F.current_timestamp())
        self._replace(marked, "conditions", ("dataset_id", "load"))

    # --- tables from moments --------------------------------------------------

    def engine_health(self, long_over: int = 200, medium_over: int = 130, digits: tuple[int, int] = (2, 3)) -> DataFrame:
        """The health table (see ``gold.engine_health``) of all loads."""
        means, spread = digits
        last = F.max("last_cycle").alias("total_cycles")
        merged = moments.merge(self.series.filter(F.col("part") == ALL), S.KEY, gold.DRIFT_SENSORS, last)
        return merged.select(
            *S.KEY,
            "total_cycles",
            *(F.round(moments.mean(s), means).alias(f"avg_{s}") for s in gold.DRIFT_SENSORS),
            F.round(moments.deviation("sensor_02", sample=True), spread).alias("stddev_sensor_02"),
            X.life_category(F.col("total_cycles"), long_over, medium_over).alias("life_category"),
        )

    def sensor_drift(self, digits: int = 3) -> DataFrame:
        """The drift table (see ``gold.sensor_drift``) of all loads."""
        parts = moments.join_same(self.series.filter(F.col("part") != ALL), self.lives, S.KEY)
        counted = parts.filter((F.col("part") == EARLY) | (F.col("cycle") >= F.col("max_cycle") - self.period))
        merged = moments.merge(counted, (*S.KEY, "part"), gold.DRIFT_SENSORS)

        def of(part: str, sensor: str):
            return F.max(F.when(F.col("part") == part, moments.mean(sensor)))

        changes = (
            F.round(of(TAIL, s) - of(EARLY, s), digits).alias(f"{S.short_name(s)}_drift") for s in gold.DRIFT_SENSORS
        )
        gathered = merged.groupBy(*S.KEY).agg(F.count(F.lit(1)).alias("__parts"), *changes)
        return gathered.filter("__parts = 2").drop("__parts")

    def scaler(self, fraction: float = 0.8) -> DataFrame:
        """The scaler per condition (see ``scaling.fit_scaler``) over the train engines of all loads."""
        engines = self.series.filter(F.col("part") == ALL).select(*S.KEY).distinct()
        cuts = settle(split.split_cuts(engines, fraction), "cuts")
        train = split.mark_split(self.conditions, cuts).filter("is_train")
        merged = moments.merge(train, scaling.BY_CONDITION, S.FEATURES)
        columns = []
        for f in S.FEATURES:
            spread = moments.deviation(f)
            columns += [moments.mean(f).alias(f"{f}__mean"), F.when(spread == 0, 1.0).otherwise(spread).alias(f"{f}__scale")]
        return merged.select(*scaling.BY_CONDITION, *columns)


def _moment_fields(columns) -> list[T.StructField]:
    kinds = {"n": T.LongType()}
    return [
        T.StructField(moments.named(c, field), kinds.get(field, T.DoubleType())) for c in columns for field in moments.FIELDS
    ]
