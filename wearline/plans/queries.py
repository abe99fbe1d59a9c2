"""Registered queries: every operator over the readings derived from ``events``.

Values are rounded further than the operators' published digits where a SQL
engine could round a decimal tie the other way (6 digits for row frames, 9 for
groups).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators import (
    anomaly,
    gold,
    lifetime,
    model,
    quality,
    scaling,
    split,
    validation,
)
from wearline.plans import load_queries, stream_queries
from wearline.plans.medallion import Medallion, layers_of, model_views
from wearline.plans.study import Study
from wearline.workspace import new_folder
from wearline.sources import layers, text
from wearline.sources.events import events_as_readings
from wearline.streaming import ingest

READING = tuple(f.name for f in S.READING_SCHEMA.fields)
ROW, GROUP = 6, 9
WRITTEN = ("engine_health", "ml_features", "sensor_drift", "anomaly_scores")
QUICK = {"availableNow": True}

_studies: dict[tuple, Study] = {}
_derived: dict[tuple[str, str], str] = {}


def tables(spark: SparkSession, sf_dir: str) -> Medallion:
    path = f"{sf_dir}/events.parquet"
    return layers_of(spark, path, lambda: events_as_readings(spark, path))


def study(spark: SparkSession, sf_dir: str, digits=None) -> Study:
    layers_now = tables(spark, sf_dir)
    key = (spark.sparkContext.applicationId, layers_now.root, digits)
    if key not in _studies:
        _studies[key] = Study(layers_now, digits=digits)
    return _studies[key]


def baseline(spark: SparkSession, sf_dir: str) -> Study:
    """The study with the published feature rounding and forest settings."""
    return study(spark, sf_dir, S.FEATURE_DIGITS["model"])


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks ------------------------------------------------------


def _write_text(readings: DataFrame, lines) -> str:
    """Readings as text files in one directory per raw file name."""
    path = new_folder(readings.sparkSession, "raw")
    file = F.concat(F.lit("train_"), F.col("dataset_id"), F.lit(".txt"))
    readings.select(lines.alias("value"), file.alias("file")).write.partitionBy("file").text(path)
    return path


def _tokens() -> list:
    """Text of every reading field; ``NA`` stands for a missing value."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in READING]


def _once(t: Medallion, kind: str, write: Callable[[], str]) -> str:
    """A folder derived from an input's layers, written by the first query that asks for it."""
    key = (t.root, kind)
    if key not in _derived:
        _derived[key] = write()
    return _derived[key]


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    t = tables(spark, sf_dir)
    return _once(t, "raw", lambda: _write_text(t.bronze, F.concat_ws(" ", *_tokens())))


def scan_readings(spark, sf_dir):
    return text.read_readings(spark, f"{raw_files(spark, sf_dir)}/file=*")


def scan_glob(spark, sf_dir):
    pattern = f"{raw_files(spark, sf_dir)}/file=train_FD00[1-4].txt"
    return text.read_readings(spark, pattern).select(*S.KEY, "cycle", "sensor_02")


def dataset_from_filename(spark, sf_dir):
    named = text.read_readings(spark, f"{raw_files(spark, sf_dir)}/file=*")
    return validation.rows_by(named, "dataset_id")


def _damaged_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw files with the usual defects, spread over the cycles of every series."""
    tokens = _tokens()
    cycle = F.col("cycle")
    named = F.when(cycle % 103 == 0, F.lit("x")).otherwise(tokens[0])
    gap = F.when(cycle % 11 == 0, F.lit("  ")).otherwise(F.lit(" "))
    head = F.concat_ws(" ", F.concat(named, gap, tokens[1]), *tokens[2:20])
    whole = F.when(cycle % 101 == 0, head).otherwise(F.concat_ws(" ", head, *tokens[20:]))
    end = F.when(cycle % 7 == 0, F.lit("  ")).otherwise(F.lit(""))
    t = tables(spark, sf_dir)
    return _once(t, "damaged", lambda: _write_text(t.bronze, F.concat(whole, end)))


def scan_permissive(spark, sf_dir):
    return text.read_readings(spark, f"{_damaged_files(spark, sf_dir)}/file=*")


def scan_malformed(spark, sf_dir):
    return text.read_readings(spark, f"{_damaged_files(spark, sf_dir)}/file=*", mode="skip")


def scan_layer(spark, sf_dir):
    return tables(spark, sf_dir).silver.select(*S.KEY, "cycle", "status", "rul")


def union_datasets(spark, sf_dir):
    """Every dataset as a frame of its own, whatever they are called, put together again."""
    bronze = tables(spark, sf_dir).bronze.select(*READING, "dataset_id")
    names = [r[0] for r in bronze.select("dataset_id").distinct().toLocalIterator()]
    return layers.union_datasets(*(bronze.filter(F.col("dataset_id").eqNullSafe(F.lit(n))) for n in names))


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads appended to one Bronze table."""
    bronze = tables(spark, sf_dir).bronze
    path = new_folder(spark, "bronze")
    early = F.coalesce(F.col("dataset_id") <= "FD002", F.lit(False))
    for load in (bronze.filter(early), bronze.filter(~early)):
        layers.append_bronze(load, path)
    return layers.read_layer(spark, path, S.BRONZE_SCHEMA)


def bronze_append(spark, sf_dir):
    return validation.rows_by(_appended(spark, sf_dir), "dataset_id")


def bronze_appended_rows(spark, sf_dir):
    return _appended(spark, sf_dir).select(*READING, "dataset_id")


def _land(readings: DataFrame) -> str:
    """Readings as JSON-lines files of the feed."""
    path = new_folder(readings.sparkSession, "landing")
    emitted = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("cycle") * 60)
    feed = readings.select(*READING, "dataset_id").withColumn("emitted_at", emitted)
    feed.write.json(path)
    return path


def _streamed(readings: DataFrame) -> DataFrame:
    """Send readings through the stream ingest and read the resulting Bronze."""
    spark = readings.sparkSession
    feed = ingest.read_stream(spark, _land(readings))
    out = new_folder(spark, "stream-bronze")
    query = ingest.start_bronze_stream(feed, out, new_folder(spark, "stream-state"), QUICK)
    query.awaitTermination()
    return layers.read_layer(spark, out)


def stream_ingest(spark, sf_dir):
    streamed = _streamed(tables(spark, sf_dir).bronze)
    return streamed.select(
        *READING, "dataset_id", F.unix_timestamp("emitted_at").alias("emitted_second")
    )


def bronze_union(spark, sf_dir):
    """Three datasets by batch and one by stream, through one Silver."""
    bronze = tables(spark, sf_dir).bronze
    late = F.col("dataset_id").eqNullSafe(F.lit("FD004"))
    both = layers.union_bronze(bronze.filter(~late), _streamed(bronze.filter(late)))
    return validation.validate(both).select(
        *READING, "dataset_id", "status", F.col("emitted_at").isNotNull().alias("from_stream")
    )


def stream_damaged(spark, sf_dir):
    """A feed with mistyped, fractional, undated and broken lines: Bronze and quarantine together."""
    bronze = tables(spark, sf_dir).bronze
    cycle = F.col("cycle")
    emitted = F.timestamp_seconds(F.lit(1_704_067_200) + cycle * 60)
    line = F.to_json(F.struct(*READING, "dataset_id", emitted.alias("emitted_at")))
    for every, field, other in (
        (89, r'"sensor_21":[^,]*', '"sensor_21":"worn"'),
        (83, r'"cycle":([0-9]+)', '"cycle":$1.0'),
        (79, r'"emitted_at":"[^"]*"', '"emitted_at":"yesterday"'),
    ):
        line = F.when(cycle % every == 0, F.regexp_replace(line, field, other)).otherwise(line)
    lines = bronze.select(F.when(cycle % 73 == 0, F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line).alias("value"))
    landing = new_folder(spark, "landing")
    lines.write.text(landing)
    out, bad = new_folder(spark, "stream-bronze"), new_folder(spark, "stream-quarantine")
    for start, path in ((ingest.start_bronze_stream, out), (ingest.start_quarantine_stream, bad)):
        start(ingest.read_stream(spark, landing), path, new_folder(spark, "stream-state"), QUICK).awaitTermination()
    good = layers.read_layer(spark, out).select(
        "dataset_id",
        "engine_id",
        "cycle",
        "sensor_02",
        "sensor_21",
        F.unix_timestamp("emitted_at").alias("emitted_second"),
        F.lit(False).alias("quarantined"),
    )
    kept = layers.read_layer(spark, bad).select(F.lit(True).alias("quarantined"))
    return good.unionByName(kept, allowMissingColumns=True)


def gold_write(spark, sf_dir):
    """The Gold tables as written, by row count."""
    root = tables(spark, sf_dir).write_gold(new_folder(spark, "gold"))
    names = ("rolling_averages", "engine_health", "ml_features", "sensor_drift", "anomaly_scores")
    counted = [
        layers.read_layer(spark, f"{root}/{n}").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return layers.union_datasets(*counted)


def _written_gold(name: str):
    """A Gold table as written with its published digits, and read back."""

    def query(spark, sf_dir):
        t = tables(spark, sf_dir)
        root = _once(t, "gold", lambda: t.write_gold(new_folder(spark, "gold")))
        table = layers.read_layer(spark, f"{root}/{name}")
        # Scores are published unrounded.
        scores = [c for s in anomaly.SCORED_SENSORS for c in anomaly.score_columns(s)[1:4]]
        return _round(table, ROW, *scores) if name == "anomaly_scores" else table

    return query


def _written_rolling(spark, sf_dir):
    """The rolling averages written with more digits: published ones may fall on a decimal tie."""
    path = new_folder(spark, "rolling")
    layers.overwrite_layer(rolling_averages(spark, sf_dir), path)
    return layers.read_layer(spark, path)


# --- Silver -----------------------------------------------------------------


def _status(rules: str):
    def query(spark, sf_dir):
        checked = validation.validate(tables(spark, sf_dir).bronze, rules)
        return checked.select(*S.KEY, "cycle", "status")

    return query


def silver_valid(spark, sf_dir):
    return tables(spark, sf_dir).valid.select(*READING, "dataset_id", "status")


def silver_derived(spark, sf_dir):
    t = tables(spark, sf_dir)
    derived = lifetime.add_lifetime(t.bronze, t.lifetimes)
    return derived.select(*S.KEY, "cycle", "max_cycle", "cycle_pct", "rul")


def rul_capped(spark, sf_dir):
    capped = X.capped(F.col("rul"), S.RUL_CAP).alias("rul_capped")
    return tables(spark, sf_dir).valid.select(*S.KEY, "cycle", "rul", capped)


def rows_by_dataset(spark, sf_dir):
    return validation.rows_by(tables(spark, sf_dir).bronze, "dataset_id")


def rows_by_status(spark, sf_dir):
    return validation.rows_by(tables(spark, sf_dir).silver, "status")


def engine_count(spark, sf_dir):
    return validation.engine_count(tables(spark, sf_dir).bronze)


# --- Gold -------------------------------------------------------------------


def rolling_averages(spark, sf_dir):
    return tables(spark, sf_dir).rolling_averages(digits=ROW)


def engine_health(spark, sf_dir):
    return tables(spark, sf_dir).engine_health(digits=(GROUP, GROUP))


def health_top(spark, sf_dir):
    """The ten longest lives."""
    return gold.longest_lives(engine_health(spark, sf_dir), 10)


def life_category_counts(spark, sf_dir):
    return gold.life_category_counts(tables(spark, sf_dir).engine_health())


def ml_features(spark, sf_dir):
    return tables(spark, sf_dir).ml_features(digits=(ROW, ROW, ROW))


def mart_ml_features(spark, sf_dir):
    """The SQL model: staging rules, capped label."""
    table = model_views(tables(spark, sf_dir))["mart_ml_features"]
    return _round(table, ROW, "s02_mean_10", "s02_std_10", "s02_delta", "s04_delta")


def stg_sensor_readings(spark, sf_dir):
    """The staging model: every row, under its own rules."""
    staging = model_views(tables(spark, sf_dir))["stg_sensor_readings"]
    return staging.select(*READING, "dataset_id", "status", "max_cycle", "cycle_pct", "rul")


def mart_engine_health(spark, sf_dir):
    staging = model_views(tables(spark, sf_dir))["stg_sensor_readings"]
    return gold.engine_health(validation.valid_rows(staging), digits=(GROUP, GROUP))


def mart_sensor_drift(spark, sf_dir):
    staging = model_views(tables(spark, sf_dir))["stg_sensor_readings"]
    return gold.sensor_drift(validation.valid_rows(staging), digits=GROUP)


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid readings in which three neighbours share a cycle and some have none."""
    cycle = F.col("cycle")
    folded = F.when(cycle % 50 != 0, F.floor(cycle / 3).cast("int"))
    return tables(spark, sf_dir).valid.withColumn("cycle", folded)


def _rolling_by(span: int):
    """Rolling averages over repeated and missing cycles, with blocks of ``span`` cycles."""

    def query(spark, sf_dir):
        return gold.rolling_averages(_repeated(spark, sf_dir), span=span, digits=ROW)

    return query


def early_means(spark, sf_dir):
    table = gold.early_means(tables(spark, sf_dir).valid)
    return _round(table, GROUP, "s02_early", "s04_early", "s11_early")


def late_means(spark, sf_dir):
    table = gold.late_means(tables(spark, sf_dir).valid)
    return _round(table, GROUP, "s02_late", "s04_late", "s11_late")


def sensor_drift(spark, sf_dir):
    return tables(spark, sf_dir).sensor_drift(digits=GROUP)


def sensor_drift_join(spark, sf_dir):
    return gold.sensor_drift_join(tables(spark, sf_dir).valid, digits=GROUP)


def top_drift(spark, sf_dir):
    return gold.top_drift(sensor_drift(spark, sf_dir))


# --- anomalies --------------------------------------------------------------


def anomaly_scores(spark, sf_dir):
    parts = [c for s in anomaly.SCORED_SENSORS for c in anomaly.score_columns(s)[1:4]]
    return _round(tables(spark, sf_dir).anomaly_scores(), ROW, *parts)


def anomaly_table(spark, sf_dir):
    """The anomaly table after being written and read back."""
    path = new_folder(spark, "anomaly")
    layers.overwrite_layer(anomaly_scores(spark, sf_dir), path)
    return layers.read_layer(spark, path)


def anomaly_summary(spark, sf_dir):
    return anomaly.anomaly_summary(tables(spark, sf_dir).anomaly_scores(), digits=GROUP)


def top_anomalous_engines(spark, sf_dir):
    return anomaly.top_anomalous_engines(anomaly_summary(spark, sf_dir))


def anomaly_rate(spark, sf_dir):
    return anomaly.anomaly_rate(tables(spark, sf_dir).anomaly_scores(), digits=GROUP)


def anomaly_by_life_stage(spark, sf_dir):
    return anomaly.anomaly_by_life_stage(tables(spark, sf_dir).anomaly_scores(), digits=GROUP)


def anomaly_points(spark, sf_dir):
    points = anomaly.anomaly_points(tables(spark, sf_dir).anomaly_scores())
    return _round(points.select(*S.KEY, "cycle", "sensor_02", "s02_zscore"), ROW, "s02_zscore")


def engine_trace(spark, sf_dir):
    """Series of one engine as shown in a chart."""
    shown = ["cycle", "sensor_02", "s02_rolling_mean", "s02_anomaly", "rul"]
    return gold.engine_trace(anomaly_scores(spark, sf_dir), "FD001", 1, shown)


def rul_preview(spark, sf_dir):
    """First five readings of one engine: remaining life falls as cycles grow."""
    return gold.engine_trace(tables(spark, sf_dir).valid, "FD001", 1, ["cycle", "rul"], 5)


# --- split and scaling ------------------------------------------------------


def op_condition(spark, sf_dir):
    marked = scaling.with_op_condition(tables(spark, sf_dir).valid)
    return marked.select(*S.KEY, "cycle", "op_cond")


def op_condition_missing(spark, sf_dir):
    """Conditions where settings are missing or no numbers."""
    cycle = F.col("cycle")
    spoiled = tables(spark, sf_dir).valid.withColumns(
        {
            "op_setting_1": F.when(cycle % 7 == 0, None).when(cycle % 11 == 0, float("nan")).otherwise(F.col("op_setting_1")),
            "op_setting_2": F.when(cycle % 5 == 0, None).otherwise(F.col("op_setting_2")),
        }
    )
    return scaling.with_op_condition(spoiled).select(*S.KEY, "cycle", "op_cond")


def engine_split(spark, sf_dir):
    s = study(spark, sf_dir)
    return split.engine_split(s.tables.valid, s.cuts)


def engine_split_fixed(spark, sf_dir):
    """The fixed split of the first dataset; all other engines are in neither part."""
    return split.engine_split_fixed(tables(spark, sf_dir).valid, dataset_id="FD001")


def engine_split_ranges(spark, sf_dir):
    """The fixed split by other ranges, in every dataset."""
    return split.engine_split_fixed(tables(spark, sf_dir).valid, (1, 2), (3, 3))


def engine_split_rows(spark, sf_dir):
    """Readings of the listed train engines."""
    engines = engine_split(spark, sf_dir).filter("is_train")
    return split.rows_of(tables(spark, sf_dir).valid, engines).select(*S.KEY, "cycle", "rul")


def _model_columns(df: DataFrame) -> DataFrame:
    return _round(df.select(*S.KEY, "cycle", "rul", "op_cond", *S.FEATURES), ROW, *S.FEATURES)


def train_rows(spark, sf_dir):
    return _model_columns(study(spark, sf_dir).train)


def test_rows(spark, sf_dir):
    return _model_columns(study(spark, sf_dir).test)


def model_rows(spark, sf_dir):
    return study(spark, sf_dir).feature_rows.select(*S.KEY, "cycle", "is_train")


def rul_distribution(spark, sf_dir):
    return _round(scaling.label_distribution(study(spark, sf_dir).train), GROUP, "mean_rul")


def scaler_global(spark, sf_dir):
    return scaling.scaler_rows(study(spark, sf_dir).global_scaler, by=scaling.BY_DATASET, digits=GROUP)


def scaler_per_condition(spark, sf_dir):
    return scaling.scaler_rows(study(spark, sf_dir).scaler, digits=GROUP)


def scaler_fallback(spark, sf_dir):
    return scaling.scaler_rows(study(spark, sf_dir).fallback, by=scaling.BY_DATASET, digits=GROUP)


def condition_count(spark, sf_dir):
    return scaling.condition_count(study(spark, sf_dir).train)


def unseen_conditions(spark, sf_dir):
    s = study(spark, sf_dir)
    return scaling.unseen_conditions(s.test, s.scaler)


def scaled_features(spark, sf_dir):
    return _model_columns(study(spark, sf_dir).scaled)


def scaled_features_global(spark, sf_dir):
    return _model_columns(study(spark, sf_dir).scaled_globally)


# --- model ------------------------------------------------------------------


def regression_metrics(spark, sf_dir):
    """Errors of a fixed predictor: life falls linearly from the cap."""
    guess = F.lit(float(S.RUL_CAP)) * (F.lit(1.0) - F.col("cycle_pct"))
    return model.evaluate(study(spark, sf_dir).test, label="rul", prediction=guess, digits=GROUP)


def feature_vectors(spark, sf_dir):
    """Scaled features as vectors; rows without a scaler have none."""
    vectors = model.feature_vectors(study(spark, sf_dir).scaled, invalid="null")
    given = F.when(F.col("features").isNotNull(), vector_to_array("features"))
    # 0.0 is added to lose the sign of a rounded zero.
    values = F.transform(given, lambda x: F.round(x, ROW) + F.lit(0.0))
    return vectors.select(*S.KEY, "cycle", values.alias("features"))


def rul_predictions(spark, sf_dir):
    return baseline(spark, sf_dir).predictions


def rul_results(spark, sf_dir):
    return baseline(spark, sf_dir).results


def _against_mean(spark, sf_dir) -> DataFrame:
    """Errors of the forests beside those of a guess that knows the train labels' mean only."""
    s = baseline(spark, sf_dir)
    label = F.col("label")
    mean = scaling.label_distribution(s.train).select("dataset_id", "mean_rul")
    engines = s.train.groupBy("dataset_id").agg(F.count_distinct("engine_id").alias("train_engines"))

    def rmse(guess: str):
        return F.sqrt(F.avg((F.col(guess) - label) ** 2))

    return (
        s.predictions.join(mean.join(engines, "dataset_id"), "dataset_id")
        .groupBy("dataset_id")
        .agg(
            F.count(F.lit(1)).alias("test_rows"),
            F.count_distinct("engine_id").alias("test_engines"),
            F.max("train_engines").alias("train_engines"),
            rmse("prediction").alias("rmse"),
            rmse("mean_rul").alias("rmse_of_mean"),
            F.bool_and(F.col("prediction").between(0, S.RUL_CAP)).alias("in_range"),
        )
    )


def rul_against_mean(spark, sf_dir):
    """Whether each forest beats the mean, and from how many lives it learned."""
    return _against_mean(spark, sf_dir).withColumn("beats_mean", F.col("rmse") < F.col("rmse_of_mean"))


def rul_check(spark, sf_dir):
    """What is known of the forests without fitting them: rows, engines, the mean's error, and bounds."""
    s = baseline(spark, sf_dir)
    weights = s.importance.groupBy("dataset_id").agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("importances_sum_to_one")
    )
    checked = _round(_against_mean(spark, sf_dir).drop("rmse"), GROUP, "rmse_of_mean")
    return checked.join(weights, "dataset_id")


def display_sample(spark, sf_dir):
    """At most 200 test rows of each dataset for a chart: the same ones however the rows lie."""
    guess = F.lit(float(S.RUL_CAP)) * (F.lit(1.0) - F.col("cycle_pct"))
    rows = study(spark, sf_dir).test.select(*S.KEY, "cycle", "rul", F.round(guess, ROW).alias("guess"))
    return model.display_sample(rows, 200)


def feature_importance(spark, sf_dir):
    return baseline(spark, sf_dir).importance


# --- data quality -----------------------------------------------------------


def quality_report(spark, sf_dir):
    t = tables(spark, sf_dir)
    return layers.union_datasets(
        quality.check_staging(t.silver),
        quality.run_checks(t.engine_health(), "health", quality.HEALTH_CHECKS),
        quality.run_checks(t.ml_features(), "features", quality.FEATURE_CHECKS),
        quality.run_checks(t.sensor_drift(), "drift", quality.DRIFT_CHECKS),
    )


def quality_written(spark, sf_dir):
    """The declared checks as metrics of the writes of Silver and Gold: no table is read for them."""
    t = tables(spark, sf_dir)
    silver, staging = quality.observed(t.silver, "staging", quality.STAGING_CHECKS, quality.staging_view())
    layers.overwrite_layer(silver, new_folder(spark, "silver"))
    reports = [staging, *t.write_gold_checked(new_folder(spark, "gold"))[1]]
    return layers.union_datasets(*(r.table(spark) for r in reports))


def rul_violations(spark, sf_dir):
    t = tables(spark, sf_dir)
    return quality.rul_violations(t.valid, t.shape, t.span)


def late_stage_report(spark, sf_dir):
    return quality.late_stage_is_highest(anomaly_by_life_stage(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        scan_readings, scan_glob, dataset_from_filename, scan_permissive, scan_malformed,
        scan_layer, union_datasets, bronze_append, bronze_appended_rows, stream_ingest,
        stream_damaged, bronze_union, gold_write, health_top, stg_sensor_readings,
        mart_engine_health, mart_sensor_drift,
        silver_valid, silver_derived, rul_capped, rows_by_dataset, rows_by_status, engine_count,
        rolling_averages, engine_health, life_category_counts, ml_features, mart_ml_features,
        early_means, late_means, sensor_drift, sensor_drift_join, top_drift,
        anomaly_scores, anomaly_table, anomaly_summary, top_anomalous_engines, anomaly_rate,
        anomaly_by_life_stage, anomaly_points, engine_trace, rul_preview,
        op_condition, op_condition_missing,
        engine_split, engine_split_fixed, engine_split_ranges, engine_split_rows,
        train_rows, test_rows, model_rows, rul_distribution,
        scaler_global, scaler_per_condition, scaler_fallback, condition_count,
        unseen_conditions, scaled_features, scaled_features_global,
        regression_metrics, feature_vectors, rul_predictions, rul_results, rul_against_mean, rul_check,
        feature_importance, display_sample, quality_report, quality_written, rul_violations, late_stage_report,
    )
    statuses = {f"silver_status_{name}": _status(name) for name in validation.PRESETS}
    written = {f"gold_written_{name}": _written_gold(name) for name in WRITTEN}
    spans = {"whole": 1 << 20, "blocked": 64, "crowded": 8}
    written["gold_written_rolling_averages"] = _written_rolling
    rolling = {f"rolling_averages_{name}": _rolling_by(span) for name, span in spans.items()}
    listed = {query.__name__: query for query in plain}
    return listed | statuses | written | rolling | stream_queries.QUERIES | load_queries.QUERIES
