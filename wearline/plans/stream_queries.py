"""Registered queries of the stateful stream work: the whole table, landed part by part.

Each part is a range of cycles, so engines move forward in time together. After
every part the streams are started anew on the same checkpoints, work off what
is there and end: each part is a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import anomaly, validation
from wearline.plans.medallion import Medallion, layers_of
from wearline.sources import layers
from wearline.sources.events import events_as_readings
from wearline.streaming import ingest, stateful
from wearline.workspace import new_folder

READING = tuple(f.name for f in S.READING_SCHEMA.fields)
PARTS = 4
DIGITS = 6
QUICK = {"availableNow": True}
START = 1_704_067_200  # event time of cycle 0; a cycle is a minute


def _tables(spark: SparkSession, sf_dir: str) -> Medallion:
    path = f"{sf_dir}/events.parquet"
    return layers_of(spark, path, lambda: events_as_readings(spark, path))


def _span(tables: Medallion) -> int:
    """Cycles of one part."""
    last = tables.lifetimes.agg(F.max("max_cycle")).first()[0] or 0
    return max(1, -(-(last + 1) // PARTS))


def _emitted(cycle: Column) -> Column:
    return F.timestamp_seconds(F.lit(START) + cycle * 60)


def _fed(spark: SparkSession, parts: list[DataFrame], step: Callable[[str], None]) -> None:
    """Land one part after the other as JSON lines; after each, run ``step`` on the landing folder."""
    landing = new_folder(spark, "landing")
    for lines in parts:
        lines.write.mode("append").text(landing)
        step(landing)


def _lines(readings: DataFrame) -> DataFrame:
    return readings.select(F.to_json(F.struct(*READING, "dataset_id", "emitted_at")).alias("value"))


def _part(bronze: DataFrame, span: int, k: int) -> DataFrame:
    inside = F.col("cycle").between(k * span, (k + 1) * span - 1)
    if k == 0:
        inside = inside | F.col("cycle").isNull() | (F.col("cycle") < 0)
    return bronze.filter(inside).withColumn("emitted_at", _emitted(F.col("cycle")))


def _folders(spark: SparkSession, *names: str) -> list[str]:
    return [new_folder(spark, f"stream-{name}") for name in names]


def stream_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling scores from state, over four restarts; the same as the batch scores."""
    tables = _tables(spark, sf_dir)
    span = _span(tables)
    out, state = _folders(spark, "scores", "scores-state")

    def step(landing: str) -> None:
        readings = ingest.good_lines(ingest.read_stream(spark, landing))
        valid = validation.valid_rows(stateful.silver_status(readings))
        stateful.start_score_stream(valid, out, state, QUICK).awaitTermination()

    _fed(spark, [_lines(_part(tables.bronze, span, k)) for k in range(PARTS)], step)
    parts = [c for s in anomaly.SCORED_SENSORS for c in anomaly.score_columns(s)[1:4]]
    return layers.read_layer(spark, out).withColumns({c: F.round(c, DIGITS) for c in parts})


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with repeats inside a batch, in the next batch, too late, and anew after the delay."""
    tables = _tables(spark, sf_dir)
    bronze, span, cycle = tables.bronze, _span(tables), F.col("cycle")
    parts = []
    for k in range(PARTS):
        part = _part(bronze, span, k)
        part = part.unionByName(part.filter(cycle % 10 == 0))
        if k:
            part = part.unionByName(_part(bronze, span, k - 1).filter(cycle % 7 == 0))
        if k == PARTS - 1:
            again = _part(bronze, span, 0).filter(cycle % 11 == 0)
            part = part.unionByName(again.withColumn("emitted_at", _emitted(cycle + k * span)))
        parts.append(_lines(part))
    out, state = _folders(spark, "once", "once-state")

    def step(landing: str) -> None:
        readings = ingest.good_lines(ingest.read_stream(spark, landing))
        once = stateful.without_repeats(readings, f"{15 * span} seconds")
        ingest.start_sink(once, out, state, QUICK).awaitTermination()

    _fed(spark, parts, step)
    emitted = F.unix_timestamp("emitted_at").alias("emitted_second")
    return layers.read_layer(spark, out).select(*READING, "dataset_id", emitted)


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed to landing folder to Silver, two hops with checkpoints of their own; some lines lack their engine."""
    tables = _tables(spark, sf_dir)
    span = _span(tables)
    landed, landed_state, silver, silver_state = _folders(spark, "landed", "landed-state", "silver", "silver-state")
    nameless = F.when(F.col("cycle") % 53 != 0, F.col("engine_id"))

    def step(landing: str) -> None:
        feed = ingest.read_stream(spark, landing)
        ingest.start_landing_stream(feed, landed, landed_state, QUICK).awaitTermination()
        bronze = ingest.readings_of(ingest.stream_landed(spark, landed))
        checked = stateful.silver_status(bronze)
        ingest.start_sink(checked, silver, silver_state, QUICK, by="dataset_id").awaitTermination()

    parts = [_part(tables.bronze, span, k).withColumn("engine_id", nameless) for k in range(PARTS)]
    _fed(spark, list(map(_lines, parts)), step)
    checked = layers.read_layer(spark, silver)
    return checked.select(F.col("dataset_id").cast("string").alias("dataset_id"), "engine_id", "cycle", "sensor_02", "status")


def _damaged(part: DataFrame) -> DataFrame:
    """Lines of a part: some mistyped, undated or nameless, some broken."""
    cycle = F.col("cycle")
    nameless = part.withColumn("engine_id", F.when(cycle % 61 != 0, F.col("engine_id")))
    lines = nameless.select("cycle", F.to_json(F.struct(*READING, "dataset_id", "emitted_at")).alias("value"))
    value = F.col("value")
    for every, field, other in (
        (89, r'"sensor_21":[^,]*', '"sensor_21":"worn"'),
        (79, r'"emitted_at":"[^"]*"', '"emitted_at":"yesterday"'),
    ):
        value = F.when(cycle % every == 0, F.regexp_replace(value, field, other)).otherwise(value)
    return lines.select(F.when(cycle % 73 == 0, F.substring(value, F.lit(1), F.length(value) - 9)).otherwise(value).alias("value"))


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed in every micro-batch, from the sink of the one landing query."""
    tables = _tables(spark, sf_dir)
    span = _span(tables)
    landed, state = _folders(spark, "landed", "landed-state")

    def step(landing: str) -> None:
        feed = ingest.read_stream(spark, landing)
        ingest.start_landing_stream(feed, landed, state, QUICK).awaitTermination()

    _fed(spark, [_damaged(_part(tables.bronze, span, k)) for k in range(PARTS)], step)
    log = ingest.landing_log(ingest.read_landed(spark, landed))
    batch = F.row_number().over(Window.orderBy("load_timestamp"))  # one row per micro-batch
    return log.select((batch - 1).alias("batch"), "rows", "rows_without_id", "rows_with_misfits", "broken_lines")


QUERIES = {q.__name__: q for q in (stream_zscore, stream_dedup, stream_silver, stream_log)}


def oracle_sql(bronze: str, silver: str, scores: str, status: str) -> dict[str, str]:
    """The same as SQL, from the common parts of the other queries' SQL."""
    reading = ", ".join(READING)
    span = f"spans AS (SELECT greatest(1, (max(cycle) + {PARTS}) // {PARTS}) AS span FROM bronze)"
    columns = ", ".join(c for s in anomaly.SCORED_SENSORS for c in anomaly.score_columns(s))
    return {
        "stream_zscore": f"{silver},{scores} SELECT dataset_id, engine_id, cycle, false AS late, {columns} FROM scores",
        "stream_dedup": f"{bronze}, {span} SELECT {reading}, dataset_id, {START}::BIGINT + cycle * 60 AS emitted_second"
        f" FROM bronze UNION ALL SELECT {reading}, dataset_id, {START}::BIGINT + (cycle + {PARTS - 1} * span) * 60"
        " FROM bronze, spans WHERE cycle < span AND cycle % 11 = 0",
        "stream_silver": f"{bronze}, named AS (SELECT * REPLACE (CASE WHEN cycle % 53 <> 0 THEN engine_id END AS engine_id)"
        f" FROM bronze) SELECT dataset_id, engine_id, cycle, sensor_02, {status} AS status FROM named",
        "stream_log": f"{bronze}, {span} SELECT (cycle // span)::INTEGER AS batch,"
        " count(*) FILTER (cycle % 73 <> 0) AS rows,"
        " count(*) FILTER (cycle % 73 <> 0 AND cycle % 61 = 0) AS rows_without_id,"
        " count(*) FILTER (cycle % 73 <> 0 AND (cycle % 79 = 0 OR cycle % 89 = 0 AND sensor_21 IS NOT NULL))"
        " AS rows_with_misfits, count(*) FILTER (cycle % 73 = 0) AS broken_lines"
        " FROM bronze, spans GROUP BY batch",
    }
