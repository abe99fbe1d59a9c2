"""Structured Streaming ingest: JSON-lines files into the Bronze layer.

Producers drop complete files into a landing directory (write elsewhere, then
rename). Spark reads each file once; lines added to a file already read are not
picked up. The checkpoint holds the read position and makes every batch land in
the sink exactly once, also after a lost executor or a restart.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wearline.schema import CORRUPT_FIELD, STREAM_SCHEMA
from wearline.sources.text import with_load_time

CORRUPT = CORRUPT_FIELD.name
MISFITS = "_misfits"
OBSERVED = "ingest"


def _typed(field: T.StructField) -> Column:
    """A value of the feed, or NULL if it does not fit; a whole number may be written as ``3.0``."""
    value = F.col(f"line.{field.name}")
    if isinstance(field.dataType, T.IntegerType):
        number = value.try_cast("double")
        value = F.when(number == F.floor(number), number.try_cast("int"))
    elif isinstance(field.dataType, T.TimestampType):
        value = F.try_to_timestamp(value)
    else:
        value = value.try_cast(field.dataType)
    return value.alias(field.name)


def _misfits() -> Column:
    """Number of values that were given and did not fit."""
    lost = (
        F.when(F.col(f"line.{f.name}").isNotNull() & F.col(f.name).isNull(), 1).otherwise(0)
        for f in STREAM_SCHEMA.fields
    )
    return reduce(add, lost)


def _parsed_once(line: Column) -> Column:
    """A parsed line as the output of a generator, which later filters cannot be moved through.

    Moved below the parsing, a filter would parse the text again for every field that it asks for.
    """
    return F.explode(F.array(line)).alias("line")


def read_stream(
    spark: SparkSession, landing: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The landing directory as a stream with the fixed reading types.

    Every line is read as text and each field cast for itself: one mistyped
    value becomes NULL and the rest of its reading stays. A line that is no JSON
    object arrives as a row with its text in ``_corrupt_record``. Blank lines
    are no lines. ``_misfits`` counts the values that were lost.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in STREAM_SCHEMA.fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = (
        reader.text(landing)
        .filter(F.trim("value") != "")
        .select(_parsed_once(F.from_json("value", T.StructType([*as_text.fields, CORRUPT_FIELD]), options)), "value")
    )
    broken = F.col("line").isNull() | F.col(f"line.{CORRUPT}").isNotNull()
    typed = parsed.select(
        "line", *map(_typed, STREAM_SCHEMA.fields), F.when(broken, F.col("value")).alias(CORRUPT)
    )
    return typed.withColumn(MISFITS, F.coalesce(_misfits(), F.lit(0))).drop("line")


def good_lines(feed: DataFrame) -> DataFrame:
    """Parsed readings; a missing id is kept and gets its status in Silver."""
    return with_load_time(feed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, MISFITS))


def corrupt_lines(feed: DataFrame) -> DataFrame:
    """Text of the lines that could not be parsed, with the dataset if it was readable."""
    return with_load_time(
        feed.filter(F.col(CORRUPT).isNotNull()).select("dataset_id", CORRUPT)
    )


def start_sink(
    df: DataFrame, out: str, checkpoint: str, trigger: dict[str, Any] | None = None, by: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint; polls every second by default."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if by is not None:
        writer = writer.partitionBy(by)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start(out)


def start_bronze_stream(
    feed: DataFrame, out: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Append the parsed lines of each micro-batch to Bronze.

    The default trigger polls every second; ``{"availableNow": True}`` works
    off what is there and ends. Batch counts are in the query's progress under
    ``observedMetrics`` (see ``ingest_log``).
    """
    good = F.col(CORRUPT).isNull()
    counted = feed.observe(
        OBSERVED,
        F.count_if(good).alias("rows"),
        F.count_if(good & (F.col("engine_id").isNull() | F.col("cycle").isNull())).alias("rows_without_id"),
        F.count_if(good & (F.col(MISFITS) > 0)).alias("rows_with_misfits"),
        F.count_if(~good).alias("broken_lines"),
    )
    return start_sink(good_lines(counted), out, checkpoint, trigger)


def start_quarantine_stream(
    feed: DataFrame, out: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Keep unparsable lines beside Bronze, as a second query with its own checkpoint."""
    return start_sink(corrupt_lines(feed), out, checkpoint, trigger)


COUNTS = ("rows", "rows_without_id", "rows_with_misfits", "broken_lines")


def ingest_log(query: StreamingQuery) -> list[dict[str, int]]:
    """Lines of the latest micro-batches, from the recent progress of the query.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them;
    ``load_log`` has all batches.
    """
    log = []
    for progress in query.recentProgress:
        observed = progress["observedMetrics"].get(OBSERVED)
        if observed is not None:
            log.append({"batch": progress["batchId"], **{name: observed[name] for name in COUNTS}})
    return log


def load_log(bronze: DataFrame) -> DataFrame:
    """Rows of every micro-batch that ever landed, from Bronze itself: none is forgotten.

    All rows of a batch carry its time as ``load_timestamp``.
    """
    without_id = F.col("engine_id").isNull() | F.col("cycle").isNull()
    return bronze.groupBy("load_timestamp").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(without_id).alias("rows_without_id")
    )


# --- one sink for whole and broken lines -------------------------------------

BROKEN = "broken"
LANDED_SCHEMA = T.StructType(
    [
        *STREAM_SCHEMA.fields,
        CORRUPT_FIELD,
        T.StructField(MISFITS, T.IntegerType()),
        T.StructField("load_timestamp", T.TimestampType()),
        T.StructField(BROKEN, T.BooleanType()),
    ]
)


def start_landing_stream(
    feed: DataFrame, out: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Append every line of the feed, whole or broken, to one folder: one query, one checkpoint.

    The folder is partitioned by ``broken``, so a reader of readings never opens
    the files of broken lines. Each row keeps the number of its lost values and,
    as ``load_timestamp``, its micro-batch. No second query has to run for a
    broken line to survive.
    """
    landed = with_load_time(feed).withColumn(BROKEN, F.col(CORRUPT).isNotNull())
    return start_sink(landed, out, checkpoint, trigger, by=BROKEN)


def read_landed(spark: SparkSession, out: str) -> DataFrame:
    """All lines that ever landed."""
    return spark.read.schema(LANDED_SCHEMA).parquet(out)


def stream_landed(spark: SparkSession, out: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed lines as the stream of a second hop; the sink's own log says which files count."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(out)


def readings_of(landed: DataFrame) -> DataFrame:
    """Bronze readings of landed lines, batch or stream."""
    return landed.filter(~F.col(BROKEN)).drop(CORRUPT, MISFITS, BROKEN)


def broken_of(landed: DataFrame) -> DataFrame:
    """Broken lines of landed ones, with the dataset if it was readable."""
    return landed.filter(BROKEN).select("dataset_id", CORRUPT, "load_timestamp")


def landing_log(landed: DataFrame) -> DataFrame:
    """Rows, rows without id, rows with misfits and broken lines of every micro-batch that ever landed.

    An aggregate over the sink: nothing depends on how long progress reports are kept.
    """
    good = ~F.col(BROKEN)
    return landed.groupBy("load_timestamp").agg(
        F.count_if(good).alias("rows"),
        F.count_if(good & (F.col("engine_id").isNull() | F.col("cycle").isNull())).alias("rows_without_id"),
        F.count_if(good & (F.col(MISFITS) > 0)).alias("rows_with_misfits"),
        F.count_if(BROKEN).alias("broken_lines"),
    )
