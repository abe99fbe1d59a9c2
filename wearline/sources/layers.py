"""Layer tables: Parquet directories partitioned by dataset, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wearline.schema import BRONZE_SCHEMA, DATASET_FIELD, KEY, STREAM_SCHEMA


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a layer. A declared schema keeps dataset ids text, whatever they look like."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_layer(df: DataFrame, path: str, mode: str) -> None:
    """Write a layer without any shuffle.

    Each task sorts its own rows by series, which clusters row groups for later
    filters on engine, cycle or ``max_cycle``; there is no global sort.
    """
    order = [c for c in (*KEY, "cycle") if c in df.columns]
    df.sortWithinPartitions(*order).write.mode(mode).partitionBy(DATASET_FIELD.name).parquet(path)


def append_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Bronze only grows; ``mode="overwrite"`` is for rebuilding it from raw files."""
    write_layer(df, path, mode)


def overwrite_layer(df: DataFrame, path: str) -> None:
    """Silver and Gold are derived, so a run replaces them."""
    write_layer(df, path, "overwrite")


def conform_bronze(df: DataFrame) -> DataFrame:
    """Give a batch or stream Bronze table the common types; unknown columns pass through.

    A value that does not fit its type becomes NULL, which Silver flags.
    """
    declared = {f.name: f.dataType for f in (*BRONZE_SCHEMA.fields, *STREAM_SCHEMA.fields)}
    return df.select(
        *(df[c].try_cast(declared[c]).alias(c) if c in declared else df[c] for c in df.columns)
    )


def union_bronze(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch and streamed Bronze as one table, matched by column name.

    Columns one side lacks (``emitted_at`` in batch) are NULL there.
    """
    return conform_bronze(batch).unionByName(conform_bronze(stream), allowMissingColumns=True)


def union_datasets(*frames: DataFrame) -> DataFrame:
    """UNION ALL of per-dataset frames, matched by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
