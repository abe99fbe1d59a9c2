"""Raw reading files: whitespace-delimited text without header, 26 fields per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.schema import READING_SCHEMA

# Fixed value: the dataset id inside the name of a raw file.
FILE_PATTERN = r"train_(FD\d+)\.txt"


def parse_lines(lines: DataFrame, text: str = "value", mode: str = "permissive") -> DataFrame:
    """Split text lines into the reading columns; works on batch and streaming input.

    Fields are separated by runs of blanks, missing trailing fields are NULL,
    extra ones are ignored and blank lines are skipped. A field that is not a
    number becomes NULL (``permissive``) or drops its row (``skip``).
    """
    if mode not in ("permissive", "skip"):
        raise ValueError(f"unknown mode: {mode}")
    kept = [c for c in lines.columns if c != text]
    line = F.btrim(F.col(text), F.lit(" \t\r"))
    split = lines.filter(F.length(line) > 0).withColumn("__parts", F.split(line, r"\s+"))
    fields = READING_SCHEMA.fields
    if mode == "skip":
        # One pass over the fields: a chain of per-field tests would split the
        # line again for every field once the filter is pushed below the split.
        def broken(token, place):
            number = token.try_cast("double").isNull()
            return (place < len(fields)) & (number | ((place < 2) & token.try_cast("int").isNull()))

        split = split.filter(F.size(F.filter("__parts", broken)) == 0)
    tokens = {f.name: F.get("__parts", F.lit(i)) for i, f in enumerate(fields)}
    return split.select(*kept, *(tokens[f.name].try_cast(f.dataType).alias(f.name) for f in fields))


def read_readings(
    spark: SparkSession,
    paths: str | Sequence[str],
    dataset_id: str | None = None,
    mode: str = "permissive",
    pattern: str = FILE_PATTERN,
) -> DataFrame:
    """Read raw files (paths or globs) in one scan.

    The dataset id is the given tag or, without one, taken from the file name.
    Plain text splits by bytes, so one huge file is still read by many tasks.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    tag = (
        F.lit(dataset_id)
        if dataset_id is not None
        else F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    )
    return parse_lines(lines.withColumn("dataset_id", tag), mode=mode).select(
        *(f.name for f in READING_SCHEMA.fields), "dataset_id"
    )


def with_load_time(df: DataFrame) -> DataFrame:
    """Stamp the load: one value per batch job or per micro-batch."""
    return df.withColumn("load_timestamp", F.current_timestamp())
