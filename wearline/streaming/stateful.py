"""Stateful work on the stream: repeats, rolling scores, and Silver as a second hop.

Every function takes and gives a streaming frame; sinks are started by
``ingest.start_sink`` with a checkpoint of their own, which holds read position
and state, so a restart or a lost executor neither repeats nor forgets anything.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wearline import schema as S
from wearline.operators import anomaly, validation
from wearline.operators.series import TIES
from wearline.streaming.ingest import start_sink

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK = 65_536  # readings whose windows are laid out at a time


def silver_status(readings: DataFrame, rules: str | validation.Rules = "full", reject_nan: bool = False) -> DataFrame:
    """Every reading with its status and audit time; nothing is dropped.

    Lifetime columns need the last cycle of an engine, which a stream does not
    know; ``lifetime.add_lifetime`` adds them to the landed table.
    """
    checked = validation.validate(readings, rules, reject_nan)
    return checked.withColumn("silver_timestamp", F.current_timestamp())


def without_repeats(readings: DataFrame, delay: str = "10 minutes", time: str = "emitted_at") -> DataFrame:
    """Drop readings whose engine and cycle came already, at most ``delay`` before in event time.

    State is kept until the watermark, ``delay`` behind the latest event time, has
    passed a reading by ``delay``; a repeat after that counts as new. Readings
    older than the watermark when they arrive are dropped, repeats or not: the
    delay must cover how late the feed can be. Readings without engine, cycle,
    dataset or time cannot repeat each other; they all stay.
    """
    named = reduce(and_, (F.col(c).isNotNull() for c in (*S.KEY, "cycle", time)))
    first = readings.filter(named).withWatermark(time, delay).dropDuplicatesWithinWatermark([*S.KEY, "cycle"])
    return first.unionByName(readings.filter(~named))


# --- rolling scores ----------------------------------------------------------


class _LastReadings(StatefulProcessor):
    """Rolling mean and deviation per engine from its last readings, kept as list state."""

    def __init__(self, sensors: Sequence[str], window: int):
        self.sensors, self.window = list(sensors), window

    def init(self, handle) -> None:
        fields = [T.StructField("cycle", T.IntegerType())]
        fields += [T.StructField(s, T.DoubleType()) for s in self.sensors]
        self.last = handle.getListState("last", T.StructType(fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new = new.sort_values(["cycle", *[c for c in TIES if c in new.columns]], na_position="first", kind="stable")
        kept = [tuple(r) for r in self.last.get()] if self.last.exists() else []
        cycles = np.concatenate([np.array([r[0] for r in kept], np.int64), new["cycle"].to_numpy(np.int64)])
        is_new = np.arange(len(cycles)) >= len(kept)
        late = is_new & (cycles < (kept[-1][0] if kept else cycles.min()))
        order = np.argsort(cycles, kind="stable")  # kept readings come before new ones of their cycle
        values = {
            s: np.concatenate([np.array([r[k] for r in kept], np.float64), new[s].to_numpy(np.float64)])[order]
            for k, s in enumerate(self.sensors, 1)
        }
        shown = order >= len(kept)
        for start in range(0, len(order), CHUNK):
            part = slice(start, start + CHUNK)
            found = {"dataset_id": key[0], "engine_id": key[1], "cycle": cycles[order[part]], "late": late[order[part]]}
            for s in self.sensors:
                name = S.short_name(s)
                before = values[s][max(0, start - self.window + 1) : part.stop]
                mean, deviation = rolling_moments(before, self.window)
                size = len(found["cycle"])
                found |= {s: before[-size:], f"{name}_nan": np.isnan(mean[-size:])}
                found |= {f"{name}_rolling_mean": mean[-size:], f"{name}_rolling_std": deviation[-size:]}
            found["__rows"] = np.minimum(np.arange(start, start + size) + 1, self.window)
            yield pd.DataFrame(found)[shown[part]]
        tail = slice(max(0, len(order) - self.window + 1), None)
        columns = [cycles[order][tail].tolist(), *(values[s][tail].tolist() for s in self.sensors)]
        self.last.put(list(zip(*columns)))

    def close(self) -> None:
        pass


def rolling_moments(values: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of each value and the ``window - 1`` before it; NaN for one value alone.

    Taken from the distances to the value itself, so a flat window has a deviation of exactly 0.
    """
    padded = np.concatenate([np.zeros(window - 1), values])
    rows = np.lib.stride_tricks.sliding_window_view(padded, window)
    given = np.arange(window) >= window - 1 - np.arange(len(values))[:, None]
    n = given.sum(axis=1)
    apart = np.where(given, rows - values[:, None], 0.0)
    shift = apart.sum(axis=1) / n
    squares = np.where(given, apart - shift[:, None], 0.0) ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return values + shift, np.sqrt(squares.sum(axis=1) / (n - 1))


def rolling_scores(
    valid: DataFrame,
    sensors: Sequence[str] = anomaly.SCORED_SENSORS,
    window: int = 20,
    threshold: float = 2.0,
    flag_digits: int = 9,
) -> DataFrame:
    """Score valid readings as they come against their engine's last ``window`` readings.

    Equal to the batch scores when an engine's readings come in the order of their
    cycles; inside a micro-batch they are put in order. A reading older than one
    scored before is marked ``late`` and scored among the readings still kept;
    what was emitted is not taken back. State is ``window - 1`` readings an engine.
    """
    fields = [S.DATASET_FIELD, S.READING_SCHEMA["engine_id"], S.READING_SCHEMA["cycle"]]
    fields.append(T.StructField("late", T.BooleanType()))
    for sensor in sensors:
        name = S.short_name(sensor)
        fields += [T.StructField(c, T.DoubleType()) for c in anomaly.score_columns(sensor)[:3]]
        fields.append(T.StructField(f"{name}_nan", T.BooleanType()))
    fields.append(T.StructField("__rows", T.IntegerType()))
    read = dict.fromkeys((*S.KEY, "cycle", *TIES, *sensors))
    frames = (
        valid.select(*read)
        .groupBy(*S.KEY)
        .transformWithStateInPandas(_LastReadings(sensors, window), T.StructType(fields), "append", "none")
    )
    # Arrow makes NULL of NaN; readings that are no numbers get theirs back.
    none = F.lit(float("nan"))
    for sensor in sensors:
        name = S.short_name(sensor)
        value, mean, deviation = anomaly.score_columns(sensor)[:3]
        frames = frames.withColumns(
            {
                value: F.coalesce(value, none),
                mean: F.when(F.col(f"{name}_nan"), none).otherwise(F.col(mean)),
                deviation: F.when(F.col(f"{name}_nan") & (F.col("__rows") > 1), none).otherwise(F.col(deviation)),
            }
        )
    order = [c for sensor in sensors for c in anomaly.score_columns(sensor)]
    return anomaly.with_scores(frames, sensors, threshold, flag_digits).select(*S.KEY, "cycle", "late", *order)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """List state needs this state store; a query takes the setting along when it starts."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def start_score_stream(
    valid: DataFrame, out: str, checkpoint: str, trigger: dict[str, Any] | None = None, **options
) -> StreamingQuery:
    """Append the rolling scores of a stream of valid readings to a Parquet folder."""
    with _rocksdb(valid.sparkSession):
        return start_sink(rolling_scores(valid, **options), out, checkpoint, trigger)
