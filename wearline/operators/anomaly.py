"""Rolling z-score anomalies and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators.gold import trailing
from wearline.operators.series import SPAN, FrameTable, SeriesShape, frame_table

SCORED_SENSORS = ("sensor_02", "sensor_11")


def score_columns(sensor: str) -> list[str]:
    """A scored sensor and its four derived columns, in table order."""
    name = S.short_name(sensor)
    return [sensor, *(f"{name}_{part}" for part in ("rolling_mean", "rolling_std", "zscore", "anomaly"))]


def with_scores(
    frames: DataFrame, sensors: Sequence[str], threshold: float = 2.0, flag_digits: int = 9
) -> DataFrame:
    """Score and flag from each sensor's rolling mean and deviation; row-local, so also on a stream."""
    for sensor in sensors:
        _, mean, deviation, zscore, anomaly = score_columns(sensor)
        distance = F.try_divide(F.col(sensor) - F.col(mean), F.col(deviation))
        frames = frames.withColumn(
            zscore, F.when(F.col(deviation) > 0, distance).otherwise(0.0)
        ).withColumn(anomaly, F.abs(F.round(zscore, flag_digits)) > threshold)
    return frames


def score_table(
    sensors: Sequence[str] = SCORED_SENSORS,
    window: int = 20,
    threshold: float = 2.0,
    flag_digits: int = 9,
) -> FrameTable:
    """Score each reading against the mean and deviation of its trailing window.

    The window holds the reading itself. A flat or single-reading window scores
    0. The flag is strict (``abs(z) > threshold``) on the score rounded to
    ``flag_digits``, so a score that is the threshold in exact numbers is not
    flagged for its last bit. Gives the anomaly table:
    key, cycle, rul and five columns per sensor.
    """
    columns = {}
    for sensor in sensors:
        _, mean, deviation, *_ = score_columns(sensor)
        columns[mean] = lambda w, s=sensor: F.avg(s).over(trailing(w, window))
        columns[deviation] = lambda w, s=sensor: F.stddev_samp(s).over(trailing(w, window))

    def show(frames: DataFrame) -> DataFrame:
        order = [c for sensor in sensors for c in score_columns(sensor)]
        return with_scores(frames, sensors, threshold, flag_digits).select(*S.KEY, "cycle", "rul", *order)

    return FrameTable(("rul", *sensors), columns, window - 1, show)


def rolling_zscore(
    df: DataFrame,
    sensors: Sequence[str] = SCORED_SENSORS,
    shape: SeriesShape | None = None,
    span: int = SPAN,
    **options,
) -> DataFrame:
    return frame_table(df, score_table(sensors, **options), shape, span)


def anomaly_summary(
    scores: DataFrame, sensors: Sequence[str] = SCORED_SENSORS, digits: int = 1
) -> DataFrame:
    """Readings and anomalies per series, with the rate of the first sensor in percent."""
    flags = {S.short_name(s): F.col(f"{S.short_name(s)}_anomaly") for s in sensors}
    first = next(iter(flags))
    return scores.groupBy(*S.KEY).agg(
        F.count(F.lit(1)).alias("total_cycles"),
        *(X.count_if(flag).alias(f"{name}_anomalies") for name, flag in flags.items()),
        X.percentage(X.count_if(flags[first]), F.count(F.lit(1)), digits).alias(
            f"{first}_anomaly_pct"
        ),
    )


def top_anomalous_engines(
    summary: DataFrame, n: int = 10, column: str = "s02_anomaly_pct"
) -> DataFrame:
    """The ``n`` series with the highest anomaly rate; ties go by key."""
    return summary.orderBy(F.col(column).desc(), *S.KEY).limit(n)


def anomaly_rate(scores: DataFrame, flag: str = "s02_anomaly", digits: int = 1) -> DataFrame:
    """Anomalies, readings and rate of the whole table, as one row from one scan."""
    hits, total = X.count_if(F.col(flag)), F.count(F.lit(1))
    return scores.agg(
        hits.alias("anomalies"),
        total.alias("total_readings"),
        X.percentage(hits, total, digits).alias("anomaly_rate_pct"),
    )


def anomaly_by_life_stage(
    scores: DataFrame, flag: str = "s02_anomaly", digits: int = 2
) -> DataFrame:
    hits, total = X.count_if(F.col(flag)), F.count(F.lit(1))
    return scores.groupBy(X.life_stage(F.col("rul")).alias("life_stage")).agg(
        total.alias("total_readings"),
        hits.alias("anomalies"),
        X.percentage(hits, total, digits).alias("anomaly_rate_pct"),
    )


def anomaly_points(scores: DataFrame, flag: str = "s02_anomaly") -> DataFrame:
    return scores.filter(F.col(flag))
