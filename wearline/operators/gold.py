"""Analytics tables over valid Silver readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X
from wearline.operators.series import SPAN, FrameTable, SeriesShape, frame_table

DRIFT_SENSORS = ("sensor_02", "sensor_04", "sensor_11")


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """The current reading and the ``rows - 1`` before it; shorter at the series start."""
    return window.rowsBetween(1 - rows, 0)


def _mean(sensor: str, rows: int):
    return lambda window: F.avg(sensor).over(trailing(window, rows))


def _deviation(sensor: str, rows: int):
    return lambda window: F.stddev_samp(sensor).over(trailing(window, rows))


def _change(sensor: str):
    return lambda window: F.col(sensor) - F.lag(sensor, 1).over(window)


def rolling_table(
    windows: Mapping[str, Sequence[int]] | None = None,
    digits: int | None = 3,
    sensors: Sequence[str] = DRIFT_SENSORS,
) -> FrameTable:
    """Rolling means per series, named ``<sensor>_avg_<rows>``."""
    windows = windows or {"sensor_02": (10, 30), "sensor_04": (10,)}
    shown = tuple(dict.fromkeys((*sensors, *windows)))
    columns = {f"{s}_avg_{n}": _mean(s, n) for s, sizes in windows.items() for n in sizes}

    def show(frames: DataFrame) -> DataFrame:
        means = (X.rounded(F.col(c), digits).alias(c) for c in columns)
        return frames.select(*S.KEY, "cycle", *shown, *means)

    longest = max(n for sizes in windows.values() for n in sizes)
    return FrameTable(shown, columns, longest - 1, show)


def rolling_averages(
    df: DataFrame, shape: SeriesShape | None = None, span: int = SPAN, **options
) -> DataFrame:
    return frame_table(df, rolling_table(**options), shape, span)


def engine_health(
    df: DataFrame,
    long_over: int = 200,
    medium_over: int = 130,
    digits: tuple[int, int] = (2, 3),
) -> DataFrame:
    """One row per series: last valid cycle, mean sensors, deviation, life category."""
    means, spread = digits
    last = F.max("cycle")
    return df.groupBy(*S.KEY).agg(
        last.alias("total_cycles"),
        *(F.round(F.avg(s), means).alias(f"avg_{s}") for s in DRIFT_SENSORS),
        F.round(F.stddev_samp("sensor_02"), spread).alias("stddev_sensor_02"),
        X.life_category(last, long_over, medium_over).alias("life_category"),
    )


def feature_table(
    window: int = 10,
    digits: tuple[int, int, int] | None = None,
    rul_cap: int | None = None,
) -> FrameTable:
    """Features for models of remaining life.

    ``digits`` rounds (mean, deviation, delta); see ``FEATURE_DIGITS``.
    The first reading of a series has no deviation and no deltas (NULL).
    """
    mean_d, std_d, delta_d = digits or (None, None, None)
    derived = {
        f"s02_mean_{window}": (_mean("sensor_02", window), mean_d),
        f"s02_std_{window}": (_deviation("sensor_02", window), std_d),
        "s02_delta": (_change("sensor_02"), delta_d),
        "s04_delta": (_change("sensor_04"), delta_d),
    }
    carried = ("cycle_pct", "op_setting_1", "op_setting_2", *DRIFT_SENSORS)

    def show(frames: DataFrame) -> DataFrame:
        return frames.select(
            *S.KEY,
            "cycle",
            X.capped(F.col("rul"), rul_cap).alias("rul"),
            *carried,
            *(X.rounded(F.col(name), d).alias(name) for name, (_, d) in derived.items()),
        )

    columns = {name: make for name, (make, _) in derived.items()}
    return FrameTable(("rul", *carried), columns, max(window - 1, 1), show)


def ml_features(
    df: DataFrame, shape: SeriesShape | None = None, span: int = SPAN, **options
) -> DataFrame:
    """Feature table of all datasets in one pass."""
    return frame_table(df, feature_table(**options), shape, span)


def _early(span: int) -> Column:
    return F.col("cycle") <= span


def _late(span: int) -> Column:
    return F.col("rul") <= span


def _period_means(df: DataFrame, period: Column, sensors: Sequence[str], suffix: str) -> DataFrame:
    means = (F.avg(s).alias(f"{S.short_name(s)}_{suffix}") for s in sensors)
    return df.filter(period).groupBy(*S.KEY).agg(*means)


def early_means(df: DataFrame, sensors: Sequence[str] = DRIFT_SENSORS, span: int = 30) -> DataFrame:
    """Means over cycles up to ``span``; the filter reaches the scan."""
    return _period_means(df, _early(span), sensors, "early")


def late_means(df: DataFrame, sensors: Sequence[str] = DRIFT_SENSORS, span: int = 30) -> DataFrame:
    """Means over readings with at most ``span`` cycles left (``span + 1`` cycles)."""
    return _period_means(df, _late(span), sensors, "late")


def sensor_drift(
    df: DataFrame,
    sensors: Sequence[str] = DRIFT_SENSORS,
    span: int = 30,
    digits: int = 3,
) -> DataFrame:
    """Late mean minus early mean per series, in one scan and one aggregate.

    Series without readings on one side drop out, as in an inner join of the
    two periods; the two periods may overlap in short lives.
    """
    in_early, in_late = _early(span), _late(span)
    gathered = (
        df.filter(in_early | in_late)
        .groupBy(*S.KEY)
        .agg(
            X.count_if(in_early).alias("__early"),
            X.count_if(in_late).alias("__late"),
            *(
                F.round(F.avg(F.when(in_late, F.col(s))) - F.avg(F.when(in_early, F.col(s))), digits)
                .alias(f"{S.short_name(s)}_drift")
                for s in sensors
            ),
        )
    )
    return gathered.filter("__early > 0 AND __late > 0").drop("__early", "__late")


def sensor_drift_join(
    df: DataFrame,
    sensors: Sequence[str] = DRIFT_SENSORS,
    span: int = 30,
    digits: int = 3,
) -> DataFrame:
    """The same table as an inner join of the two period tables (two scans)."""
    joined = early_means(df, sensors, span).join(late_means(df, sensors, span), list(S.KEY))
    names = [S.short_name(s) for s in sensors]
    drifts = (
        F.round(F.col(f"{n}_late") - F.col(f"{n}_early"), digits).alias(f"{n}_drift") for n in names
    )
    return joined.select(*S.KEY, *drifts)


def top_drift(drift: DataFrame, column: str = "s02_drift", n: int = 10) -> DataFrame:
    """The ``n`` series with the largest absolute drift; ties go by key."""
    return drift.orderBy(F.abs(F.col(column)).desc(), *S.KEY).limit(n)


def longest_lives(health: DataFrame, n: int | None = None) -> DataFrame:
    """The health table from the longest life down, optionally the first ``n``; ties go by key."""
    ordered = health.orderBy(F.col("total_cycles").desc(), *S.KEY)
    return ordered if n is None else ordered.limit(n)


def life_category_counts(health: DataFrame) -> DataFrame:
    return health.groupBy("life_category").agg(F.count(F.lit(1)).alias("engines"))


def engine_trace(
    df: DataFrame, dataset_id: str, engine_id: int, columns: Sequence[str], n: int | None = None
) -> DataFrame:
    """Readings of one series in cycle order, optionally the first ``n``."""
    rows = df.filter((F.col("dataset_id") == dataset_id) & (F.col("engine_id") == engine_id))
    ties = [c for c in df.columns if c not in (*S.KEY, "cycle") and not c.endswith("_timestamp")]
    ordered = rows.orderBy("cycle", *ties)
    return (ordered if n is None else ordered.limit(n)).select(*S.KEY, *columns)
