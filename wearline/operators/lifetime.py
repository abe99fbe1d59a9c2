"""Last cycle of every series and the columns derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.functions import expressions as X


def engine_lifetimes(df: DataFrame) -> DataFrame:
    """One row per series with its last cycle, over all readings, also invalid ones.

    A hash aggregate with map-side combine: a series holding a third of the
    rows sends one partial row per map task, where a window would gather it in
    one task.
    """
    return df.groupBy(*S.KEY).agg(F.max("cycle").alias("max_cycle"))


def add_lifetime(df: DataFrame, lifetimes: DataFrame | None = None) -> DataFrame:
    """Add ``max_cycle``, ``cycle_pct`` and ``rul`` to every reading.

    Pass ``lifetimes`` as a written table (see ``workspace.settle``): Spark
    then knows its size, broadcasts it below the session's broadcast limit
    (no shuffle of the readings at all) and sort-merges beyond it, where
    adaptive execution splits hot series. Keys compare null-safe, so readings
    without an engine id stay and share the last cycle of their dataset's
    unnamed group.
    """
    lives = engine_lifetimes(df) if lifetimes is None else lifetimes
    renamed = lives.select(*(F.col(c).alias(f"_{c}") for c in S.KEY), "max_cycle")
    same_series = None
    for name in S.KEY:
        match = df[name].eqNullSafe(renamed[f"_{name}"])
        same_series = match if same_series is None else same_series & match
    return (
        df.join(renamed, same_series, "left")
        .drop(*(f"_{c}" for c in S.KEY))
        .withColumns({"cycle_pct": X.cycle_fraction(), "rul": X.remaining_life()})
    )
