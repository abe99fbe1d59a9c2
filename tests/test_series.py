"""The three plans of row-frame windows give the values of the plain window."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.operators.series import SeriesShape, measure_series, series_windows

SCHEMA = "dataset_id string, engine_id int, cycle int, x double, max_cycle int"
REACH = 4
COLUMNS = {
    "mean": lambda w: F.avg("x").over(w.rowsBetween(-REACH, 0)),
    "deviation": lambda w: F.stddev_samp("x").over(w.rowsBetween(-2, 0)),
    "before": lambda w: F.lag("x", 1).over(w),
}


def table(spark, readings):
    """Rows of (engine, cycle, value), with the last cycle of each engine."""
    last = {}
    for engine, cycle, _ in readings:
        known = [c for c in (cycle, last.get(engine)) if c is not None]
        last[engine] = max(known, default=None)
    rows = [("FD001", e, c, None if x is None else float(x), last[e]) for e, c, x in readings]
    return spark.createDataFrame(rows, SCHEMA)


def results(df):
    names = ["engine_id", "cycle", "x", *COLUMNS]
    return sorted(map(str, (tuple(r) for r in df.select(*names).collect())))


def plain(df, span):
    """One window per series; rows of the same cycle go by content."""
    window = Window.partitionBy("dataset_id", "engine_id").orderBy("cycle", "x", "max_cycle")
    return results(df.withColumns({n: make(window) for n, make in COLUMNS.items()}))


def check(spark, readings, span):
    df = table(spark, readings)
    assert results(series_windows(df, COLUMNS, REACH, span=span)) == plain(df, span)


def test_short_series_use_one_exchange_and_one_window(spark):
    df = table(spark, [(e, c, c) for e in (1, 2) for c in range(1, 6)])
    plan = series_windows(df, COLUMNS, REACH, SeriesShape(0, 5))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1
    assert text.count("Window ") == 1


def test_dense_long_series(spark):
    check(spark, [(e, c, c * 37 % 11) for e in (1, 2) for c in range(1, 80)], span=10)


def test_sparse_long_series(spark):
    """Blocks with fewer rows than the frame reaches back, and empty blocks."""
    rng = random.Random(7)
    cycles = sorted(rng.sample(range(400), 60))
    check(spark, [(1, c, rng.randint(0, 9)) for c in cycles], span=8)


def test_series_starting_late_or_below_zero(spark):
    readings = [(1, c, c % 5) for c in range(95, 130)] + [(2, c, c % 3) for c in range(-6, 30)]
    check(spark, readings, span=10)


def test_copies_of_one_reading(spark):
    """One reading repeated far beyond a block, between ordinary ones."""
    readings = [(1, c, c % 7) for c in range(1, 40)] + [(1, 20, 5.0)] * 300
    check(spark, readings, span=10)


def test_many_readings_at_one_cycle(spark):
    rng = random.Random(3)
    readings = [(1, c, c % 7) for c in range(1, 40)]
    readings += [(1, 20, rng.randint(0, 500)) for _ in range(300)]
    check(spark, readings, span=10)


def test_crowded_and_calm_engines_together(spark):
    rng = random.Random(5)
    readings = [(1, rng.randint(0, 30), rng.randint(0, 3)) for _ in range(250)]
    readings += [(2, c, c) for c in range(0, 60, 3)] + [(3, 1, 1.0)]
    check(spark, readings, span=10)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(1, 2), st.integers(0, 40), st.integers(0, 3)),
        min_size=1,
        max_size=80,
    )
)
def test_any_readings(spark, readings):
    check(spark, readings, span=6)


@pytest.mark.parametrize("span", [4, 16, 1000])
def test_missing_cycles_ids_and_values(spark, span):
    """NULL cycles, ids and values, and many readings at one cycle, in every plan."""
    rng = random.Random(11)
    pick = lambda *values: rng.choice(values)
    readings = [(pick(1, 2, None), pick(None, *range(20)), pick(None, 1, 2, 3)) for _ in range(150)]
    readings += [(1, 5, rng.randint(0, 90)) for _ in range(120)]
    readings += [(None, None, rng.randint(0, 5)) for _ in range(40)]
    check(spark, readings, span=span)


def test_shape(spark):
    df = table(spark, [(1, c, 0) for c in range(25)] + [(2, 3, 0)] * 14)
    assert measure_series(df, span=10) == SeriesShape(last_block=2, fullest_block=14)
    assert measure_series(df.limit(0), span=10) == SeriesShape(0, 0)


@pytest.mark.parametrize("shape", [SeriesShape(3, 10), SeriesShape(3, 99)])
def test_a_larger_shape_is_only_slower(spark, shape):
    df = table(spark, [(1, c, c * 7 % 5) for c in range(1, 9)])
    assert results(series_windows(df, COLUMNS, REACH, shape, span=10)) == plain(df, 10)
