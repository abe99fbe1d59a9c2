"""Turn a time-stamped event feed into numbered sensor readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.schema import BRONZE_SCHEMA, KEY, SENSORS


PERIODS = ("day", "hour", "minute", "second", "millisecond", "microsecond")
LIMIT = 1_000_000


def _with_period(df: DataFrame, time: str, period: str) -> DataFrame:
    return df.withColumn("__period", F.date_trunc(period, F.col(time)))


def finest_period(df: DataFrame, time: str = "ts", limit: int = LIMIT) -> str | None:
    """The coarsest period in which no series has more than ``limit`` rows.

    None if whole series are that small. Each try is one aggregate over the key
    columns and brings one number to the driver; ordinary feeds need one try.
    Rows without a time are one period at any granularity and count for the
    whole series only. Where even a microsecond is crowded, that is the period.
    """
    for period in (None, *PERIODS):
        placed = df if period is None else _with_period(df.filter(F.col(time).isNotNull()), time, period)
        place = KEY if period is None else (*KEY, "__period")
        rows = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (rows or 0) <= limit:
            return period
    return PERIODS[-1]


def _id_range(column: str, bits: int) -> Column:
    return F.shiftright(F.col(column).cast("long"), bits)


def _widest_range(crowd: DataFrame, column: str, limit: int) -> int | None:
    """The width, as a power of two, of ranges of whole numbers with at most ``limit`` rows each.

    ``crowd`` has rows that only this column orders, as (series, period). None
    if the periods are small enough; 0 also where single numbers are not: such
    rows are equal in the whole order.
    """
    for bits in (None, *range(60, -1, -4)):
        place = [*KEY, "__period"] if bits is None else [*KEY, "__period", _id_range(column, bits)]
        rows = crowd.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (rows or 0) <= limit:
            return bits
    return 0


def number_readings(
    df: DataFrame, order: Sequence[str] = ("ts", "event_id"), limit: int = LIMIT
) -> DataFrame:
    """Number the rows of each series 1, 2, ... in time order, as ``cycle``.

    Small series are ranked by one window. Otherwise rows are ranked inside
    (series, period) and shifted by the number of rows in earlier periods,
    known from a count table, which spreads a long series over many tasks. Rows
    without a time or an id are numbered like others, null times first. Rows of
    one time, or without one, that are still too many are ranked inside ranges
    of the next order column, a whole number.
    """
    period = finest_period(df, order[0], limit)
    if period is None:
        rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))
        return df.withColumn("cycle", rank)
    place = [*KEY, "__period"]
    placed = _with_period(df, order[0], period)
    if len(order) > 1:
        alone = F.lit(True) if period == PERIODS[-1] else F.col(order[0]).isNull()
        bits = _widest_range(placed.filter(alone), order[1], limit)
        if bits is not None:
            placed = placed.withColumn("__range", F.when(alone, _id_range(order[1], bits)).otherwise(0))
            place.append("__range")
    earlier = (
        Window.partitionBy(*KEY)
        .orderBy(*place[len(KEY) :])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n")
    )
    rank = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
    offsets = offsets.select(*(F.col(c).alias(f"{c}__") for c in place), "__before")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"{c}__")) for c in place))
    return (
        placed.withColumn("__rank", rank)
        .join(offsets, same)
        .withColumn("cycle", (F.col("__before") + F.col("__rank")).cast("int"))
        .select(*df.columns, "cycle")
    )


def events_as_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings derived from the ``events`` table, one per event.

    Users stand for engines of four datasets; the value and the number inside
    ``props`` stand for sensors. Engine ids repeat across datasets.
    """
    events = spark.read.parquet(path).select("event_id", "ts", "user_id", "value", "props")
    last_user = events.agg(F.max("user_id")).scalar()
    keyed = events.withColumns(
        {
            "dataset_id": F.expr("concat('FD00', user_id % 4 + 1)"),
            "engine_id": F.expr("cast(user_id div 12 + 1 as int)"),
            "__rare": (F.col("user_id") >= last_user - 3) & (F.col("event_id") % 5 == 0),
        }
    )
    number = F.get_json_object("props", "$.k").cast("double")
    event = F.col("event_id")
    sensors = {name: F.col("value") + float(name[-2:]) for name in SENSORS}
    sensors |= {
        "sensor_01": F.lit(518.67),
        "sensor_02": F.col("value"),
        "sensor_03": F.when(event % 97 != 0, F.col("value") + 100.0),
        "sensor_04": F.col("k"),
        "sensor_07": F.col("value") + 500.0,
        "sensor_11": F.col("k") / 2.0 + 40.0,
    }
    settings = {
        "op_setting_1": (event % 6).cast("double") * 7.0
        + (event % 9 - 4).cast("double") / 1000.0,
        "op_setting_2": F.when(F.col("__rare"), 9.0).otherwise((event % 6).cast("double") / 10.0),
        "op_setting_3": F.lit(100.0),
    }
    columns = {**settings, **sensors}
    numbered = number_readings(keyed.withColumn("k", number))
    names = [f.name for f in BRONZE_SCHEMA.fields if f.name != "load_timestamp"]
    return numbered.select(*(columns[n].alias(n) if n in columns else n for n in names))
