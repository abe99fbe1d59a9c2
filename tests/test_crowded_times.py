"""Numbering of series with more rows of one time, or without a time, than a task ranks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.sources import events


@pytest.mark.parametrize("time", ["cast(null as timestamp)", "timestamp_seconds(5)"])
def test_crowded_times_are_numbered(spark, time):
    df = spark.range(300).select(
        F.lit("FD001").alias("dataset_id"),
        F.expr("cast(id % 2 as int)").alias("engine_id"),
        F.expr(f"if(id % 5 = 0, timestamp_seconds(id * 7919 % 9000), {time})").alias("ts"),
        F.expr("if(id = 7, null, (id - 100) * 37 % 1000)").alias("event_id"),
        F.col("id").alias("row"),
    )
    whole = F.row_number().over(Window.partitionBy(*S.KEY).orderBy("ts", "event_id"))
    expected = set(df.withColumn("cycle", whole).select("row", "cycle").collect())
    for limit in (60, 20, 1):
        numbered = events.number_readings(df, limit=limit)
        assert set(numbered.select("row", "cycle").collect()) == expected
