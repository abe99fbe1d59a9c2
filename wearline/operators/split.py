"""Train/test split by engine: a series is never on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearline import schema as S

# Engine ids are 32-bit, so ranking by the upper and then the lower 16 bits
# bounds each window below at 65,536 rows per dataset.
HALF = 16


def split_cuts(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Per dataset: number of engines, of train engines, and the last train engine id.

    The first ``int(engines * fraction)`` ids in order train. The id at that
    rank is found in two steps, by counting the ids per upper half and ranking
    only inside the half that holds the cut, so the engines of a dataset are
    never sorted in one task. ``last_train`` is NULL where no engine trains.
    """
    engines = (
        df.select(*S.KEY)
        .distinct()
        .filter(F.col("engine_id").isNotNull())
        .withColumn("half", F.shiftright("engine_id", HALF))
    )
    in_dataset = Window.partitionBy("dataset_id")
    halves = (
        engines.groupBy("dataset_id", "half")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "engines": F.sum("n").over(in_dataset),
                "upto": F.sum("n").over(
                    in_dataset.orderBy("half").rowsBetween(Window.unboundedPreceding, 0)
                ),
            }
        )
        .withColumn("train_engines", F.floor(F.col("engines") * F.lit(float(fraction))))
    )
    cut_half = halves.filter("upto - n < train_engines AND train_engines <= upto").select(
        "dataset_id", "half", (F.col("train_engines") - F.col("upto") + F.col("n")).alias("rank")
    )
    last = (
        engines.join(cut_half, ["dataset_id", "half"])
        .withColumn("place", F.row_number().over(in_dataset.orderBy("engine_id")))
        .filter("place = rank")
        .select("dataset_id", F.col("engine_id").alias("last_train"))
    )
    sizes = halves.select("dataset_id", "engines", "train_engines").distinct()
    return sizes.join(last, "dataset_id", "left")


def mark_split(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``is_train`` by comparing the engine id with its dataset's cut.

    One row per dataset is looked up; pass a written table so that its measured
    size decides about the broadcast.
    """
    return df.join(cuts.select("dataset_id", "last_train"), "dataset_id", "left").withColumn(
        "is_train", F.coalesce(F.col("engine_id") <= F.col("last_train"), F.lit(False))
    ).drop("last_train")


def engine_split(df: DataFrame, cuts: DataFrame | None = None, fraction: float = 0.8) -> DataFrame:
    """The split as a table: one row per series."""
    cuts = split_cuts(df, fraction) if cuts is None else cuts
    engines = df.select(*S.KEY).distinct().filter(F.col("engine_id").isNotNull())
    return mark_split(engines, cuts).select(*S.KEY, "is_train")


def rows_of(df: DataFrame, engines: DataFrame) -> DataFrame:
    """Rows of the listed series. Any table with the key columns serves as the list."""
    return df.join(engines.select(*S.KEY), list(S.KEY), "left_semi")


TRAIN, TEST, NEITHER = "train", "test", "neither"


def mark_split_fixed(
    df: DataFrame,
    train: tuple[int, int] = (1, 80),
    test: tuple[int, int] = (81, 100),
    dataset_id: str | None = None,
) -> DataFrame:
    """Add ``part`` by two inclusive id ranges, of one dataset or of all.

    Rows of other datasets and ids in neither range stay, marked ``neither``.
    """
    engine = F.col("engine_id")
    of = F.lit(True) if dataset_id is None else F.col("dataset_id").eqNullSafe(F.lit(dataset_id))
    part = F.when(of & engine.between(*train), TRAIN).when(of & engine.between(*test), TEST)
    return df.withColumn("part", part.otherwise(NEITHER))


def engine_split_fixed(df: DataFrame, *ranges: tuple[int, int], dataset_id: str | None = None) -> DataFrame:
    """The fixed split as a table: one row per series, also of those in neither part."""
    return mark_split_fixed(df.select(*S.KEY), *ranges, dataset_id=dataset_id).distinct()
