"""Row-frame windows over series of any length.

A plain ``Window.partitionBy(series).orderBy("cycle")`` puts a whole series in
one task. That is the right plan while series are short, and the wrong one when
one engine holds a third of all rows. ``series_windows`` gives the same values
by one of three plans, chosen from a measured shape (two numbers):

* every series fits one block of cycles: the plain window, one exchange;
* longer series: windows per (series, block of cycles). Only the first rows of
  a block look back across its border, so those are computed again on the
  border rows alone (the first and last few rows of each block);
* blocks fuller than their number of cycles, which means repeated cycles: rows
  of such blocks are first collapsed to distinct rows with a copy count, spread
  over cells by cycle and range of content, and multiplied out again after the
  windows.

Rows of the same cycle are ordered by content in all three plans, so they agree
to the row. NULL keys and cycles are values like others.

No task ever orders more than one block, one cell, or the border rows of one
series: with 32-bit cycles and the default span that is at most 32,768 blocks
of ``2 * reach`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearline.schema import KEY
from wearline.workspace import settle

SPAN = 65_536
# Readings of the same cycle are ordered by these: everything the Gold tables show of a reading.
TIES = ("op_setting_1", "op_setting_2", "sensor_02", "sensor_04", "sensor_11")
DERIVED = ("max_cycle", "cycle_pct", "rul")
WindowColumns = Mapping[str, Callable[[WindowSpec], Column]]


@dataclass(frozen=True)
class SeriesShape:
    """Size of the series of a table, in blocks of ``span`` cycles."""

    last_block: int
    fullest_block: int


@dataclass(frozen=True)
class FrameTable:
    """A table made of row frames: what it reads, computes and shows."""

    reads: tuple[str, ...]
    columns: WindowColumns
    reach: int
    show: Callable[[DataFrame], DataFrame]


def _block(span: int) -> Column:
    return F.expr(f"cast(greatest(cycle, 0) div {span} as int)")


def measure_series(df: DataFrame, span: int = SPAN) -> SeriesShape:
    """One aggregate pass over the key columns; brings two numbers to the driver.

    The shape of a table is an upper bound for every subset of its rows.
    """
    blocks = df.groupBy(*KEY, _block(span).alias("block")).agg(F.count(F.lit(1)).alias("n"))
    row = blocks.agg(F.max("block").alias("last"), F.max("n").alias("fullest")).first()
    return SeriesShape(row["last"] or 0, row["fullest"] or 0)


def series_windows(
    df: DataFrame,
    columns: WindowColumns,
    reach: int,
    shape: SeriesShape | None = None,
    span: int = SPAN,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Add window columns per series in cycle order.

    ``columns`` maps a name to a function of the ordered window; its frame must
    reach back at most ``reach`` rows and not forward. Readings with the same
    cycle have no order of their own. They are ordered by content, never by how
    rows happen to be laid out, so a lost and recomputed partition gives the
    same result. ``ties`` names the columns of that order; by default all.
    """
    if shape is None:
        shape = measure_series(df, span)
    others = [c for c in df.columns if c not in (*KEY, "cycle")] if ties is None else list(ties)
    if shape.fullest_block > span:
        return _crowded(df, columns, reach, span, others)
    if shape.last_block == 0:
        window = Window.partitionBy(*KEY).orderBy("cycle", *others)
        return df.withColumns({name: make(window) for name, make in columns.items()})
    blocked = df.withColumns({"__block": _block(span), "__open": F.lit(True)})
    done = _by_levels(
        blocked,
        levels=[("__block",), ()],
        order=["cycle", *others],
        columns=columns,
        reach=reach,
        starts_series=F.col("__block") == 0,
        # Series that end inside the first block have no border to repair. The
        # stored last cycle covers every reading, and the filter reaches the scan.
        has_borders=F.col("max_cycle") >= span if "max_cycle" in df.columns else F.lit(True),
    )
    return done.drop("__block")


def frames_of(
    df: DataFrame,
    tables: Iterable[FrameTable],
    shape: SeriesShape | None = None,
    span: int = SPAN,
) -> DataFrame:
    """The columns of several tables in one pass: one exchange, one sort, one window."""
    tables = list(tables)
    reads = dict.fromkeys(c for t in tables for c in t.reads)
    columns = {name: make for t in tables for name, make in t.columns.items()}
    # The same order for whatever tables are asked for, so that a table has one
    # content whether it is made alone or with others. What depends on the key
    # and the cycle decides nothing.
    given = set(df.columns)
    ties = [c for c in TIES if c in given]
    ties += [c for c in reads if c not in (*TIES, *DERIVED)]
    narrow = df.select(*KEY, "cycle", "max_cycle", *dict.fromkeys((*reads, *ties)))
    return series_windows(narrow, columns, max(t.reach for t in tables), shape, span, ties)


def frame_table(
    df: DataFrame, table: FrameTable, shape: SeriesShape | None = None, span: int = SPAN
) -> DataFrame:
    return table.show(frames_of(df, [table], shape, span))


def _by_levels(
    rows: DataFrame,
    levels: Sequence[tuple[str, ...]],
    order: Sequence[str],
    columns: WindowColumns,
    reach: int,
    starts_series: Column,
    has_borders: Column,
) -> DataFrame:
    """Compute the columns cell by cell, then repair the heads of cells level by level.

    Levels go from fine to coarse and every cell is a contiguous run of its
    series. A row with ``reach`` rows before it in its cell is settled. The
    other rows (heads) stay open and go on to the next level with the last
    ``reach`` rows of each cell. Those border rows are gap-free just before
    every open row, so the same window over them alone gives the same value.
    """
    finished = []
    # Said explicitly: input that already lies by series (after a join on the
    # key, say) would satisfy the window and keep a long series in one task.
    left = rows.repartition(*KEY, *levels[0])
    for depth, level in enumerate(levels):
        window = Window.partitionBy(*KEY, *level).orderBy(*order)
        values = {name: make(window) for name, make in columns.items()}
        if depth == len(levels) - 1:
            finished.append(left.withColumns(values).filter("__open"))
            break
        place = F.row_number().over(window)
        settled = F.col("__place") > reach
        if depth == 0:
            settled = settled | starts_series
        finished.append(
            left.withColumns({**values, "__place": place})
            .filter(F.col("__open") & settled)
            .drop("__place")
        )
        if depth == 0:
            left = rows.filter(has_borders).repartition(*KEY, *level)
        everything = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        left = (
            left.withColumns({"__place": place, "__size": F.count(F.lit(1)).over(everything)})
            .filter((F.col("__place") <= reach) | (F.col("__size") - F.col("__place") < reach))
            .withColumn("__open", F.col("__open") & ~settled)
            .drop("__place", "__size")
        )
    return reduce(DataFrame.unionByName, finished).drop("__open")


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """A join on columns of both sides in which NULL equals NULL."""
    names = {c: f"{c}__right" for c in on}
    renamed = right.withColumnsRenamed(names)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    return left.join(renamed, same, how).drop(*names.values())


def _crowded(
    df: DataFrame, columns: WindowColumns, reach: int, span: int, others: Sequence[str]
) -> DataFrame:
    """The plan for tables with repeated cycles (see the module text).

    Copies beyond ``reach + 1`` see a frame of nothing but copies. One row
    stands for all of them and carries their number in ``__weight``. The lookup
    tables are written, so their size is known where they are joined, and a
    crowded block or cycle is split by adaptive execution where they are large.
    """
    blocked = df.withColumn("__block", _block(span))
    place = [*KEY, "__block"]
    full = blocked.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > span)
    full = settle(full.select(*place), "crowded-blocks")
    calm = _join(blocked, full, place, "left_anti").withColumns(
        {
            "__cell": F.lit(None).cast("int"),
            "__part": F.lit(0),
            "__copy": F.lit(1).cast("long"),
            "__weight": F.lit(1).cast("long"),
        }
    )

    distinct = settle(
        _join(blocked, full, place, "left_semi")
        .groupBy(*df.columns, "__block")
        .agg(F.count(F.lit(1)).alias("__copies")),
        "crowded-rows",
    )
    # A cycle with many different rows is cut into ranges of content, at rows
    # that their hash picks, about one in ``span``.
    content = F.struct(*others) if others else F.struct(F.lit(0))
    sizes = distinct.groupBy(*KEY, "cycle").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > span)
    sizes = settle(sizes.drop("__n"), "crowded-cycles")
    picked = _join(distinct, sizes, [*KEY, "cycle"], "left_semi").filter(
        F.pmod(F.xxhash64(content), F.lit(span)) == 0
    )
    cuts = settle(
        picked.groupBy(*KEY, "cycle").agg(F.sort_array(F.collect_set(content)).alias("__cuts")),
        "content-cuts",
    )
    most = reach + 2
    below = F.size(F.filter(F.coalesce("__cuts", F.array().cast(cuts.schema["__cuts"].dataType)), lambda c: c <= content))
    crowd = (
        _join(distinct, cuts, [*KEY, "cycle"], "left")
        .withColumns(
            {
                "__cell": F.col("cycle"),
                "__part": below,
                "__copy": F.explode(F.sequence(F.lit(1), F.least(F.col("__copies"), F.lit(most)))),
            }
        )
        .withColumn(
            "__weight",
            F.when(F.col("__copy") == most, F.col("__copies") - (most - 1)).otherwise(1),
        )
    )
    rows = calm.unionByName(crowd.select(*calm.columns)).withColumn("__open", F.lit(True))
    done = _by_levels(
        rows,
        levels=[("__block", "__cell", "__part"), ("__block",), ()],
        order=["cycle", *others, "__copy"],
        columns=columns,
        reach=reach,
        starts_series=(F.col("__block") == 0) & F.col("__cell").isNull() & F.col("cycle").isNotNull(),
        has_borders=F.lit(True),
    ).drop("__block", "__cell", "__part", "__copy")

    # Multiply the copies out in pieces, spread over tasks, of at most span rows.
    pieces = (
        done.filter(F.col("__weight") > 1)
        .withColumn("__piece", F.explode(F.expr(f"sequence(0L, (__weight - 1) div {span})")))
        .repartition(*KEY, "cycle", "__piece")
        .withColumn(
            "__row",
            F.explode(F.expr(f"sequence(1L, least({span}L, __weight - __piece * {span}L))")),
        )
        .drop("__weight", "__piece", "__row")
    )
    return done.filter(F.col("__weight") == 1).drop("__weight").unionByName(pieces)
