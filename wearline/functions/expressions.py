"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearline import schema as S


def any_of(predicates: Iterable[Column]) -> Column:
    """OR of the predicates under SQL three-valued logic; FALSE for none."""
    return reduce(or_, predicates, F.lit(False))


def any_null(columns: Iterable[str]) -> Column:
    return any_of(F.col(name).isNull() for name in columns)


def any_nan(columns: Iterable[str]) -> Column:
    return any_of(F.isnan(F.col(name)) for name in columns)


def any_nonpositive(columns: Iterable[str]) -> Column:
    return any_of(F.col(name) <= 0 for name in columns)


def rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def cycle_fraction(digits: int = 3) -> Column:
    """Position in life. A series whose last cycle is 0 has no fraction (NULL)."""
    return F.round(
        F.try_divide(F.col("cycle").cast("double"), F.col("max_cycle").cast("double")),
        digits,
    )


def remaining_life() -> Column:
    return F.col("max_cycle") - F.col("cycle")


def capped(column: Column, cap: int | None) -> Column:
    """Upper bound that keeps NULL as NULL (``least`` alone would turn it into the cap)."""
    if cap is None:
        return column
    return F.when(column > cap, F.lit(cap).cast("int")).otherwise(column)


def life_category(last_cycle: Column, long_over: int = 200, medium_over: int = 130) -> Column:
    return (
        F.when(last_cycle > long_over, S.LONG_LIFE)
        .when(last_cycle > medium_over, S.MEDIUM_LIFE)
        .otherwise(S.SHORT_LIFE)
    )


def life_stage(rul: Column, early_over: int = 100, mid_over: int = 30) -> Column:
    return (
        F.when(rul > early_over, S.EARLY_STAGE)
        .when(rul > mid_over, S.MID_STAGE)
        .otherwise(S.LATE_STAGE)
    )


def operating_condition(settings: Iterable[str] = S.SETTINGS[:2], digits: int = 2) -> Column:
    """Label of an operating condition: the rounded settings joined by ``_``.

    Going through DECIMAL drops the sign of a rounded zero, so settings just
    below and just above zero share one label. A missing setting is ``null`` and
    one that is no number ``nan``: labels of their own.
    """
    kind = f"decimal(18,{digits})"

    def part(name: str) -> Column:
        shown = F.round(F.col(name), digits).try_cast(kind).cast("string")
        return F.when(F.isnan(name), "nan").otherwise(F.coalesce(shown, F.lit("null")))

    return F.concat_ws("_", *map(part, settings))


def count_if(predicate: Column) -> Column:
    """Number of rows where the predicate holds; 0 (not NULL) for an empty group."""
    return F.count(F.when(predicate, F.lit(1)))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), digits)
