"""Mergeable moments: count, mean and squared distances of a column, per group.

Moments of two sets of rows give those of both without reading the rows again.
Least and greatest values come along, so that a constant column stays exactly
constant after any number of merges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n", "mean", "m2", "low", "high")


def named(column: str, field: str) -> str:
    return f"{column}__{field}"


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on columns of both sides in which NULL equals NULL."""
    other = {c: f"__right_{c}" for c in on}
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(n)) for c, n in other.items()))
    return left.join(right.withColumnsRenamed(other), same, how).drop(*other.values())


def moments(df: DataFrame, by: Sequence[str], columns: Sequence[str], *more: Column) -> DataFrame:
    """Moments of the columns per group, and any further aggregates; combined on the map side."""
    found = []
    for c in columns:
        n = F.count(c)
        parts = (n, F.avg(c), F.var_pop(c) * n, F.min(c), F.max(c))
        found += [part.alias(named(c, field)) for field, part in zip(FIELDS, parts)]
    return df.groupBy(*by).agg(*found, *more)


def merge(parts: DataFrame, by: Sequence[str], columns: Sequence[str], *more: Column) -> DataFrame:
    """Moments of groups from the moments of their parts, in two aggregates over the parts.

    The squared distances are those inside the parts plus those of the parts'
    means to the common mean, so nothing is lost to cancellation.
    """
    totals = []
    for c in columns:
        n, mean = F.col(named(c, "n")), F.col(named(c, "mean"))
        low, high = F.min(named(c, "low")), F.max(named(c, "high"))
        common = F.when(low == high, low).otherwise(F.try_divide(F.sum(n * mean), F.sum(n)))
        totals += [F.sum(n).alias(named(c, "n")), common.alias(named(c, "mean"))]
        totals += [low.alias(named(c, "low")), high.alias(named(c, "high"))]
    merged = parts.groupBy(*by).agg(*totals, *more)
    centres = merged.select(*by, *(F.col(named(c, "mean")).alias(f"{c}__centre") for c in columns))
    spread = []
    for c in columns:
        apart = F.col(named(c, "mean")) - F.col(f"{c}__centre")
        spread.append(F.sum(F.col(named(c, "m2")) + F.col(named(c, "n")) * apart * apart).alias(named(c, "m2")))
    squares = join_same(parts, centres, by).groupBy(*by).agg(*spread)
    return join_same(merged, squares, by)


def mean(column: str) -> Column:
    return F.col(named(column, "mean"))


def deviation(column: str, sample: bool = False) -> Column:
    """Population or sample deviation; a sample of one has none, a constant column has 0."""
    n, m2 = F.col(named(column, "n")), F.col(named(column, "m2"))
    constant = F.col(named(column, "low")) == F.col(named(column, "high"))
    found = F.when(constant, 0.0).otherwise(F.sqrt(F.try_divide(m2, n - 1 if sample else n)))
    return F.when(n > (1 if sample else 0), found)
