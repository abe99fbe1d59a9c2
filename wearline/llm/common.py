"""Small helpers that several operators share."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of(column: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def fold_of(value: object, folds: int) -> int:
    """The same for one Python value."""
    return zlib.crc32(str(value).encode()) % folds


def pieces(total: int | None, each: int) -> int:
    """Number of parts of about ``each`` units that ``total`` units make; at least one."""
    return max(1, -(-(total or 0) // each))


def scalar(df: DataFrame):
    """The single value of a one-row, one-column aggregate."""
    return df.first()[0]


def spread(parts: Sequence[bytes], numbers: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Ids of texts, from those of their different parts (32-bit), which part comes where, and where texts part."""
    each = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first = np.cumsum(each) - each
    sizes = each[numbers]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(first[numbers] - stops[:-1], sizes) + np.arange(stops[-1])
    ids = np.frombuffer(b"".join(parts), "<u4")[places]
    bounds = stops[edges].tolist()
    return [ids[a:b] for a, b in zip(bounds, bounds[1:])]
