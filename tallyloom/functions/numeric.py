"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean of several columns of one row, leaving NULLs out; NULL when all are."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, count)


def percent_of(part: Column, whole: Column) -> Column:
    """Whole-number percentage, truncated towards zero; NULL when ``whole`` is NULL or 0."""
    safe = F.when(whole != 0, whole.cast("bigint"))
    return F.call_function("div", part.cast("bigint") * 100, safe)


def norm(vector: Column) -> Column:
    """Euclidean length of an array of numbers."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of equal length."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def stable_hash(seed: int, *cols: Column) -> Column:
    """A 32-bit number that depends only on the seed and the values, equal on every engine with MD5."""
    text = F.concat_ws("-", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
