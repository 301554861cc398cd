"""Distinct counts that roll up: a sketch per fine group is stored once and merged into any coarser one.

The sketches are HyperLogLog of the DataSketches library that Spark has built in. Up to some thousand distinct values
they are all but exact; beyond, the standard error of an estimate is about 1.04 / sqrt(2 ** precision).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16,384 registers: a standard error of 0.8 %.
PRECISION = 14


def standard_error(precision: int = PRECISION) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (precision / 2)


def distinct_sketches(df: DataFrame, keys: Mapping[str, Column], value: str, precision: int = PRECISION) -> DataFrame:
    """One row per combination of ``keys``: its number of rows ``n`` and the ``sketch`` of the values, nulls left out.

    Tasks send partial sketches, so a heavy group costs no more than a small one.
    """
    named = [c.alias(k) for k, c in keys.items()]
    return df.groupBy(*named).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(value, precision).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Rows and estimated distinct values of coarser groups, from the stored sketches alone."""
    named = [c.alias(k) for k, c in keys.items()]
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*named).agg(F.sum("n").alias("n"), merged.alias("distinct"))
