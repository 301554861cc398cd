"""Positions of rows within their key when one key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.durable import written


def ordered_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the row's position, from 0, among the rows of its keys by ``order``."""
    return ordered_sum(df, keys, order, F.lit(1).cast("long"), name)


def ordered_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``size`` over the earlier rows of the same keys by ``order``.

    Rows are range-partitioned by (keys, order), so a key with very many rows spans several partitions; totals
    per key and partition give each partition its start. ``df`` should be stored or cheap, as its
    ranges are sampled first. Rows that ``order`` leaves tied have any order among themselves.
    """
    keys, order = list(keys), list(order)
    sized = df.withColumn("_size", size)
    cut = written(sized.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*keys, "_range").agg(F.sum("_size").alias("_sum"))
    first = F.coalesce(F.sum("_sum").over(before), F.lit(0))
    # Only keys that go on from an earlier range start behind 0: at most one per range, so the rows need no shuffle for them.
    firsts = counts.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_in"), first.alias("_first")
    ).where("_first <> 0")
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("_range") == F.col("_in"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(F.broadcast(firsts), same, "left")
        .withColumn(name, F.coalesce(F.col("_first"), F.lit(0)) + F.col("_inside"))
        .drop("_range", "_in", "_inside", "_size", "_first", *[f"_key{i}" for i in range(len(keys))])
    )
