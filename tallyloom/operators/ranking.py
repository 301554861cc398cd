"""Top-k, arg-max and thresholds. Every order ends in a unique key, so ties never depend on the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.durable import written
from tallyloom.plans.sizing import SMALL_ROWS, settled


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows: each task keeps k rows and only those are merged."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their rank.

    Catalyst limits each group before the shuffle as well, so a heavy group sends k rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def arg_max_per_group(df: DataFrame, keys: Sequence[str], measure: str, item: str) -> DataFrame:
    """The item with the largest measure of each group; among equals the smallest item. No sort."""
    best = F.min(F.struct((-F.col(measure)).alias("m"), F.col(item).alias("i")))
    return (
        df.groupBy(*keys).agg(best.alias("_best"))
        .select(*keys, F.col("_best.i").alias(item), (-F.col("_best.m")).alias(measure))
    )


def top_and_bottom(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The k largest and the k smallest rows, told apart by ``side``."""
    top = top_k(df, [F.col(measure).desc(), F.col(key)], k).withColumn("side", F.lit("top"))
    bottom = top_k(df, [F.col(measure), F.col(key).desc()], k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def nth_largest(df: DataFrame, measure: str, n: int) -> DataFrame:
    """The n-th largest value as a one-row frame; the smallest value when there are fewer rows."""
    return df.select(measure).orderBy(F.col(measure).desc()).limit(n).agg(F.min(measure).alias("threshold"))


def at_or_above_nth(df: DataFrame, measure: str, n: int, flag: str = "selected") -> DataFrame:
    """Mark every row whose measure reaches the n-th largest value; ties are all marked."""
    threshold = nth_largest(df, measure, n).scalar()
    return df.withColumn(flag, F.col(measure) >= threshold)


def running_total(
    df: DataFrame, order: Sequence[str], value: str, out: str = "running", max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Running sum of ``value`` over all rows in the given order, which must be unique.

    A frame of at most ``max_rows`` rows is summed by one window. A larger one is sorted into ranges, stored
    with its range numbers (they would differ between evaluations), and each range starts from the total
    of the ranges before it.
    """
    local = settled(df, max_rows)
    if local is not None:
        window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return local.withColumn(out, F.sum(value).over(window))
    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: the number of shuffle partitions bounds it.
    starts = (
        ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(out, F.col("_start") + F.sum(value).over(within))
        .drop("_range", "_start")
    )
