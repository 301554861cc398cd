"""Comparison of periods, shares and classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import percent_of
from tallyloom.functions.text import percent_text


def period_change(counts: DataFrame, keys: Sequence[str], period: str, measure: str) -> DataFrame:
    """Change against the previous period of the same key, in whole percent.

    The first period, and one that follows a zero, has no change. ``counts`` is already aggregated, so
    each window holds one row per period.
    """
    order = Window.partitionBy(*keys).orderBy(period)
    with_previous = counts.withColumn("previous", F.lag(measure).over(order))
    change = percent_of(F.col(measure) - F.col("previous"), F.col("previous"))
    return with_previous.withColumn("change", percent_text(change))


def class_summary(df: DataFrame, flag: str, value: str, weight: str) -> DataFrame:
    """Mean value, total weight and row count of both classes; an absent class gives zeros."""
    grouped = df.groupBy(flag).agg(
        F.avg(F.coalesce(F.col(value), F.lit(0.0))).alias("mean_value"),
        F.sum(F.coalesce(F.col(weight), F.lit(0))).alias("total_weight"),
        F.count(F.lit(1)).alias("n"),
    )
    both = df.sparkSession.createDataFrame([(True,), (False,)], f"{flag} boolean")
    # Three rows at most: true, false and unknown.
    return both.join(F.broadcast(grouped), flag, "left").na.fill(0, ["mean_value", "total_weight", "n"])


def class_trend(df: DataFrame, flag: str, period: str, value: str) -> DataFrame:
    """Mean value per class and period."""
    return df.groupBy(flag, period).agg(F.avg(value).alias("mean_value"))


def class_totals(df: DataFrame, flag: str, period: str, weight: str) -> DataFrame:
    """Total weight per class and period, in period order."""
    return df.groupBy(flag, period).agg(F.sum(weight).alias("total")).orderBy(flag, period)
