"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(df: DataFrame, date: str) -> DataFrame:
    """One row per day between the first and last ``date`` of ``df``.

    A Spark date lies in the years 1 to 9999, so the calendar never exceeds 3.7 million rows and may be
    broadcast whatever the size of ``df``.
    """
    day = F.to_date(date)
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).where(F.col("first").isNotNull())
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(
        "day",
        F.date_format("day", "EEEE").alias("weekday"),
        (F.weekday("day") < 5).alias("working_day"),
    )
