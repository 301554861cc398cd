"""Grouped aggregates.

Each is a single ``groupBy`` whose partial step runs before the shuffle, so a key that holds a third of
the rows still arrives at its final task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.ranks import ordered_rank
from tallyloom.plans.sizing import lookup_join

Names = Sequence[str]


def sum_by(df: DataFrame, keys: Names, value: str | Column, name: str = "total") -> DataFrame:
    """Sum of a measure by key; integers are summed in 64 bits."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def avg_by(df: DataFrame, keys: Names, value: str | Column, unit: str, name: str = "mean") -> DataFrame:
    """Mean per record by key, with a two-decimal label."""
    grouped = df.groupBy(*keys).agg(F.avg(value).alias(name))
    return grouped.withColumn("label", F.format_string(f"%.2f {unit}", F.col(name)))


def two_measures_by(df: DataFrame, keys: Names, first: str, second: str) -> DataFrame:
    """Totals of two measures by key, rendered as one text, and their correlation over the records."""
    grouped = df.groupBy(*keys).agg(
        F.sum(first).alias("first_total"),
        F.sum(second).alias("second_total"),
        F.corr(F.col(first).cast("double"), F.col(second).cast("double")).alias("correlation"),
    )
    label = F.format_string(f"{first}: %s, {second}: %s", F.col("first_total"), F.col("second_total"))
    return grouped.withColumn("label", label)


def count_by(df: DataFrame, keys: Names, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def word_rows(df: DataFrame, tokens: Column, min_length: int = 1, drop: Sequence[str] = ()) -> DataFrame:
    """One row per word of at least ``min_length`` characters that is not in ``drop``; never an empty one.

    Words are filtered after the explode, where the test is compiled, not inside the array.
    """
    found = df.select(F.explode(tokens).alias("word")).where(F.length("word") >= max(1, min_length))
    return found.where(~F.col("word").isin(*drop)) if drop else found


def minmax_by(df: DataFrame, keys: Names, values: Names) -> DataFrame:
    """Largest and smallest of several columns by key."""
    aggs = [f(v).alias(f"{p}_{v}") for v in values for p, f in (("max", F.max), ("min", F.min))]
    return df.groupBy(*keys).agg(*aggs)


def avg_gap_by(df: DataFrame, keys: Names, cost: Column, price: Column) -> DataFrame:
    """Mean of two columns by key and the difference of the means."""
    grouped = df.groupBy(*keys).agg(F.avg(cost).alias("avg_cost"), F.avg(price).alias("avg_price"))
    return grouped.withColumn("profit", F.col("avg_price") - F.col("avg_cost"))


def count_true_by(df: DataFrame, keys: Names, flag: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.col(flag).cast("bigint")).alias(name))


def stats_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, total and mean by key; blank keys are left out."""
    return (
        df.where(F.length(F.trim(key)) > 0)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    )


def spread_by(df: DataFrame, key: str, value: str, name: str = "stddev") -> DataFrame:
    """Population standard deviation by key, in one pass."""
    return df.groupBy(key).agg(F.stddev_pop(value).alias(name), F.count(value).alias("n"))


def mean_of_means(df: DataFrame, keys: Names, period: str, value: str, weight: str) -> DataFrame:
    """Mean over periods of the mean within each period."""
    inner = df.groupBy(*keys, period).agg(F.avg(value).alias("_v"), F.avg(weight).alias("_w"))
    return inner.groupBy(*keys).agg(F.avg("_v").alias("mean_value"), F.avg("_w").alias("mean_weight"))


def distinct_by(df: DataFrame, keys: Names, values: Mapping[str, str]) -> DataFrame:
    """Distinct counts by key; ``values`` maps result name to column."""
    return df.groupBy(*keys).agg(*[F.countDistinct(c).alias(n) for n, c in values.items()])


def join_after_sum(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, keep: Names, measure: Column, name: str
) -> DataFrame:
    """Aggregate by a foreign key first, then look up the describing columns.

    The join sees one row per key rather than one per fact, whatever the skew of the key.
    """
    totals = facts.groupBy(F.col(fact_key).alias(dim_key)).agg(measure.alias(name))
    return lookup_join(totals, dim.select(dim_key, *keep), [dim_key])


def indicators(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per listed value."""
    return [(F.col(column) == v).cast("int").alias(f"{prefix}{v}") for v in values]


def indicator_totals(df: DataFrame, prefix: str) -> DataFrame:
    """Number of ones in every column whose name starts with ``prefix``, one row per column."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    wide = df.agg(*[F.sum(F.col(f"`{c}`").cast("bigint")).alias(c) for c in columns])
    return wide.unpivot([], [f"`{c}`" for c in columns], "indicator", "total")


def indicator_matrix(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Sum of every indicator column by group."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    return df.groupBy(key).agg(*[F.sum(F.col(f"`{c}`").cast("bigint")).alias(c) for c in columns])


def pivot_wide(df: DataFrame, index: str, columns: str, values: Sequence, measure: Column) -> DataFrame:
    """Long to wide with the wide columns listed, so no extra pass has to discover them."""
    return df.groupBy(index).pivot(columns, list(values)).agg(measure)


def null_profile(df: DataFrame) -> DataFrame:
    """Type, filled and missing cells of every column, from one pass; one row per column."""
    aggs = []
    for c in df.columns:
        aggs += [F.count(f"`{c}`").alias(f"n_{c}")]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"),
            F.col(f"n_{c}").alias("filled"), (F.col("_rows") - F.col(f"n_{c}")).alias("missing"),
        )
        for c, t in df.dtypes
    ]
    return wide.select(F.inline(F.array(*entries)))


def collect_pages(df: DataFrame, keys: Names, value: str, page: int = 1000) -> DataFrame:
    """All values of each key in order, as lists of at most ``page`` items, numbered by ``part``.

    A key of any size thus becomes bounded rows instead of one unbounded list. Positions come from counts per
    range of values, so a heavy key is sorted by several tasks, with the same pages at every size. ``df``
    should be stored or cheap, since it is read more than once.
    """
    keys = list(keys)
    placed = ordered_rank(df.select(*keys, value), keys, [value], "_place")
    return (
        placed.withColumn("part", F.floor(F.col("_place") / page).cast("bigint"))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(value)).alias(f"{value}_list"))
    )
