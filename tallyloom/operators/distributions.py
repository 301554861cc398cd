"""Histograms, quantiles and correlation: the tables behind exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.passes import sums_by_slot
from tallyloom.plans.ranks import ordered_sum
from tallyloom.plans.sizing import Summary, summary_join

# Accuracy of the sketch that narrows an exact quantile down.
ACCURACY = 10_000
# Partitions to expect when it is decided whether the driver or Spark adds up the matrices of a correlation.
SLOTS = 1_024


def _cell(value, low, high, cells: int):
    """Index of the equal-width cell of ``value``; the last cell is closed on the right."""
    position = F.floor(F.try_divide((value - low) * cells, high - low))
    return F.least(F.coalesce(position, F.lit(0)), F.lit(cells - 1)).cast("int")


def density_histogram(df: DataFrame, label: str, value: str, bins: int = 50) -> DataFrame:
    """Histogram over shared bins, each class scaled to area 1. Empty bins are not listed."""
    rows = df.where(F.col(value).isNotNull())
    span = rows.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = F.col("_span.low"), F.col("_span.high")
    counts = (
        rows.select(label, value, span.alias("_span"))
        .select(label, _cell(F.col(value), low, high, bins).alias("bin"), (high - low).alias("_width"))
        .groupBy(label, "bin").agg(F.count(F.lit(1)).alias("n"), F.max("_width").alias("_width"))
    )
    per_label = F.sum("n").over(Window.partitionBy(label))
    return counts.select(
        label, "bin", "n", F.try_divide(F.col("n") * bins, per_label * F.col("_width")).alias("density")
    )


def scatter_bins(df: DataFrame, label: str, x: str, y: str, bins: int = 20) -> DataFrame:
    """A scatter plot at scale: points per class and cell of a square grid."""
    span = df.agg(F.struct(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    )).scalar()
    cells = df.select(label, x, y, span.alias("_span")).select(
        label,
        _cell(F.col(x), F.col("_span.x0"), F.col("_span.x1"), bins).alias("x_bin"),
        _cell(F.col(y), F.col("_span.y0"), F.col("_span.y1"), bins).alias("y_bin"),
    )
    return cells.groupBy(label, "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, key: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Interpolated quantiles of ``value`` by ``key``, one column ``q0``, ``q1``… per share.

    A sketch of bounded size brackets each quantile of each key; its rank error is at most 1 / ACCURACY,
    and the bracket allows for three times that. Values below a bracket are only counted. The few inside
    are grouped by value and counted up over ranges of values, so no key is ever sorted or gathered as a whole
    and no bracket ends up in one task.
    """
    rows = df.select(key, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    margin = 3.0 / ACCURACY
    edges = [e for s in shares for e in (max(0.0, s - margin), min(1.0, s + margin))]
    sketch = Summary(rows.groupBy(key).agg(
        F.percentile_approx("_v", edges, ACCURACY).alias("_edges"), F.count(F.lit(1)).alias("_rows")
    ))
    v = F.col("_v")
    low, high = ([F.col("_edges")[2 * i + side] for i in range(len(shares))] for side in (0, 1))
    placed = sketch.join_to(rows, [key])
    below = placed.groupBy(key, "_rows").agg(
        F.array(*[F.count_if(v < low[i]) for i in range(len(shares))]).alias("_below")
    )
    within = [(v >= low[i]) & (v <= high[i]) for i in range(len(shares))]
    brackets = F.array(*[F.when(w, F.lit(i)) for i, w in enumerate(within)])
    inside = ordered_sum(
        placed.where(reduce(or_, within)).select(key, "_v", F.explode(F.array_compact(brackets)).alias("_q"))
        .groupBy(key, "_q", "_v").agg(F.count(F.lit(1)).alias("_n")),
        [key, "_q"], ["_v"], F.col("_n"), "_before",
    )
    # The interpolated quantile lies between the values of two neighbouring ranks.
    position = (F.col("_rows") - 1) * F.array(*[F.lit(float(s)) for s in shares])[F.col("_q")]
    first = F.col("_before") + F.col("_below")[F.col("_q")]
    last = first + F.col("_n")

    def at(rank) -> Column:
        return F.max(F.when((rank >= first) & (rank < last), v))

    weight = position - F.floor(position)
    picked = (
        summary_join(inside, below, [key])
        .withColumn("_w", weight)
        .groupBy(key, "_q", "_w").agg(at(F.floor(position)).alias("_lo"), at(F.ceil(position)).alias("_hi"))
        .withColumn("_value", F.col("_lo") + F.col("_w") * (F.col("_hi") - F.col("_lo")))
    )
    return picked.groupBy(key).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(f"q{i}") for i in range(len(shares))]
    )


def approx_quantiles(df: DataFrame, key: str, value: str, shares: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """As :func:`exact_quantiles`, from one aggregate with a bounded sketch per key."""
    sketch = F.percentile_approx(value, list(shares), accuracy).alias("_q")
    return df.groupBy(key).agg(sketch).select(key, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(shares))])


def box_stats(df: DataFrame, key: str, value: str, exact: bool = True) -> DataFrame:
    """Quartiles, whisker ends (the outermost values within 1.5 interquartile ranges) and outliers by class."""
    quantiles = exact_quantiles if exact else approx_quantiles
    boxes = quantiles(df, key, value, [0.25, 0.5, 0.75]).select(
        key, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    v, reach = F.col(value), 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    return (
        summary_join(df.select(key, value).where(v.isNotNull()), boxes, [key])
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def column_spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample standard deviation of several columns, one row per column."""
    wide = df.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "stddev")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns in long form, from a single pass."""
    names = list(columns)
    d = len(names)
    # Centred by the means, so that nothing cancels; a missing cell becomes NaN and is left out pair by pair.
    means = df.agg(*[F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(f"_{i}") for i, c in enumerate(names)]).first()
    cells = [F.coalesce(F.col(c).cast("double") - F.lit(means[i]), F.lit(float("nan"))) for i, c in enumerate(names)]

    def sums(blocks):
        found = np.zeros((4 * d, d))
        for (x,) in blocks:
            known = ~np.isnan(x)
            x, known = np.where(known, x, 0.0), known.astype(np.float64)
            found += np.concatenate([known.T @ known, x.T @ known, (x * x).T @ known, x.T @ x])
        return found

    rows = df.select(F.array(*cells).alias("v"))
    n, first, squares, products = sums_by_slot(rows, sums, (4 * d, d), SLOTS).reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        # first[i, j] sums column i over the rows that have both columns.
        spread = n * squares - first**2
        r = (n * products - first * first.T) / np.sqrt(spread * spread.T)
    lines = [(a, b, 1.0 if i == j else None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return df.sparkSession.createDataFrame(lines, "a string, b string, r double")
