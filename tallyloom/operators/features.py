"""Feature columns: scaling, vectors, correlated features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import row_mean
from tallyloom.operators.ranking import running_total


def with_derived(df: DataFrame, across: str, up: str, trio: Sequence[str], top: str, base: str) -> DataFrame:
    """Three derived measures: straight-line distance, mean of three columns, and a guarded ratio."""
    return df.withColumns({
        "distance": F.hypot(F.col(across), F.col(up)),
        "trio_mean": row_mean([F.col(c) for c in trio]),
        "ratio": F.try_divide(F.col(top), F.col(base) + 1),
    })


def without_columns(df: DataFrame, names: Sequence[str] = (), prefix: str | None = None) -> DataFrame:
    """Drop listed columns and those whose name starts with ``prefix``."""
    extra = [c for c in df.columns if prefix and c.startswith(prefix)]
    return df.drop(*names, *extra)


def standardise(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """Scale columns to mean 0 and population deviation 1; a constant column becomes 0.

    ``fit_on`` restricts the rows that define mean and deviation (the training part). The statistics are
    a single row, read by the projection as scalar subqueries, so the rows themselves are not shuffled.
    """
    base = df if fit_on is None else df.where(fit_on)
    stats = base.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    packed = stats.select(F.struct(*stats.columns).alias("_s")).scalar()
    staged = df.withColumn("_s", packed)
    scaled = {}
    for c in columns:
        deviation = F.col(f"_s.s_{c}")
        scaled[c] = F.when(deviation == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"_s.m_{c}")) / deviation)
    return staged.withColumns(scaled).drop("_s")


def as_vectors(df: DataFrame, array: str, vector: str = "features") -> DataFrame:
    """An array of numbers as an ML vector."""
    return df.withColumn(vector, array_to_vector(F.col(array).cast("array<double>")))


def vector_moments(df: DataFrame, vector: str = "features") -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and population deviation of each dimension, aggregated in one pass."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(vector))
    count, mean, variance = df.select(summary.alias("s")).select("s.count", "s.mean", "s.variance").first()
    n = int(count)
    population = variance.toArray() * (n - 1) / max(n, 1)
    return n, mean.toArray(), np.sqrt(np.maximum(population, 0.0))


def scale_vectors(df: DataFrame, array: str, mean: np.ndarray, deviation: np.ndarray) -> DataFrame:
    """Standardise an array column dimension by dimension with given statistics."""
    safe = np.where(deviation > 0, deviation, 1.0)
    stats = F.array(*[
        F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(mean, safe, strict=True)
    ])
    scaled = F.zip_with(F.col(array), stats, lambda x, t: (x - t["m"]) / t["s"])
    return df.withColumn(array, scaled)


def keep_dimensions(df: DataFrame, array: str, kept: Sequence[int]) -> DataFrame:
    """Project an array column onto some of its positions."""
    return df.withColumn(array, F.transform(F.array(*[F.lit(int(i)) for i in kept]), lambda i: F.col(array)[i]))


def vector_mean(df: DataFrame, array: str) -> DataFrame:
    """Mean of every position of an array column; partial sums are kept per position before the shuffle."""
    return (
        df.select(F.posexplode(array).alias("pos", "x"))
        .groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    )


def vector_correlation(df: DataFrame, vector: str = "features") -> np.ndarray:
    """Correlation matrix of the dimensions of a vector column, accumulated as d x d sums."""
    return Correlation.corr(df, vector).first()[0].toArray()


def correlated_dimensions(df: DataFrame, vector: str = "features", above: float = 0.95) -> DataFrame:
    """Positions j with \\|corr(i, j)\\| above the limit for some earlier i, with the first such i.

    Only the d x d matrix reaches the driver; its size depends on the number of features alone.
    """
    upper = np.triu(np.abs(np.nan_to_num(vector_correlation(df, vector))) > above, k=1)
    found = [(int(j), int(np.argmax(upper[:, j]))) for j in np.flatnonzero(upper.any(axis=0))]
    return df.sparkSession.createDataFrame(found, "j int, first_i int")


def drop_lowest_share(scores: DataFrame, key: str, score: str, share: float = 0.20) -> DataFrame:
    """Mark the lowest scores that together make up at most ``share`` of the total."""
    total = scores.agg(F.sum(score).alias("total")).scalar()
    running = running_total(scores, [score, key], score)
    return running.withColumn("dropped", F.col("running") <= total * F.lit(str(share)).cast("decimal(9,6)"))
