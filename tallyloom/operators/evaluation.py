"""Scores of classifications and clusterings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows predicted right, overall or by group."""
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (true, predicted) class."""
    return df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus their plain and weighted means and the accuracy.

    The rows are aggregated once, to the confusion matrix; each of its cells then counts towards its true
    and its predicted class, so no join is needed.
    """
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    views = F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), none.alias("found"), hit.alias("right")),
        F.struct(F.col("predicted").alias("c"), none.alias("support"), F.col("n").alias("found"), none.alias("right")),
    )
    per_class = (
        confusion(df, label, predicted).select(F.inline(views))
        .groupBy("c").agg(*[F.sum(x).alias(x) for x in ("support", "found", "right")])
        .select(
            F.col("c").cast("string").alias("class"), "support", "right",
            F.coalesce(F.try_divide("right", "found"), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide("right", "support"), F.lit(0.0)).alias("recall"),
        )
    )
    p, r = F.col("precision"), F.col("recall")
    per_class = per_class.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))
    scores = ("precision", "recall", "f1")
    weight = F.col("support")
    summary = per_class.agg(
        F.sum("support").alias("support"),
        F.struct(*[F.avg(s).alias(s) for s in scores]).alias("macro"),
        F.struct(*[F.try_divide(F.sum(F.col(s) * weight), F.sum(weight)).alias(s) for s in scores]).alias("weighted"),
        F.try_divide(F.sum("right"), F.sum("support")).alias("acc"),
    )
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("class"), *[F.col(f"{field}.{s}").alias(s) for s in scores], F.col("support"))
            for name, field in (("macro avg", "macro"), ("weighted avg", "weighted"))
        ],
        F.struct(F.lit("accuracy").alias("class"), *[F.col("acc").alias(s) for s in scores], F.col("support")),
    )
    return per_class.select("class", *scores, "support").unionByName(summary.select(F.inline(lines)))


def binary_scores(df: DataFrame, label: Column, predicted: Column) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, in one row."""
    counts = df.agg(
        F.count_if(label & predicted).alias("tp"),
        F.count_if(~label & predicted).alias("fp"),
        F.count_if(label & ~predicted).alias("fn"),
        F.count_if(~label & ~predicted).alias("tn"),
    )
    zero = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp", "fp", "fn", "tn",
        F.coalesce(F.try_divide(tp + tn, tp + fp + fn + tn), zero).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def adjusted_rand(df: DataFrame, one: str, other: str) -> DataFrame:
    """Adjusted Rand index of two labelings from their contingency table; 1 when both are trivial.

    Cells, row totals, column totals and the grand total come out of one grouping-sets aggregate.
    """
    cells = df.groupBy(F.col(one).alias("a"), F.col(other).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.cube("a", "b").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    n = F.col("n").cast("double")
    pairs = n * (n - 1) / 2
    totals = levels.agg(*[
        F.sum(F.when(F.col("level") == level, pairs)).alias(name)
        for level, name in ((0, "both"), (1, "rows"), (2, "cols"), (3, "every"))
    ])
    expected = F.coalesce(F.try_divide(F.col("rows") * F.col("cols"), F.col("every")), F.lit(0.0))
    most = (F.col("rows") + F.col("cols")) / 2
    score = F.coalesce(F.try_divide(F.col("both") - expected, most - expected), F.lit(1.0))
    return totals.select(score.alias("adjusted_rand"))


def best_config(results: DataFrame, metric: str, grid_order: Sequence[str], k: int = 1) -> DataFrame:
    """The best k configurations; among equals the one that comes first in the grid."""
    return results.orderBy(F.col(metric).desc(), *grid_order).limit(k)


def elbow(curves: DataFrame, curve: str, x: str, y: str, sensitivity: float = 1.0) -> DataFrame:
    """Elbow of each convex decreasing curve (Satopää et al., "Finding a Kneedle in a Haystack", 2011).

    Both axes are scaled to [0, 1]; the curve's drop below the diagonal is scanned for a local maximum
    that is followed by a fall below its threshold before the next maximum. A curve has one row per
    candidate x, so every window is small. Curves without an elbow are left out.
    """
    whole = Window.partitionBy(curve)
    ordered = Window.partitionBy(curve).orderBy(x)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)

    def scaled(c: str) -> Column:
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        return F.try_divide(F.col(c) - low, high - low)

    points = curves.select(
        curve, F.col(x).alias("_x"), scaled(x).alias("_xn"), (1 - scaled(y)).alias("_yn"), F.col(x)
    ).withColumn("_d", F.col("_yn") - F.col("_xn"))
    gap = F.avg(F.col("_xn") - F.col("_before")).over(whole)
    d, prev, nxt = F.col("_d"), F.col("_prev"), F.col("_next")
    shaped = (
        points.withColumn("_before", F.lag("_xn").over(ordered))
        .withColumn("_prev", F.coalesce(F.lag("_d").over(ordered), d))
        .withColumn("_next", F.lead("_d").over(ordered))
        .withColumn("_step", gap)
    )
    beyond = F.coalesce(nxt, d)
    peak = (d >= prev) & (d >= beyond)
    valley = (d <= prev) & (d <= beyond)
    marked = shaped.select(
        curve, x, "_d", "_next",
        F.when(valley, F.lit(0.0)).when(peak, d - sensitivity * F.abs("_step")).alias("_threshold"),
        F.when(peak, F.col(x)).alias("_peak"),
    )
    scanned = (
        marked.withColumn("_limit", F.last("_threshold", ignorenulls=True).over(so_far))
        .withColumn("_at", F.last("_peak", ignorenulls=True).over(so_far))
        .where(F.col("_at").isNotNull() & (F.col("_next") < F.col("_limit")))
    )
    return scanned.groupBy(curve).agg(F.min_by("_at", x).alias("elbow"))
