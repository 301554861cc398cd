"""Train / validation / test splits that depend only on ids and a seed, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import stable_hash
from tallyloom.plans.sizing import Summary, summary_join

SEED = 42
# The 32-bit hash is cut into this many cells to find the cut-off of each class.
CELLS = 65_536


def hashed_part(id_col: str, cuts: Sequence[tuple[str, float]], seed: int = SEED) -> Column:
    """Part of each row by hash alone: shares hold on average, and no row is moved.

    ``cuts`` lists (part, cumulative share); the last share is 1.
    """
    h = stable_hash(seed, F.col(id_col))
    part = F.lit(cuts[-1][0])
    for name, share in reversed(cuts[:-1]):
        part = F.when(h < int(share * 2**32), F.lit(name)).otherwise(part)
    return part


def fold_number(id_col: str, folds: int = 3, seed: int = SEED) -> Column:
    """Cross-validation fold of each row."""
    return F.pmod(stable_hash(seed, F.lit("fold"), F.col(id_col)), F.lit(folds)).cast("int")


def stratified_split(
    df: DataFrame, id_col: str, label: str, cuts: Sequence[tuple[str, int]], seed: int = SEED, out: str = "part"
) -> DataFrame:
    """Exact split of every class: the rows of a class, in hash order, are cut at whole percentages.

    ``cuts`` lists (part, cumulative percent); the last is 100. The hash range is divided into cells and
    rows are counted per class and cell. Only the cell in which a cut falls has its rows ranked, which
    gives the last row before the cut. Those few rows are the cut-offs that every row is compared with,
    so no class is sorted or gathered and the result is a plain projection.
    """
    # Rows without a label are a class of their own.
    named = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    rows = (
        df.withColumn("_class", named).withColumn("_h", stable_hash(seed, F.col(id_col)))
        .withColumn("_cell", F.floor(F.col("_h") / (2**32 // CELLS)).cast("int"))
    )
    keyed = rows.select("_class", "_cell", F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id")).alias("_key"))
    running = Window.partitionBy("_class").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    quotas = F.array(*[
        F.struct(F.lit(i).alias("i"), F.floor(F.col("_rows") * percent / 100).alias("quota"))
        for i, (_, percent) in enumerate(cuts[:-1])
    ])
    start = F.col("_end") - F.col("_n")
    # Per class and cut: the cell that holds the last row before the cut, and that row's rank within it.
    wanted = Summary(
        keyed.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(running))
        .withColumn("_rows", F.sum("_n").over(Window.partitionBy("_class")))
        .select("_class", "_cell", "_end", start.alias("_start"), F.explode(quotas).alias("q"))
        .where((F.col("q.quota") > F.col("_start")) & (F.col("q.quota") <= F.col("_end")))
        .select("_class", "_cell", F.col("q.i").alias("_cut"), (F.col("q.quota") - F.col("_start")).alias("_rank"))
    )
    in_cell = Window.partitionBy("_class", "_cell").orderBy("_key")
    ranked = wanted.join_to(keyed, ["_class", "_cell"], "left_semi", distinct=True).withColumn(
        "_rank", F.row_number().over(in_cell).cast("bigint")
    )
    names = [f"_cut{i}" for i in range(len(cuts) - 1)]
    last_rows = wanted.join_to(ranked, ["_class", "_cell", "_rank"]).groupBy("_class").agg(
        *[F.max(F.when(F.col("_cut") == i, F.col("_key"))).alias(n) for i, n in enumerate(names)]
    )
    key = F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id"))
    part = F.lit(cuts[-1][0])
    for (name, _), cut in reversed(list(zip(cuts, names, strict=False))):
        # A class too small to have a row before the cut has no cut-off.
        part = F.when(F.coalesce(key <= F.col(cut), F.lit(False)), F.lit(name)).otherwise(part)
    return (
        summary_join(rows, last_rows, ["_class"], "left").withColumn(out, part)
        .drop("_h", "_cell", "_class", *names)
    )
