"""The most frequent values in bounded memory: mergeable summaries name candidates, one recount makes them exact.

The summaries are frequent-item sketches of the DataSketches library that Spark has built in. A sketch of ``tracked``
items knows every count but for an error of at most 3.5 / (map size) of all rows, its map size being the next power of
two from ``tracked`` / 0.75 on; it lists each value whose count exceeds twice that error. So the values that it does
not list have a known bound, and a top k above that bound is proven.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ranking import top_k

# Values a summary tracks; a task holds one summary, some 100 bytes a value.
TRACKED = 20_000


def unlisted_share(tracked: int = TRACKED) -> float:
    """The share of all rows that no value outside the summary's list can exceed."""
    size = 1
    while size * 0.75 < tracked:
        size *= 2
    return 2 * 3.5 / size


def heavy_values(rows: DataFrame, value: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent values: (value, n, proven), ties in order of the value.

    ``rows`` is read twice. The first pass sends one summary per task, never a row per distinct value; the second
    counts the at most ``tracked`` candidates, which go to every task. ``n`` is exact; ``proven`` says that no other
    value can belong here. Where it is false, a larger ``tracked`` or a plain count is needed. Nulls are left out, an
    empty table gives no rows.
    """
    given = rows.where(F.col(value).isNotNull()).select(F.col(value).alias("value"))
    summary = given.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(value, {int(tracked)})").alias("summary"))
    listed = summary.where("rows > 0").select("rows", F.explode(F.expr(f"approx_top_k_estimate(summary, {int(tracked)})")).alias("x"))
    candidates = listed.select("rows", F.col("x.item").alias("value"))
    counted = given.join(F.broadcast(candidates), "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows"))
    most = F.col("rows") * unlisted_share(tracked)
    found = counted.select("value", "n", (F.col("n") > most).alias("proven"))
    return top_k(found, [F.desc("n"), F.col("value")], k).withColumnRenamed("value", value)
