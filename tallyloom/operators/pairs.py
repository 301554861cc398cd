"""Pairs of members that occur in the same group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import collect_pages
from tallyloom.plans.durable import written
from tallyloom.plans.sizing import Summary
from tallyloom.plans.skew import PARTS, heavy_keys

# Members of one group that a single task pairs up; a larger group is cut into blocks of this size.
BLOCK_MEMBERS = 4_000
# Members that one task of the join pairs up; their bytes say little about the memory that the pairs need.
TASK_MEMBERS = 250_000


def member_pairs(
    df: DataFrame, group: str, member: str, carry: Sequence[str] = (), block: int = BLOCK_MEMBERS
) -> DataFrame:
    """Each unordered pair of distinct members of a group, once per group, as ``a < b``.

    ``carry`` names columns that the group determines; they come along.

    The members are joined to themselves on the group. A group with more than ``block`` members is cut
    into blocks by a hash of the member, and each pair of blocks is a join key of its own, so that the
    work on one large group is shared by many tasks. The tasks of the join grow with the rows, which are counted.
    """
    # Filtered here rather than by the join, so that all uses of the members share one shuffle.
    members = df.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(group, member, *carry).distinct()
    blocks = Summary(heavy_keys(members, [group], block))
    n = F.coalesce(F.col(PARTS), F.lit(1))
    tagged = (
        blocks.join_to(members, [group], "left")
        .select(group, member, *carry, n.alias("_n"), F.pmod(F.xxhash64(member), n).cast("int").alias("_own"))
    )
    left = tagged.select(
        group, *carry, F.col(member).alias("_x"), F.col("_own").alias("_i"),
        F.explode(F.sequence(F.col("_own"), F.col("_n") - 1)).alias("_j"),
    )
    right = tagged.select(
        group, F.col(member).alias("_y"), F.col("_own").alias("_j"),
        F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"),
    )
    tasks = -(-df.count() // TASK_MEMBERS)
    if tasks > 1:
        left, right = (side.repartition(tasks, group, "_i", "_j") for side in (left, right))
    return (
        left.join(right, [group, "_i", "_j"])
        .where((F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y")))
        .select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), group, *carry)
    )


def pair_counts(df: DataFrame, group: str, member: str) -> DataFrame:
    """How many groups each pair shares; counted within the tasks of the join before any shuffle."""
    return member_pairs(df, group, member).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def pair_titles(df: DataFrame, group: str, member: str, title: str, page: int = 1000) -> DataFrame:
    """Each pair with the titles of the groups it shares, in sorted lists of at most ``page`` titles.

    ``title`` must be determined by ``group``. A title stays repeated when two groups carry it.
    """
    pairs = written(member_pairs(df, group, member, [] if title == group else [title]), "pairs")
    return collect_pages(pairs, ["a", "b"], title, page).withColumn("n", F.size(f"{title}_list").cast("bigint"))
