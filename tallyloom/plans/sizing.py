"""Broadcasts that are only made after their size has been checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.durable import written
from tallyloom.plans.skew import spread_join

# Rows and bytes a summary (one row per class, bin or column) may have before it stops counting as small.
SMALL_ROWS = 50_000
SMALL_BYTES = 8 << 20


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own upper estimate of a frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's automatic broadcast threshold in bytes (0 when switched off)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.rstrip("b")
    scale = units.get(digits[-1:], 1)
    return max(0, int(digits.rstrip("kmg")) * scale)


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", spread: bool = False
) -> DataFrame:
    """Join ``fact`` to a dimension, ``dim`` being close to a plain scan so that its size estimate holds.

    A dimension whose estimated size is under the session's threshold is broadcast, so the fact side is
    not shuffled at all. A larger one is joined by key. ``spread`` then deals the heavy keys of the fact
    side out explicitly, which counts its keys first: right for raw rows, needless for rows that were
    made distinct or aggregated by the key before, whose remaining skew run-time splitting can handle.
    """
    if plan_bytes(dim) <= broadcast_limit(dim):
        return fact.join(F.broadcast(dim), list(on), how)
    return spread_join(fact, dim, on, how) if spread else fact.join(dim, list(on), how)


def settled(summary: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """Evaluate a summary and return it as a local frame, or None when it exceeds ``max_rows`` or SMALL_BYTES."""
    table = summary.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > SMALL_BYTES:
        return None
    return summary.sparkSession.createDataFrame(table, schema=summary.schema)


class Summary:
    """A per-key summary that several joins share; it is evaluated once, when made.

    One of at most ``max_rows`` rows is broadcast by every join. A larger one is stored, so that no join
    evaluates it again, and joined by key with the heavy keys of the other side spread out.
    """

    def __init__(self, summary: DataFrame, max_rows: int = SMALL_ROWS):
        local = settled(summary, max_rows)
        self.small = local is not None
        self.frame = local if local is not None else written(summary, "summary")

    def join_to(self, rows: DataFrame, on: Sequence[str], how: str = "inner", distinct: bool = False) -> DataFrame:
        """Join ``rows`` to the summary, or with ``distinct`` to its distinct keys."""
        side = self.frame.select(*on).distinct() if distinct else self.frame
        if self.small:
            return rows.join(F.broadcast(side), list(on), how)
        return spread_join(rows, side, on, how)


def summary_join(rows: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach a per-key summary that no other join needs."""
    return Summary(summary).join_to(rows, on, how)
