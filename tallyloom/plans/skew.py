"""Spreading of heavy keys over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from this many rows on; a heavy key gets one salt per HEAVY_ROWS rows. All heavy keys are
# spread; there are at most rows / HEAVY_ROWS of them, some hundred thousand for 10^11 rows.
HEAVY_ROWS = 1_000_000

SALT = "_salt"
PARTS = "_parts"


def heavy_keys(df: DataFrame, on: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The heavy keys of ``df`` with the number of parts each is to be split into."""
    n = F.col("_rows")
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(n >= heavy_rows)
        .select(*on, F.ceil(n / heavy_rows).cast("int").alias(PARTS))
    )


def _with_parts(df: DataFrame, heavy: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach the number of parts of a row's key, null for ordinary keys; a null key may be heavy as well."""
    named = heavy.select(*[F.col(c).alias(f"_heavy{i}") for i, c in enumerate(on)], PARTS)
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"_heavy{i}"))
    return df.join(F.broadcast(named), same, "left").drop(*[f"_heavy{i}" for i in range(len(on))])


def salted(df: DataFrame, heavy: DataFrame, on: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Add the salt of each row: a stable hash of ``by`` for heavy keys, 0 for all others.

    The salt depends only on the row, so a recomputed task puts every row where it was before.
    """
    parts = F.coalesce(F.col(PARTS), F.lit(1))
    return _with_parts(df, heavy, on).withColumn(SALT, F.pmod(F.xxhash64(*by), parts).cast("int"))


def replicated(df: DataFrame, heavy: DataFrame, on: Sequence[str]) -> DataFrame:
    """Repeat the rows of heavy keys once per salt; all other rows appear once, with salt 0."""
    return (
        _with_parts(df, heavy, on)
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PARTS), F.lit(1)) - 1)))
        .drop(PARTS)
    )


def spread_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Equi-join in which no task receives more than about ``heavy_rows`` fact rows of one key.

    ``how`` may be inner, left, left_semi or left_anti: each fact row meets every match exactly once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    heavy = heavy_keys(fact, on, heavy_rows)
    others = [c for c in fact.columns if c not in on] or on
    left = salted(fact, heavy, on, others).drop(PARTS)
    return left.join(replicated(dim, heavy, on), [*on, SALT], how).drop(SALT)
