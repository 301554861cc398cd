"""Approximate nearest neighbours by signs of random projections.

Every table of hyperplanes through the mean gives a row a string of bits (Charikar, "Similarity Estimation Techniques
from Rounding Algorithms", 2002). Rows that share a prefix share a bucket; a bucket over its limit is split by the
next bits, as often as needed. A query visits, besides its own bucket, those whose bits differ where it is closest
to the hyperplanes (Lv et al., "Multi-Probe LSH", 2007). Only visited rows are compared, by their true distances.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyloom.operators.blocks import matrix, nearest_in_block
from tallyloom.operators.features import vector_mean
from tallyloom.operators.ranking import top_k_per_group
from tallyloom.plans.durable import written
from tallyloom.plans.sizing import Summary

DIGITS = 9
# Bits by which a bucket is split at a time, and bits of a signature.
STEP, BITS = 4, 60


@dataclass(frozen=True)
class Projections:
    """``tables`` sets of hyperplanes, ``probes`` buckets visited per set and level, ``limit`` distinct vectors a bucket.

    More tables and probes find more of the true neighbours; the work per query is at most
    tables x probes x limit comparisons a level of splitting.
    """

    tables: int = 16
    probes: int = 10
    limit: int = 2_048
    block: int = 4_096
    seed: int = 42


def _planes(spec: Projections, width: int) -> np.ndarray:
    """Normals by table, bit and coordinate."""
    return np.random.default_rng(spec.seed).standard_normal((spec.tables, BITS, width))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: its smallest id ``g``, and ``members``, its k smallest ids with what they carry.

    Copies of a vector beyond k are never among the k nearest of anything, since ties go to the smaller id.
    """
    first = top_k_per_group(rows, ["v"], [F.col("id")], k)
    members = F.array_sort(F.collect_list(F.struct("id", "carry")))
    return first.groupBy("v").agg(members.alias("members")).withColumn("g", F.col("members")[0]["id"])


def _leaves(codes: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The rows (g, tab, code) of the buckets that need no split, and all buckets (tab, prefix, n), by level."""
    at_rest, buckets, open_rows = [], [], codes
    for depth in range(STEP, BITS + 1, STEP):
        placed = open_rows.withColumn("prefix", F.shiftrightunsigned("code", BITS - depth))
        level = written(placed.groupBy("tab", "prefix").agg(F.count(F.lit(1)).alias("n")), "buckets")
        buckets.append(level)
        if depth == BITS or level.where(F.col("n") > limit).isEmpty():
            at_rest.append(placed)
            break
        split = Summary(level.where(F.col("n") > limit).select("tab", "prefix", F.lit(True).alias("wide")))
        marked = written(split.join_to(placed, ["tab", "prefix"], "left"), "placed")
        at_rest.append(marked.where("wide is null").drop("wide"))
        open_rows = marked.where("wide").select("g", "tab", "code")
    return at_rest, buckets


def nearest_approximate(
    queries: DataFrame, base: DataFrame, id_col: str, array: str, carry: str, k: int, spec: Projections = Projections(),
) -> DataFrame:
    """About the k nearest base rows of every query: ``(id, rank, distance, neighbour, carry)``, as ``nearest`` has it.

    Distances are true ones, rounded to nine digits, equal ones ordered by id; what may be missing is a neighbour
    that no visited bucket holds. Ids are unique, vectors have one length; rows with a null id or vector are left out.
    Equal vectors are compared once, so copies cost nothing. A bucket that all bits cannot split is cut into blocks.
    The driver sees the mean vector only.
    """
    def plain(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.col(carry).alias("carry"), F.col(array).cast("array<double>").alias("v"))
        return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())

    base, asked = plain(base), plain(queries)
    types = dict(base.dtypes)
    mean = np.array([r["mean"] for r in vector_mean(base, "v").orderBy("pos").collect()], dtype=np.float64)
    planes = _planes(spec, len(mean))
    weights = 1 << np.arange(BITS, dtype=np.int64)[::-1]
    choices = np.array([[c >> (STEP - 1 - i) & 1 for i in range(STEP)] for c in range(1 << STEP)], dtype=bool)

    @pandas_udf("array<bigint>")
    def signatures(v: pd.Series) -> pd.Series:
        x = matrix(v) - mean
        return pd.Series(list(np.stack([(x @ p.T > 0) @ weights for p in planes], axis=1)))

    @pandas_udf("array<struct<prefix:bigint,cost:double>>")
    def branches(v: pd.Series, tab: pd.Series, prefix: pd.Series, cost: pd.Series, depth: pd.Series) -> pd.Series:
        """The cheapest sub-buckets: a bit that is not the query's own costs its squared distance to the plane."""
        x, out = matrix(v) - mean, [None] * len(v)
        for (t, d), at in pd.Series(range(len(v))).groupby([tab.to_numpy(), depth.to_numpy()]):
            at = at.to_numpy()
            sides = x[at] @ planes[t, d : d + STEP].T
            price = np.einsum("nci,ni->nc", (sides > 0)[:, None, :] != choices[None], sides**2)
            best = np.argsort(price, axis=1, kind="stable")[:, : spec.probes]
            for i, row in enumerate(at):
                out[row] = [
                    {"prefix": (int(prefix.iat[row]) << STEP) + int(c), "cost": float(cost.iat[row] + price[i, c])} for c in best[i]
                ]
        return pd.Series(out)

    vectors = written(_distinct(base, k), "distinct")
    codes = vectors.select("g", F.posexplode(signatures("v")).alias("tab", "code"))
    at_rest, buckets = _leaves(written(codes, "codes"), spec.limit)

    # Equal queries are answered once; all their ids are joined back at the end.
    own = written(asked.groupBy("v").agg(F.min("id").alias("q")), "queries")
    tables = F.sequence(F.lit(0), F.lit(spec.tables - 1))
    probes = own.select("q", "v", F.explode(tables).alias("tab"), F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("cost"))
    found = []
    for level, (rows, counts) in enumerate(zip(at_rest, buckets, strict=True)):
        below = F.explode(branches("v", "tab", "prefix", "cost", F.lit(level * STEP)))
        probes = probes.select("q", "v", "tab", below.alias("b")).select("q", "v", "tab", "b.*")
        held = Summary(counts).join_to(probes, ["tab", "prefix"])
        held = written(top_k_per_group(held, ["q", "tab"], [F.col("cost"), F.col("prefix")], spec.probes).drop("rank"), "probes")
        last = level == len(buckets) - 1
        found.append(_compared(held if last else held.where(F.col("n") <= spec.limit), rows, vectors, k, spec, types["id"]))
        probes = held.where(F.col("n") > spec.limit).drop("n")

    pairs = reduce(DataFrame.unionByName, found).groupBy("q", "g").agg(F.min("distance").alias("distance"))
    nearest = top_k_per_group(pairs, ["q"], [F.col("distance"), F.col("g")], k).drop("rank")
    listed = nearest.join(vectors.select("g", "members"), "g").select("q", "distance", F.inline("members"))
    ranked = top_k_per_group(listed, ["q"], [F.col("distance"), F.col("id")], k)
    same = asked.select(F.col("id").alias("_asked"), "v").join(own, "v").select("_asked", "q")
    return same.join(ranked, "q").select(
        F.col("_asked").alias(id_col), "rank", "distance", F.col("id").alias("neighbour"), F.col("carry").alias(carry)
    )


def _compared(probes: DataFrame, rows: DataFrame, vectors: DataFrame, k: int, spec: Projections, id_type: str) -> DataFrame:
    """(q, g, distance): per query and block of a bucket the k nearest of its vectors."""
    keys = ["tab", "prefix"]
    visits = Summary(probes.groupBy(*keys).agg(F.count(F.lit(1)).alias("asked"), F.first("n").alias("n")))
    # Blocks of each side: rows of one side are dealt by a hash, and sent to every block of the other side.
    parts_q, parts_b = (F.ceil(F.col(c) / spec.block).cast("int") for c in ("asked", "n"))

    def dealt(side: DataFrame, key: str, mine: str, others: str) -> DataFrame:
        known = visits.join_to(side, keys).withColumns({"pq": parts_q, "pb": parts_b})
        blocks = F.explode(F.sequence(F.lit(0), F.col("pb" if mine == "bq" else "pq") - 1))
        dealt_to = F.pmod(F.xxhash64(key), F.col("pq" if mine == "bq" else "pb")).cast("int")
        return known.withColumn(mine, dealt_to).withColumn(others, blocks)

    left = dealt(probes.drop("n"), "q", "bq", "bb").select(*keys, "bq", "bb", "q", "v")
    right = dealt(rows.select("g", *keys), "g", "bb", "bq").select(*keys, "bq", "bb", "g")
    right = right.join(vectors.select("g", F.col("v").alias("w")), "g")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"q": [], "g": [], "distance": []})
        ids = b["g"].to_numpy()
        at, near, distance = nearest_in_block(matrix(a["v"]), matrix(b["w"]), ids, k, DIGITS)
        return pd.DataFrame({"q": a["q"].to_numpy()[at], "g": ids[near], "distance": distance})

    group = [*keys, "bq", "bb"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(compare, f"q {id_type}, g {id_type}, distance double")
