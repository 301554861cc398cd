"""What several of these operators share: components of a link graph, global positions, shipping, table access."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tallyloom.plans.durable import discard, written

ROOT = Path(__file__).resolve().parents[2]
# Rows of one Arrow batch; a batch of the longest texts must fit a Python worker.
BATCH_ROWS = 500


@cache
def _archive() -> str:
    return shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="tallyloom-")) / "tallyloom"), "zip", ROOT, "tallyloom")


@cache
def _shipped(application: str) -> None:
    SparkSession.active().sparkContext.addPyFile(_archive())


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors, whose Python tasks import it, and keep Arrow batches small."""
    _shipped(spark.sparkContext.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what runs inside: for tables of numbers, which need no small ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def portions(texts: Sequence[str], size: int = 1 << 20) -> Iterator[slice]:
    """Slices of texts of about ``size`` code points together."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield slice(first, n + 1)
            first, held = n + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def dealt(part: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Columns as arrays, one row for each part: ``part``, and the bytes of each column's numbers that fall in it."""
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(part.astype(np.uint16) if part.size and part.max() < 1 << 16 else part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: part.size])
    bounds = np.append(first, part.size).tolist()
    arrays = [pa.array([x[i:j].tobytes() for i, j in pairwise(bounds)], pa.binary()) for x in (c[order] for c in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(part[first], pa.int32()), *arrays], names=["part", *columns])


def undealt(batches: Iterable[pa.RecordBatch], kinds: Sequence[np.dtype | type]) -> list[np.ndarray]:
    """The columns of all rows that ``dealt`` made, one after another."""
    rows = [[np.frombuffer(b"".join(batch.column(i + 1).to_pylist()), k) for i, k in enumerate(kinds)] for batch in batches]
    return [np.concatenate([row[i] for row in rows]) if rows else np.empty(0, k) for i, k in enumerate(kinds)]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Numbers (ids, or elements of arrays) that a table may hold to be broadcast: some 16 MB on each executor.
BROADCAST_NUMBERS = 1_000_000


def bounded_broadcast(stored: DataFrame, numbers: Column | None = None) -> DataFrame:
    """Mark a stored table for broadcasting if the numbers in it were counted and are few, else leave it as it is.

    ``numbers`` says how many a row holds (one by default). A larger table is joined by key.
    """
    total = stored.agg(F.sum(F.lit(1) if numbers is None else numbers)).first()[0] or 0
    return F.broadcast(stored) if total <= BROADCAST_NUMBERS else stored


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum of them."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected links: (node, component), component being the smallest node reachable.

    Only nodes with a link are returned. Alternates the large-star and small-star steps, each a grouped
    minimum and a join, until the edges no longer change; every round is written to the shared folder, so
    a lost executor costs one round. A node with very many neighbours is reduced to its minimum by partial
    aggregation, and the join that follows has one row per node on the other side, so run-time skew
    splitting can divide it.
    """
    edges = written(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(small_low, "u")
            .where(F.col("v") != F.col("low"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(small_low)
            .distinct()
        )
        before, edges = edges, written(small, "edges")
        discard(before)
        after = _state(edges)
        if after == state:
            break
        state = after
    return (
        edges.toDF("node", "component")
        .union(edges.select("v", "v"))
        .distinct()
    )


def ranked(df: DataFrame, key: str, order: str, name: str, slices: int) -> DataFrame:
    """Add ``name``: the row's position, from 0, among the rows of its ``key``.

    Rows are ordered by (slice, ``order``), a slice being a hash of ``order``, so a key that holds a third
    of all rows is ranked in ``slices`` tasks; only counts per key and slice are summed up across them.
    """
    cut = df.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(slices)).cast("int"))
    counts = cut.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_count"))
    before = W.Window.partitionBy(key).orderBy("_slice").rowsBetween(W.Window.unboundedPreceding, -1)
    bases = counts.select(key, "_slice", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_base"))
    inside = W.Window.partitionBy(key, "_slice").orderBy(order)
    return (
        cut.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(bases, [key, "_slice"])
        .withColumn(name, F.col("_base") + F.col("_rank"))
        .drop("_slice", "_rank", "_base")
    )
