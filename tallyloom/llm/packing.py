"""Packing documents into sequences as a cutting-stock problem solved by column generation.

Documents are cut at the sequence length, so every piece fits one sequence. The histogram of piece lengths, in
classes of a few tokens, is a cutting-stock instance of bounded size: its linear program over patterns (how
many pieces of each class one sequence holds) is solved by column generation, a knapsack by dynamic programming
pricing the next pattern. Rounded-down pattern counts and a first-fit of the few pieces left over become a table
of places; the pieces of a class, ranked in a distributed way, take these places in order.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import prepare, ranked
from tallyloom.llm.tokens import word_pieces
from tallyloom.plans.durable import written


@dataclass(frozen=True)
class Packing:
    """``grain`` is the width of a length class in tokens, ``gap`` the relative distance from the bound of the
    linear program at which pricing stops. ``slices`` ranks the pieces of one class in that many tasks."""

    tokenizer: str
    end_id: int = 2
    capacity: int = 4_096
    grain: int = 8
    gap: float = 1e-4
    slices: int = 16


def _cut(spec: Packing):
    end = spec.end_id.to_bytes(4, "little")
    width = 4 * spec.capacity

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                data = word_pieces(spec.tokenizer).ids(text) + end
                for at in range(0, len(data), width):
                    piece = data[at : at + width]
                    rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return task


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``sizes`` within ``capacity``: unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = np.searchsorted(sizes, c, "right")
        if fits:
            gains = best[c - sizes[:fits]] + values[:fits]
            i = int(gains.argmax())
            if gains[i] > best[c] + 1e-12:
                best[c], taken[c] = gains[i], i
    pattern, c = np.zeros(sizes.size, int), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= sizes[taken[c]]
    return float(best[capacity]), pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (as columns) and their fractional counts that meet ``demand`` with few sequences.

    Revised simplex from one-size patterns; stops when the value of the best priced pattern proves the
    solution to be within ``gap`` of the optimum (the bound is total / value).
    """
    n = sizes.size
    patterns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(patterns))
    counts = inverse @ demand
    while True:
        prices = inverse.sum(axis=0)
        value, column = best_pattern(sizes, prices, capacity)
        if value <= 1 + gap:
            return patterns.astype(int), counts
        direction = inverse @ column
        ratios = np.full(n, np.inf)
        up = direction > 1e-9
        ratios[up] = counts[up] / direction[up]
        out = int(ratios.argmin())
        step = ratios[out]
        counts = np.maximum(counts - step * direction, 0)
        counts[out] = step
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        patterns[:, out] = column


def whole_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float) -> list[tuple[dict[int, int], int]]:
    """Patterns {class index: pieces} with how often each is used; every piece of ``demand`` has one place."""
    patterns, counts = column_generation(sizes, demand, capacity, gap)
    used: list[tuple[dict[int, int], int]] = []
    left = demand.copy()
    for k in np.argsort(-counts):
        column = patterns[:, k]
        held = np.flatnonzero(column)
        times = int(min(np.floor(counts[k] + 1e-9), (left[held] // column[held]).min()))
        if times:
            used.append(({int(i): int(column[i]) for i in held}, times))
            left -= times * column
    # What rounding left over: at most a sequence's worth of pieces per pattern, placed first-fit by size.
    bins: list[tuple[int, Counter]] = []
    for i in range(sizes.size - 1, -1, -1):
        for _ in range(int(left[i])):
            at = next((b for b, (room, _) in enumerate(bins) if room >= sizes[i]), None)
            if at is None:
                bins.append((capacity, Counter()))
                at = len(bins) - 1
            room, content = bins[at]
            content[i] += 1
            bins[at] = (room - int(sizes[i]), content)
    return used + [(dict(content), 1) for _, content in bins]


def pack(docs: DataFrame, spec: Packing) -> DataFrame:
    """Place the ids of every row of ``docs`` (doc_id, text), with the end id, into sequences.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty
    text is a document of the end id alone; rows without doc_id and repeated rows are packed like others;
    an empty table gives no rows. Documents longer than a sequence are cut at its length. Sequences hold
    whole pieces from offset 0 without gaps, the rest of each is padding. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    pieces = written(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _cut(spec), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
        ).withColumn("class", F.ceil(F.col("length") / spec.grain).cast("int")),
        "pieces",
    )
    # At most capacity / grain rows.
    histogram = sorted((r[0], r[1]) for r in pieces.groupBy("class").count().collect())
    sizes, demand = (np.array(c, int) for c in (zip(*histogram, strict=True) if histogram else ((), ())))
    room = spec.capacity // spec.grain
    places, sequence, taken = [], 0, Counter()
    for pattern, times in whole_patterns(sizes, demand, room, spec.gap) if sizes.size else []:
        slot = 0
        for i, copies in sorted(pattern.items(), reverse=True):
            places.append((int(sizes[i]), taken[i], taken[i] + times * copies, copies, sequence, slot))
            taken[i] += times * copies
            slot += copies
        sequence += times
    # A row per class of each pattern: bounded by the classes, not by the documents.
    table = spark.createDataFrame(places, "class int, low long, high long, copies long, first long, slot long")
    ordered = ranked(pieces.withColumn("_order", F.struct("doc_id", "start")), "class", "_order", "_place", spec.slices)
    inside = F.col("_place") - F.col("low")
    placed = ordered.join(F.broadcast(table), "class").where("_place >= low AND _place < high").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(inside / F.col("copies"))).alias("sequence_id"),
        (F.col("slot") + inside % F.col("copies")).alias("_slot"),
    )
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_slot")
