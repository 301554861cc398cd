"""From band keys to components: exact links between similar rows without pairing whole buckets.

A bucket (rows with the same band key) gives candidates. Links matter only as far as they join components,
so a bucket is worked in steps: its members are verified against one hub; what already hangs together needs
no further test; the pairs across components that are left are then all verified, small buckets by a join,
large ones in blocks inside tasks that return at most one link per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batches_of, bounded_broadcast, components, dealt, portions, undealt
from tallyloom.llm.shingles import band_keys
from tallyloom.plans.durable import written
from tallyloom.plans.skew import SALT, heavy_keys, replicated, salted

# Buckets up to this size have their remaining cross-component pairs listed by a join.
LISTED = 32
# Members of one block of a larger bucket.
BLOCK = 1024


@dataclass(frozen=True)
class Measure:
    """How two texts are compared: the set of one, its signature, and the test on two sets."""

    elements: Callable[[bytes], np.ndarray]
    signature: Callable[[np.ndarray], np.ndarray]
    percent: int
    # Coordinates of a band, as the keys were made.
    rows: int
    # Share of equal signature coordinates under which a pair inside a block is not compared: many standard
    # deviations below the threshold, so that a pair at the threshold is lost far more rarely than by banding.
    agree: float
    # The sets of several texts, where that is faster than one by one.
    sets: Callable[[Sequence[bytes]], list[np.ndarray]] | None = None
    # The signatures of several sets, likewise.
    signatures: Callable[[Sequence[np.ndarray]], np.ndarray] | None = None

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets, arrays of distinct elements, are similar enough."""
        small, large = sorted((a.size, b.size))
        if not small or 100 * small < self.percent * large:
            return False
        both = np.concatenate((a, b))
        both.sort()
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * common >= self.percent * (small + large - common)

    def sets_of(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        return self.sets(texts) if self.sets else [self.elements(x) for x in texts]

    def signatures_of(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        return self.signatures(sets) if self.signatures else np.stack([self.signature(x) for x in sets])


# Bytes of texts whose sets a task holds at once.
COMPARED = 1 << 20


def _verify(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(*(batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3)), strict=True))
            keep = []
            for some in portions([x + y for x, y in pairs], COMPARED):
                texts = list({x: None for pair in pairs[some] for x in pair})
                sets = dict(zip(texts, measure.sets_of(texts), strict=True))
                keep += [measure.linked(sets[x], sets[y]) for x, y in pairs[some]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"]
            )

    return task


# Pairs of one text that a task verifies; more are dealt to several.
VERIFIED = 20_000


def verified(pairs: DataFrame, texts: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) whose texts pass the exact test. ``texts`` has (id, text)."""
    pairs = written(pairs, "candidate-pairs")
    heavy = heavy_keys(pairs, ["a"], VERIFIED)
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = (
        salted(pairs.join(right, "b"), heavy, ["a"], ["b"])
        .join(replicated(left, heavy, ["a"]), ["a", SALT])
        .select("a", "b", "ta", "tb")
    )
    return both.mapInArrow(_verify(measure), "a long, b long")


# Hash values that a block tells shingles apart by before it compares sets.
SLOTS = 1 << 16


class _Sets:
    """The sets of the texts of a block, their signatures, and for each shingle one of SLOTS."""

    def __init__(self, measure: Measure, texts: Sequence[bytes]):
        self.measure, self.sets, signatures = measure, [], []
        for some in portions(texts, COMPARED):
            sets = measure.sets_of(texts[some])
            self.sets += sets
            signatures.append(measure.signatures_of(sets))
        self.signatures = np.concatenate(signatures)
        self.sizes = np.array([x.size for x in self.sets])
        self.slots = [(x & np.uint64(SLOTS - 1)).astype(np.uint16) for x in self.sets]
        self.marked = np.zeros(SLOTS, bool)

    def linked(self, x: int, y: int) -> bool:
        return self.measure.linked(self.sets[x], self.sets[y])

    def possible(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that may be linked with x: no more shingles are common than have a slot of x's shingles."""
        percent, sizes = self.measure.percent, self.sizes[others]
        small, large = np.minimum(sizes, self.sizes[x]), np.maximum(sizes, self.sizes[x])
        alike = (small > 0) & (100 * small >= percent * large)
        others, both = others[alike], (small + large)[alike]
        if not others.size:
            return others
        self.marked[self.slots[x]] = True
        hits = self.marked[np.concatenate([self.slots[y] for y in others])]
        self.marked[self.slots[x]] = False
        starts = np.cumsum(self.sizes[others]) - self.sizes[others]
        common = np.minimum(np.add.reduceat(hits, starts, dtype=np.int64), self.sizes[x])
        return others[100 * common >= percent * (both - common)]


# Pairs of one text that are looked at first before links that they gave are taken into account; then twice as many, and so on.
FIRST = 16


def _block_links(measure: Measure) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def task(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between two blocks of a bucket.

        Pairs already joined by a link found here are skipped, and so are pairs that an earlier band brings
        together as well: that bucket has them.
        """
        rows = rows.sort_values("id").drop_duplicates(["id", "side"])
        left, right = (np.flatnonzero(rows["side"].isin(s)) for s in ((0, 2), (1, 2)))
        found = []
        if left.size and right.size:
            ids, component = rows["id"].to_numpy(), rows["label"].to_numpy(copy=True)
            sets = _Sets(measure, [t.encode() for t in rows["text"]])
            marks, keys = sets.signatures.astype(np.uint8), band_keys(sets.signatures, measure.rows)
            # An id that was repeated with another text may lack the key; without any, nothing is skipped.
            band = next((int(at[0]) for k in keys if (at := np.flatnonzero(k == rows["key"].iloc[0])).size), 0)
            earlier, same = keys[:, :band], rows["side"].iloc[0] == 2
            most = max(1, COMPARED // int(sets.sizes.max()))
            for x in left:
                # Inside a block the pairs with those before were looked at from there.
                close = right[np.searchsorted(right, x) :] if same else right
                close = close[component[close] != component[x]]
                close = close[~(earlier[close] == earlier[x]).any(axis=1)]
                close = close[np.add.reduce(marks[close] == marks[x], axis=1, dtype=np.uint16) / marks.shape[1] >= measure.agree]
                step = min(FIRST, most)
                while close.size:
                    some, close = close[:step], close[step:]
                    for y in sets.possible(x, some):
                        p, q = component[x], component[y]
                        if p != q and sets.linked(x, y):
                            component[component == max(p, q)] = min(p, q)
                            found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    close = close[component[close] != component[x]]
                    step = min(2 * step, most)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return task


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets in which more than one component is left, each with its component."""
    found = components(links, "a", "b")
    named = members.join(found, F.col("id") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("label")
    )
    open_keys = (
        named.groupBy("key")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members"))
        .where("lo < hi")
        .select("key", "members")
    )
    return named.join(open_keys, "key")


# Rows (key, id) that a task looks for shared keys in, and rows of one batch of sketches and of members.
KEYS = 500_000
ROWS = 1 << 15


def _dealt(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The keys of each batch of sketches and their ids as arrays, one row for each part that keys fall in."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            ids = np.repeat(batch.column(0).to_numpy(), keys.size // batch.num_rows)
            part = (keys.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            yield dealt(part, {"keys": keys, "ids": ids})

    return task


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, hub) of the keys that several ids have, hub being the smallest; all arrays of a part are in one partition."""
    key, ids = undealt(batches, (np.int64, np.int64))
    if not key.size:
        return
    order = np.argsort(key)
    key = key[order]
    # Most keys come up once and need no further look.
    same = key[1:] == key[:-1]
    repeated = np.append(same, False) | np.insert(same, 0, False)
    key, ids = key[repeated], ids[order[repeated]]
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    new = np.ones(key.size, bool)
    new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
    key, ids = key[new], ids[new]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: key.size])
    sizes = np.diff(np.append(first, key.size))
    shared = np.repeat(sizes > 1, sizes)
    columns = [x[shared] for x in (key, ids, np.repeat(ids[first], sizes))]
    for at in range(0, columns[0].size, ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + ROWS]) for x in columns], names=["key", "id", "hub"])


def links_of(bands: DataFrame, texts: DataFrame, measure: Measure, name: str, rows: int) -> DataFrame:
    """Verified links (a, b) that join every two rows which the buckets and the exact test connect.

    ``bands`` has (id, bands), the bytes of as many band keys in each row, which may repeat, ``rows`` keys at most in all;
    ``texts`` has (id, text) with one row per id.
    """
    parts = max(1, -(-rows // KEYS))
    arrays = bands.select("id", "bands").mapInArrow(_dealt(parts), "part int, keys binary, ids binary").repartitionById(parts, "part")
    with batches_of(bands.sparkSession, ROWS):
        members = written(arrays.mapInArrow(_shared_keys, "key long, id long, hub long"), f"{name}-members")
    needed = written(members.select("id").distinct(), f"{name}-ids")
    texts = texts.join(bounded_broadcast(needed), "id", "left_semi").groupBy("id").agg(F.first("text").alias("text"))
    texts = written(texts, f"{name}-texts")

    star = members.where("hub < id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = written(verified(star, texts, measure), f"{name}-links")

    left = written(_labelled(members.select("key", "id"), links), f"{name}-open")
    x, y = (left.where(F.col("members") <= LISTED).select("key", F.col("id").alias(i), F.col("label").alias(c))
            for i, c in (("a", "la"), ("b", "lb")))
    listed = x.join(y, "key").where("a < b AND la <> lb").select("a", "b").distinct()
    listed = listed.join(star, ["a", "b"], "left_anti")

    large = left.where(F.col("members") > LISTED)
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    # Every member goes to the pairs of blocks (i, j), i <= j, that its own block belongs to.
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    blocks = (
        large.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "label",
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        )
        .join(texts, "id")
    )
    blocked = blocks.groupBy("key", "i", "j").applyInPandas(_block_links(measure), "a long, b long")
    return links.union(verified(listed, texts, measure)).union(blocked)
