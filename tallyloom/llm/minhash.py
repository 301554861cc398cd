"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components, prepare
from tallyloom.llm.shingles import band_keys, circulant_minhash, word_shingles
from tallyloom.llm.similar import Measure, links_of
from tallyloom.plans.durable import written


@dataclass(frozen=True)
class NearDuplicates:
    """Documents are linked when 100 * intersection >= percent * union of their word-shingle sets.

    ``bands`` bands of ``rows`` coordinates each make a pair at similarity s a candidate with probability
    1 - (1 - s**rows)**bands: over 0.9999999 at 0.8 with 32 bands of 4.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    def measure(self) -> Measure:
        return Measure(
            partial(word_shingles, size=self.words),
            partial(circulant_minhash, length=self.bands * self.rows),
            self.percent,
            self.rows,
            max(0.0, self.percent / 100 - 0.25),
        )


def _sketches(spec: NearDuplicates):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                elements = word_shingles(text, spec.words)
                sizes.append(elements.size)
                digests.append(xxhash.xxh3_128_digest(elements.tobytes()) if elements.size else None)
                keys.append(
                    band_keys(circulant_minhash(elements, spec.bands * spec.rows), spec.rows).tobytes() if elements.size else None
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return task


def near_duplicates(docs: DataFrame, spec: NearDuplicates | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks that document. Texts that
    are null, empty or have no words have no shingles and link with nothing, as do rows without doc_id,
    whose component_id is null and which are kept. Repeated rows are copies. Other columns are not read.

    Documents with equal shingle sets are collapsed first, so a group of exact copies costs one bucket row
    however large it is; only their representatives are banded.
    """
    spec = spec or NearDuplicates()
    prepare(docs.sparkSession)
    sketches = written(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _sketches(spec), "doc_id long, n_shingles long, digest binary, bands binary"
        ),
        "sketches",
    )
    sets = written(
        sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "sets",
    )
    bands = sets.select(F.col("rep").alias("id"), "bands")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")).where("id IS NOT NULL")
    links = links_of(bands, texts, spec.measure(), "minhash", sets.count() * spec.bands)
    named = components(links, "a", "b")
    classes = sets.join(named, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("found")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return (
        sketches.join(classes, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
