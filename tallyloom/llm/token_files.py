"""Token-id files: each document compressed on its own with one shared zstandard dictionary.

A folder holds

* ``dictionary``: the dictionary's bytes and a final line feed,
* ``data/shard=.../``: one file per shard, named by its place and the ids before it: header, one frame per
  document, offset index, footer, a line feed,
* ``manifest``: Parquet, one row per shard with its first and last document and the ids before it.

Integers are little-endian. A shard is: ``TIDS``, version (u16), bytes per id (u16), SHA-256 of the dictionary
(32 bytes); the frames in ascending doc_id order; per document doc_id (i64), frame offset (u64), number of
ids (u64); number of documents (u64), offset of this index (u64). A document is read by one look-up in the
manifest, one in the index, and the decompression of its frame alone.

Everything is written and read by Spark's own writers and readers, so any file system it knows will do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import prepare
from tallyloom.llm.tokens import word_pieces
from tallyloom.plans.durable import written

MAGIC, VERSION = b"TIDS", 1
HEADER = len(MAGIC) + 4 + 32
# The doc_id that stands for null.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class TokenFiles:
    """``tokenizer`` is the path of a vocabulary file, the same on every executor. The dictionary is fitted on
    ``sample_docs`` documents (those with the lowest hash of their id), at most ``sample_pieces`` pieces of
    ``piece_bytes`` from all over each."""

    tokenizer: str
    end_id: int = 1
    id_bytes: int = 2
    level: int = 3
    dictionary_bytes: int = 65_536
    sample_docs: int = 400
    sample_pieces: int = 16
    piece_bytes: int = 2_048
    shard_bytes: int = 8 << 20


def _serialised(spec: TokenFiles, text: bytes | None) -> bytes:
    ids = np.frombuffer(word_pieces(spec.tokenizer).ids(text) + spec.end_id.to_bytes(4, "little"), "<u4")
    return ids.astype(f"<u{spec.id_bytes}").tobytes()


def _sample_pieces(spec: TokenFiles):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                data = _serialised(spec, text)
                starts = range(0, len(data), spec.piece_bytes)
                step = max(1, -(-len(starts) // spec.sample_pieces))
                pieces += [data[i : i + spec.piece_bytes] for i in starts[::step]]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["piece"])

    return task


def train_dictionary(docs: DataFrame, spec: TokenFiles) -> bytes:
    """A dictionary fitted on a bounded sample; empty when the sample is too small to train on."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.sample_docs)
    chosen = [r.doc_id for r in ids.collect()]
    sample = docs.where(F.col("doc_id").isin(chosen)).select("text").limit(spec.sample_docs)
    pieces = sorted(r.piece for r in sample.mapInArrow(_sample_pieces(spec), "piece binary").collect())
    try:
        return zstandard.train_dictionary(spec.dictionary_bytes, [bytes(p) for p in pieces]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _frames(spec: TokenFiles, dictionary: bytes):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=spec.level, dict_data=_dictionary(dictionary), write_checksum=True)
        for batch in batches:
            data = [_serialised(spec, t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(d) // spec.id_bytes for d in data], pa.int64()),
                    pa.array([compressor.compress(d) for d in data], pa.binary()),
                ],
                names=["doc_id", "n_tokens", "frame"],
            )

    return task


def _shards(spec: TokenFiles, digest: bytes):
    header = MAGIC + VERSION.to_bytes(2, "little") + spec.id_bytes.to_bytes(2, "little") + digest

    def shard(part: int, number: int, inside: int, docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        at, index, body = HEADER, [], [header]
        for doc_id, n, frame in docs:
            index.append(np.array([doc_id, at, n], "<i8").tobytes())
            body.append(frame)
            at += len(frame)
        blob = b"".join([*body, *index, len(docs).to_bytes(8, "little"), at.to_bytes(8, "little")])
        row = [part, number, docs[0][0], docs[-1][0], len(docs), sum(d[1] for d in docs), inside]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], pa.int64()) for v in row), pa.array([blob], pa.binary())],
            names=["part", "number", "first_doc", "last_doc", "docs", "tokens", "inside", "blob"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, inside, held, size = 0, 0, 0, [], 0
        for batch in batches:
            for part, doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((NO_ID if doc_id is None else doc_id, n, frame))
                size += len(frame)
                if size >= spec.shard_bytes:
                    yield shard(part, number, inside, held)
                    number, inside, held, size = number + 1, inside + sum(d[1] for d in held), [], 0
        if held:
            yield shard(part, number, inside, held)

    return task


def write_token_files(docs: DataFrame, path: str, spec: TokenFiles) -> None:
    """Write the ids of every row of ``docs`` (doc_id, text) below ``path``, in ascending doc_id order.

    A null or empty text has the end id alone. Rows without doc_id come first and are stored under the
    lowest 64-bit number. Repeated doc_ids are kept, next to each other. An empty table gives a folder
    without shards. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dictionary = train_dictionary(docs, spec)
    spark.createDataFrame([(bytearray(dictionary),)], "value binary").select(
        F.col("value").cast("string")
    ).coalesce(1).write.text(f"{path}/dictionary")
    # Stored, since range partitioning reads its input twice and must not encode everything twice.
    frames = written(docs.mapInArrow(_frames(spec, dictionary), "doc_id long, n_tokens long, frame binary"), "frames")
    ordered = (
        frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "n_tokens", "frame")
    )
    shards = written(
        ordered.mapInArrow(
            _shards(spec, hashlib.sha256(dictionary).digest()),
            "part long, number long, first_doc long, last_doc long, docs long, tokens long, inside long, blob binary",
        ),
        "shards",
    )
    # One row per partition of the shuffle above: small whatever the data.
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    placed = (
        shards.join(F.broadcast(bases), "part")
        .withColumn("start", F.col("base") + F.col("inside"))
        .withColumn("shard", F.format_string("s%08d-%06d-%d", "part", "number", "start"))
    )
    placed.select(F.col("blob").cast("string").alias("value"), "shard").write.partitionBy("shard").text(f"{path}/data")
    placed.select("shard", "start", "first_doc", "last_doc", "docs", "tokens").write.parquet(f"{path}/manifest")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/dictionary").select("content").first()
    return bytes(row.content)[:-1]


def _documents(dictionary: bytes, wanted: frozenset[int] | None):
    digest = hashlib.sha256(dictionary).digest()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for shard, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if blob[:4] != MAGIC or blob[8:HEADER] != digest:
                    raise ValueError(f"shard {shard} was not written with this dictionary")
                width = int.from_bytes(blob[6:8], "little")
                count, at = (int.from_bytes(blob[-17 + i : -9 + i], "little") for i in (0, 8))
                index = np.frombuffer(blob, "<i8", 3 * count, at).reshape(-1, 3)
                ends = np.append(index[1:, 1], at)
                starts = int(shard.rpartition("-")[2]) + np.cumsum(index[:, 2]) - index[:, 2]
                places = range(count) if wanted is None else np.flatnonzero(np.isin(index[:, 0], list(wanted)))
                for some in (places[i : i + 256] for i in range(0, len(places), 256)):
                    ids = [
                        np.frombuffer(decompressor.decompress(blob[index[i, 1] : ends[i]]), f"<u{width}").astype("<u4").tobytes()
                        for i in some
                    ]
                    docs = [int(index[i, 0]) for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if d == NO_ID else d for d in docs], pa.int64()),
                            pa.array([int(starts[i]) for i in some], pa.int64()),
                            pa.array([int(index[i, 2]) for i in some], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return task


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit) from the files.

    With ``doc_ids`` only the shards that can hold them are opened and only their frames decompressed.
    """
    manifest = spark.read.parquet(f"{path}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    wanted = None
    if doc_ids is not None:
        wanted = frozenset(doc_ids)
        near = F.lit(False)
        for i in wanted:
            near = near | F.lit(i).between(F.col("first_doc"), F.col("last_doc"))
        files = files.where(F.col("shard").isin([r.shard for r in manifest.where(near).select("shard").collect()]))
    return files.select("shard", "content").mapInArrow(
        _documents(read_dictionary(spark, path), wanted), "doc_id long, start long, n_tokens long, ids binary"
    )
