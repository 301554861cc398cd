"""Token counts of whole texts, those of huge documents from overlapping chunks that many tasks encode.

A chunk's first tokens depend on where it was cut. Its neighbour before reaches over that place, so the two share a
stretch of text. There the counts are spliced at a boundary that both have and that is proven to hold in the whole
text: no piece of the vocabulary contains the two characters around it side by side, and pieces are all that merges
ever make, so no merge can reach across, whatever stands further away. Where a stretch has no such boundary, the
document is cut again with wider overlaps, in the end into one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import portions, prepare
from tallyloom.plans.durable import written

SPACE = "▁"


@dataclass(frozen=True)
class TokenCounts:
    """``vocabulary`` is a file of the ``sentencepiece`` library. Texts of more than ``huge`` code points are cut into
    chunks of ``chunk`` that reach ``overlap`` further; ``limit`` is what over_limit compares with."""

    vocabulary: str
    limit: int = 4096
    huge: int = 65_536
    chunk: int = 32_768
    overlap: int = 256


class Pieces:
    """A vocabulary with the code points of each piece and the pairs of characters inside pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        ids = range(self.processor.get_piece_size())
        written_ = [self.processor.id_to_piece(i) for i in ids]
        byte = [int(p[3:5], 16) if self.processor.is_byte(i) else -1 for i, p in zip(ids, written_, strict=True)]
        # Of the bytes of one character the first counts as the character.
        self.points = np.array([len(p) if b < 0 else int(not 0x80 <= b < 0xC0) for p, b in zip(written_, byte, strict=True)], np.int64)
        self.joined = {p[i : i + 2] for p, b in zip(written_, byte, strict=True) if b < 0 for i in range(len(p) - 1)}

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.processor.encode(texts, num_threads=1)]

    def stable(self, text: str, first: int, last: int) -> int | None:
        """The first place from ``first`` up to ``last`` that no token of any text around it can reach across."""
        for at in range(max(1, first), min(last, len(text) - 1) + 1):
            if text[at - 1 : at + 1].replace(" ", SPACE) not in self.joined:
                return at
        return None

    def ends(self, text: str) -> np.ndarray:
        """The code points that all tokens up to each one cover; the space put before a text is not counted."""
        return np.cumsum(self.points[np.array(self.processor.encode(text), np.int64)]) - 1


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _whole(spec: TokenCounts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = [n for some in portions(texts) for n in pieces(spec.vocabulary).counts(texts[some])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return task


def _cut(chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                for n, start in enumerate(starts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row], pa.int64()), pa.array([n], pa.int32()), pa.array([n + 1 == len(starts)]),
                            pa.array([text[start : start + chunk + overlap if n + 1 < len(starts) else None]], pa.string()),
                        ],
                        names=["row", "piece", "last", "text"],
                    )

    return task


def _splices(spec: TokenCounts, chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per chunk: where it can be spliced with the one before and the one behind, as places from the start of the
    shared stretch, and its tokens up to there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(spec.vocabulary)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for piece, last, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                ends = known.ends(text)

                def tokens(place: int | None, ends: np.ndarray = ends) -> int | None:
                    n = None if place is None else int(np.searchsorted(ends, place, "right"))
                    return n if n and ends[n - 1] == place else None

                head = known.stable(text, 1, overlap - 1) if piece else None
                tail = None if last else known.stable(text, chunk + 1, chunk + overlap - 1)
                values = (head, tokens(head), None if tail is None else tail - chunk, tokens(tail), ends.size)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(c, pa.int64()) for c in out)],
                names=["row", "piece", "last", "head", "before", "tail", "until", "tokens"],
            )

    return task


def spliced(texts: DataFrame, spec: TokenCounts) -> DataFrame:
    """(row, n_tokens) of the non-empty ``texts`` (row, text), whose rows are stored and differ.

    The chunks of one document are encoded in many tasks. Up to a splice the chunk before counts, from it on the one
    behind. A document with a failed splice is cut again with overlaps, and where needed chunks, eight times as long.
    """
    done, open_, chunk, overlap = [], texts, spec.chunk, spec.overlap
    while True:
        cut = open_.mapInArrow(_cut(chunk, overlap), "row long, piece int, last boolean, text string")
        chunks = written(
            cut.repartition("row", "piece").mapInArrow(
                _splices(spec, chunk, overlap),
                "row long, piece int, last boolean, head long, before long, tail long, until long, tokens long",
            ),
            "chunk-counts",
        )
        behind = chunks.where("piece > 0").select("row", (F.col("piece") - 1).alias("piece"), F.col("head").alias("next_head"), F.col("before").alias("next_before"))
        met = (F.col("tail") == F.col("next_head")) & F.col("until").isNotNull() & F.col("next_before").isNotNull()
        part = F.when(F.col("last"), F.col("tokens")).when(met, F.col("until") - F.col("next_before"))
        sums = written(
            chunks.join(behind, ["row", "piece"], "left").groupBy("row").agg(F.sum(part).alias("n_tokens"), F.bool_or(part.isNull()).alias("failed")),
            "document-counts",
        )
        done.append(sums.where("NOT failed").select("row", "n_tokens"))
        failed = sums.where("failed").select("row")
        if failed.isEmpty():
            break
        open_ = written(open_.join(failed, "row", "left_semi"), "cut-again")
        overlap *= 8
        chunk = max(chunk, overlap)
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def token_counts(docs: DataFrame, spec: TokenCounts) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``n_tokens`` is what the library gives for the whole text, without begin and end. Null and empty texts have no
    tokens; repeated rows, ids and null ids are rows of their own. Other columns are not read.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    huge = F.length("text") > spec.huge
    short = sized.where(~huge).mapInArrow(_whole(spec), "doc_id long, n_bytes long, n_tokens long")
    long = written(sized.where(huge).withColumn("row", F.monotonically_increasing_id()), "huge-texts")
    if not long.isEmpty():
        counted = spliced(long.select("row", "text"), spec)
        short = short.union(long.drop("text").join(counted, "row").select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > spec.limit)
