"""Near-duplicate lines across documents: character-shingle MinHash, banding, exact verification, union-find.

Lines are compared in a normal form (lower case, single spaces). Equal normal forms collapse at once; distinct
ones are linked when their sets of character shingles are similar enough. Of every component of linked lines
the first by (doc_id, line number) stays, all others are cut out of their documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batches_of, bounded_broadcast, components, dealt, portions, prepare, undealt, unused
from tallyloom.llm.shingles import band_keys, mixed
from tallyloom.llm.similar import Measure, links_of
from tallyloom.plans.durable import written

_U = np.uint64
# Numbers that are worked on at once.
PIECE = 65_536


@dataclass(frozen=True)
class LineDuplicates:
    """Lines of at least ``least`` normalised code points are compared by sets of runs of ``size`` code points (a shorter
    line is one run), linked when 100 * intersection >= percent * union. ``bands`` of ``rows`` coordinates find a pair at similarity s with
    probability 1 - (1 - s**rows)**bands: 0.998 at 0.8 and 0.99999 at 0.9 with 12 bands of 4.
    Shorter lines, of at least ``equal`` code points, collapse only if their normal forms are equal."""

    size: int = 8
    percent: int = 80
    least: int = 16
    bands: int = 12
    rows: int = 4
    equal: int = 16

    def measure(self) -> Measure:
        return Measure(
            partial(char_shingles, size=self.size),
            partial(char_minhash, length=self.bands * self.rows),
            self.percent,
            self.rows,
            max(0.0, self.percent / 100 - 0.35),
            partial(line_sets, size=self.size),
            partial(char_minhashes, length=self.bands * self.rows),
        )


# All lines that are not blank are compared.
ALL_LINES = LineDuplicates(least=1, equal=1)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def line_key(line: str) -> int:
    """A signed 64-bit hash that stands for a normalised line."""
    value = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


@cache
def _factors(seed: int, n: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(1, 2**62, n).astype(_U) * _U(2) + _U(1)


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` code points, in pieces that stay in the processor's cache."""
    factors = _factors(41, size)
    total = np.zeros(max(0, codes.size - size + 1), _U)
    for first in range(0, total.size, PIECE // 4):
        piece = total[first : first + PIECE // 4]
        wide = codes[first : first + piece.size + size - 1].astype(_U)
        product = np.empty_like(piece)
        for j in range(size):
            piece += np.multiply(wide[j : j + piece.size], factors[j], out=product)
        piece[:] = mixed(piece)
    return total


def _codes(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")


def char_shingles(line: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one normalised line; a shorter line is one shingle."""
    return line_sets([line], size)[0]


def line_sets(lines: Sequence[bytes], size: int) -> list[np.ndarray]:
    """``char_shingles`` of several lines at once."""
    codes, starts, ends = _joined([x.decode("utf-8", "surrogatepass") for x in lines], size)
    hashes = _rolled(codes, size)
    sets = []
    for first, last in zip(starts.tolist(), ends.tolist(), strict=True):
        some = np.sort(hashes[first:last])
        new = np.empty(some.size, bool)
        new[0] = True
        np.not_equal(some[1:], some[:-1], out=new[1:])
        sets.append(some[new])
    return sets


def _joined(lines: Sequence[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of lines one after another, and where the runs of each line start and end.

    Between two lines lie the runs that reach into the next one: one for each code point of a run but the first, and the break.
    """
    lines = [x.ljust(size, "\0") for x in lines]
    counts = np.array([len(x) for x in lines]) - size + 1
    ends = np.cumsum(counts + size) - size
    return _codes("\n".join(lines)), ends - counts, ends


@cache
def _multipliers(length: int) -> np.ndarray:
    return np.random.RandomState(43).randint(0, 2**31, length).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def char_minhash(elements: np.ndarray, length: int) -> np.ndarray:
    """Signature of one set of shingle hashes: the minimum under ``length`` multiplicative permutations."""
    return char_minhashes([elements], length)[0]


def char_minhashes(sets: Sequence[np.ndarray], length: int) -> np.ndarray:
    """``char_minhash`` of several sets, which are not empty, at once."""
    ends = np.cumsum([x.size for x in sets])
    return _signatures(np.concatenate(sets), np.append(0, ends[:-1]), ends, length)


def _signatures(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Signatures of the non-empty sets between ``starts`` and ``ends``, in pieces that stay in the processor's cache."""
    out = np.empty((starts.size, length), np.uint32)
    values = (flat >> _U(32)).astype(np.uint32)
    first = 0
    while first < starts.size:
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, "right")))
        piece = values[starts[first] : ends[last - 1]]
        # Every other stretch is a set, those between are left out.
        at = np.stack([starts[first:last], ends[first:last]], axis=1).ravel()[:-1] - starts[first]
        product = np.empty_like(piece)
        for k, a in enumerate(_multipliers(length)):
            out[first:last, k] = np.minimum.reduceat(np.multiply(piece, a, out=product), at)[::2]
        first = last
    return out


def _line_bands(lines: list[str], spec: LineDuplicates) -> np.ndarray:
    """Band keys of several normalised lines at once."""
    codes, starts, ends = _joined(lines, spec.size)
    return band_keys(_signatures(_rolled(codes, spec.size), starts, ends, spec.bands * spec.rows), spec.rows)


def _long_lines(text: str | None, least: int) -> list[tuple[int, str]]:
    """(number, normal form) of the lines that are compared."""
    found = []
    for number, line in enumerate((text or "").lower().split("\n")):
        if len(line) >= least:
            # The only printable white space is the blank.
            line = line.strip(" ") if line.isprintable() and "  " not in line else " ".join(line.split())
            if len(line) >= least:
                found.append((number, line))
    return found


# Lines a task remembers to have sketched or sent before.
SEEN = 500_000


class _Seen(set):
    """Line keys that came up before in a task; forgetting some costs work only."""

    def first(self, key: int) -> bool:
        if key in self:
            return False
        if len(self) >= SEEN:
            self.clear()
        self.add(key)
        return True


def _sketch(spec: LineDuplicates):
    """Every line with its key, and its band keys where the task meets it first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            docs, rows, numbers, lines = [], [], [], []
            for doc_id, row, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for number, line in _long_lines(text, min(spec.least, spec.equal)):
                    docs.append(doc_id), rows.append(row), numbers.append(number), lines.append(line)
            for some in portions(lines, 1 << 18):
                ids = [line_key(x) for x in lines[some]]
                compared = [len(x) >= spec.least and seen.first(i) for x, i in zip(lines[some], ids, strict=True)]
                new = [x for x, yes in zip(lines[some], compared, strict=True) if yes]
                keys = _line_bands(new, spec) if new else np.empty((0, spec.bands), np.int64)
                packed = iter(keys.view(f"V{8 * spec.bands}").ravel().tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[some], pa.int64()), pa.array(rows[some], pa.int64()), pa.array(numbers[some], pa.int32()),
                        pa.array(ids, pa.int64()), pa.array([next(packed) if yes else None for yes in compared], pa.binary()),
                    ],
                    names=["doc_id", "row", "line", "id", "bands"],
                )

    return task


def _texts(spec: LineDuplicates):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            found = {x for text in batch.column(0).to_pylist() for _, x in _long_lines(text, spec.least)}
            keyed = [(key, x) for x in found if seen.first(key := line_key(x))]
            for some in portions([x for _, x in keyed], 1 << 22):
                keys, lines = zip(*keyed[some], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.string())], names=["id", "text"])

    return task


# Places that a task compares at once before they are dealt by class.
PLACES = 1_000_000


def _later(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    """Marks all places of a class to cut but the first of those not yet marked."""
    table = pa.Table.from_batches(batches)
    known, *place = (table.column(c).to_numpy() for c in ("cut", "class", "doc_id", "line", "row"))
    before = [x[known] for x in place]
    place = [x[~known] for x in place]
    order = np.lexsort(place[::-1])
    place = [x[order] for x in place]
    # A row that is repeated gives the same place again, which counts once.
    same = np.ones(max(0, order.size - 1), bool)
    for x in place:
        same &= x[1:] == x[:-1]
    place = [np.delete(x, np.flatnonzero(same) + 1) for x in place]
    later = np.append(False, place[0][1:] == place[0][:-1])[: place[0].size]
    cut = np.append(np.ones(before[0].size, bool), later)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.append(a, b)) for a, b in zip(before, place, strict=True)), pa.array(cut)],
        names=["class", "doc_id", "line", "row", "cut"],
    )


def _marked(at_once: int | None = None):
    """Marks places to cut, among so many at once or among all of a partition."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if at_once and n >= at_once:
                yield _later(held)
                held, n = [], 0
        if n:
            yield _later(held)

    return task


# Places of one part, which a task holds at once.
PART_PLACES = 200_000

_KINDS = {"class": np.int64, "doc_id": np.int64, "line": np.int32, "row": np.int64, "cut": np.bool_}
_LINE_KINDS = {x: _KINDS[x] for x in ("doc_id", "row", "line")}


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(values.view(_U)) % _U(parts)).astype(np.int32)


def _places(parts: int):
    """Places, marked as far as a task can tell, dealt as arrays by class, those to cut by document and line."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _marked(PLACES)(batches):
            place = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in _KINDS}
            yield dealt(_part(np.where(place["cut"], place["row"] + place["line"], place["class"]), parts), place)

    return task


def _cut_places(parts: int):
    """The places to cut of all that are dealt to a partition, dealt as arrays by document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = dict(zip(_KINDS, undealt(batches, [*_KINDS.values()]), strict=True))
        if place["cut"].size:
            marked = _later([pa.RecordBatch.from_arrays([pa.array(place[x]) for x in _KINDS], names=[*_KINDS])])
            marked = marked.filter(marked.column("cut"))
            place = {x: marked.column(x).to_numpy() for x in _LINE_KINDS}
            yield dealt(_part(place["row"], parts), place)

    return task


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, lines) of the places to cut; all places of a document are in one partition."""
    doc_id, row, line = undealt(batches, [*_LINE_KINDS.values()])
    order = np.lexsort((line, row, doc_id))
    doc_id, row, line = doc_id[order], row[order], line[order]
    doc = np.ones(line.size, bool)
    doc[1:] = (doc_id[1:] != doc_id[:-1]) | (row[1:] != row[:-1])
    # A row that is repeated gives the same place again.
    new = doc.copy()
    new[1:] |= line[1:] != line[:-1]
    doc_id, row, line, doc = doc_id[new], row[new], line[new], doc[new]
    first = np.append(np.flatnonzero(doc), line.size)
    for at in range(0, first.size - 1, PLACES // 16):
        ends = first[at : at + PLACES // 16 + 1]
        lines = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(line[ends[0] : ends[-1]]))
        yield pa.RecordBatch.from_arrays([pa.array(doc_id[ends[:-1]]), pa.array(row[ends[:-1]]), lines], names=["doc_id", "row", "lines"])


def row_key(docs: DataFrame) -> Column:
    """Tells rows of one doc_id with other texts apart; full copies have one key."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def duplicate_lines(docs: DataFrame, spec: LineDuplicates | None = None) -> DataFrame:
    """The lines of ``docs`` (doc_id, text) to cut: doc_id, row, lines (array of line numbers from 0).

    One row per document with lines to cut. A document is a doc_id with a text, which ``row`` is ``row_key`` of; repeated
    rows are one document, another text under a doc_id is another one. Of all places of a component the first by
    doc_id, line number and row stays. Rows without doc_id take no part. Lines shorter than ``spec.least`` are cut
    as copies only, those shorter than ``spec.equal`` too never. Other columns are not read.
    """
    spec = spec or LineDuplicates()
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("row"), F.col("text").cast("string"))
    docs = docs.where("doc_id IS NOT NULL AND text <> ''")
    sketches = written(docs.mapInArrow(_sketch(spec), "doc_id long, row long, line int, id long, bands binary"), "lines")
    bands = sketches.where("bands IS NOT NULL").select("id", "bands")
    texts = docs.select("text").mapInArrow(_texts(spec), "id long, text string")
    places = sketches.count()
    links = links_of(bands, texts, spec.measure(), "line", places * spec.bands)
    named = written(components(links, "a", "b"), "line-components")
    classed = sketches.select("doc_id", "row", "line", "id").join(bounded_broadcast(named), F.col("id") == F.col("node"), "left").select(
        F.coalesce("component", "id").alias("class"), "doc_id", "line", "row", F.lit(False).alias("cut")
    )
    # What a task can tell to be cut is not dealt by class, so of a class come at most a few places from each task.
    parts = max(1, -(-places // PART_PLACES))
    arrays = {n: f"part int, {', '.join(f'{x} binary' for x in kinds)}" for n, kinds in (("all", _KINDS), ("cut", _LINE_KINDS))}
    own = classed.mapInArrow(_places(parts), arrays["all"]).repartitionById(parts, "part")
    cut = own.mapInArrow(_cut_places(parts), arrays["cut"]).repartitionById(parts, "part")
    return cut.mapInArrow(_cut_lines, "doc_id long, row long, lines array<int>")


def without_duplicate_lines(docs: DataFrame, spec: LineDuplicates | None = None, lines: str = "_lines", cut: str = "_cut") -> DataFrame:
    """``docs`` with all columns, less the lines to cut, plus columns ``lines`` and ``cut``: lines before, and lines cut.

    A document keeps its text unchanged if nothing is cut; a text of which nothing is left is empty. Null texts
    and rows without doc_id stay as they are. Raises ValueError where ``docs`` has a column of these names.
    """
    if {lines.lower(), cut.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {lines} and {cut} must be new")
    doc, row, lost = (unused(docs, n) for n in ("doc", "row", "lost"))
    found = duplicate_lines(docs, spec).toDF(doc, row, lost)
    with batches_of(docs.sparkSession, PLACES // 16):
        cuts = written(found, "line-cuts")
    same = (docs["doc_id"].cast("long") == F.col(doc)) & (row_key(docs) == F.col(row))
    joined = docs.join(bounded_broadcast(cuts, F.size(lost)), same, "left")
    parts, breaks = F.split("text", "\n", -1), F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    left = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(F.col(lost), i)), "\n")
    return (
        joined.withColumn(lines, F.coalesce(breaks + 1, F.lit(0)).cast("long"))
        .withColumn(cut, F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost)).cast("long"))
        .withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(left))
        .drop(doc, row, lost)
    )
