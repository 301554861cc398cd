"""Alignment of two tokenizers over whole texts, and the corpus-wide counts of the ids that end together.

Both tokenize all of a text with a space before it. Where tokens of both end together and the next token of both
starts with a space, the ids of both are cut into windows. A window's alignment depends on its ids alone, so it is
made once per pair of id tuples and remembered. Ids linked in a window end at one byte, so the bytes of one end those
of the other: the vocabularies bound how many id pairs there can be, whatever the corpus.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import prepare
from tallyloom.plans.durable import written

SPACE = "▁"
# Entries of a worker's memory (words or windows), twice, and the bytes of the longest one kept.
KEPT = 300_000
LONGEST_KEPT = 256
# A space between two others; neither tokenizer's tokens reach across its left side.
GAP = re.compile(r"(?<=\S) (?=\S)")
# Code points that are aligned together.
SECTION = 1 << 18
# Ids of a text that its tokens' bytes do not spell.
BROKEN = (b"", b"")
# What is not remembered.
ABSENT = object()


@dataclass(frozen=True)
class Tokenizers:
    """``left`` is a byte-level file of the ``tokenizers`` library, ``right`` a file of ``sentencepiece`` with byte fallback."""

    left: str
    right: str


class Remembered(dict):
    """Values by key that are made for many keys at once; the least recent generation is forgotten."""

    def __init__(self, make: Callable[[list], list], size: Callable):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def all(self, keys: list) -> list:
        """The values of the keys, in order."""
        found = list(map(self.get, keys, repeat(ABSENT)))
        missing = {k for k, v in zip(keys, found, strict=True) if v is ABSENT}
        if missing:
            known = {k: self.older[k] for k in missing if k in self.older}
            new = list(missing - known.keys())
            if new:
                known |= zip(new, self.make(new), strict=True)
            if len(self) + len(known) > KEPT:
                self.older = dict(self)
                self.clear()
            self.update((k, v) for k, v in known.items() if self.size(k) <= LONGEST_KEPT)
            found = [known[k] if v is ABSENT else v for k, v in zip(keys, found, strict=True)]
        return found


@cache
def _letter_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Two tokenizers with the bytes of all their tokens, and what was aligned before."""

    def __init__(self, spec: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.left, self.right = Tokenizer.from_file(spec.left), SentencePieceProcessor(model_file=spec.right)
        self.left.encode_special_tokens = True
        letters = _letter_bytes()
        special = {i: t.content.encode() for i, t in self.left.get_added_tokens_decoder().items()}
        self.left_bytes = [b""] * self.left.get_vocab_size()
        for token, i in self.left.get_vocab().items():
            self.left_bytes[i] = special[i] if i in special else bytes(letters[c] for c in token)
        self.right_bytes = [
            bytes([int(p[3:5], 16)]) if self.right.is_byte(i) else p.replace(SPACE, " ").encode()
            for i in range(self.right.get_piece_size()) for p in [self.right.id_to_piece(i)]
        ]
        self.left_sizes, self.right_sizes = (np.array([len(b) for b in x], np.int64) for x in (self.left_bytes, self.right_bytes))
        self.left_spaced, self.right_spaced = (np.array([b[:1] == b" " for b in x]) for x in (self.left_bytes, self.right_bytes))
        # Ids as text with what follows them: within a group, at its end, at the end of a window.
        self.left_texts, self.right_texts = (
            np.array([[f"{i}{end}" for i in range(len(x))] for end in follow], object)
            for x, follow in ((self.left_bytes, ",|"), (self.right_bytes, ",;\n"))
        )
        # Without a piece that holds a space behind something else, words are tokenized each for itself.
        self.gaps = not any(b" " in b.lstrip(b" ") for b in self.right_bytes)
        self.words = Remembered(self._aligned_words, len)
        self.windows = Remembered(self._aligned, lambda key: len(key[0]) + len(key[1]))

    def _ids(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of texts with a space before each by both (unsigned 32-bit); both empty where the bytes of the tokens
        are not the text's."""
        out = None
        if self.gaps and all(words) and all(w == w.strip() for w in words):
            out = self._joined_ids(words)
        return out or self._single_ids(words)

    def _joined_ids(self, words: list[str]) -> list[tuple[bytes, bytes]] | None:
        """As :meth:`_ids` for words with a gap between each two, encoded as one text and cut where words end; None if
        the text is not what its tokens spell."""
        text = " ".join(words)
        data = f" {text}".encode()
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        found = []
        for ids, table, sizes in (
            (self.left.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids, self.left_bytes, self.left_sizes),
            (self.right.encode(text), self.right_bytes, self.right_sizes),
        ):
            if b"".join([table[i] for i in ids]) != data:
                return None
            ids = np.array(ids, "<u4")
            stops = np.cumsum(sizes[ids])
            last = np.searchsorted(stops, ends)
            if not np.array_equal(stops[last], ends):
                return None
            own, cuts = ids.tobytes(), ((last + 1) * 4).tolist()
            found.append([own[p:q] for p, q in zip([0, *cuts[:-1]], cuts, strict=True)])
        return list(zip(*found, strict=True))

    def _single_ids(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        spaced, a, b, out = [f" {w}" for w in words], self.left_bytes, self.right_bytes, []
        lefts = self.left.encode_batch_fast(spaced, add_special_tokens=False)
        for text, left, right in zip(spaced, lefts, self.right.encode(words, num_threads=1), strict=True):
            data, left = text.encode(), left.ids
            whole = b"".join([a[i] for i in left]) == data and b"".join([b[i] for i in right]) == data
            out.append((array("I", left).tobytes(), array("I", right).tobytes()) if whole else BROKEN)
        return out

    def _aligned_words(self, words: list[str]) -> list[tuple[str, bytes, int, int] | None]:
        """The groups and links of texts with a space before each, as :meth:`_aligned` has them, and their ids on both
        sides; None where the bytes of the tokens are not the text's."""
        ids = self._ids(words)
        sound = [x for x in ids if x != BROKEN]
        if not sound:
            return [None] * len(ids)
        # A space opens each text, so windows start where texts do.
        windows = self._windows(*(b"".join([x[side] for x in sound]) for side in (0, 1)))
        parts = zip(windows, self.windows.all(windows), strict=True)
        out = []
        for left, right in ids:
            texts, links, taken = [], [], 0
            while taken < len(left):
                (own, _), (text, found) = next(parts)
                texts.append(text)
                links.append(found)
                taken += len(own)
            out.append((";".join(texts), b"".join(links), len(left) // 4, len(right) // 4) if texts else None)
        return out

    def _aligned(self, windows: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """The groups of each window as text, and its links as (left id, right id) in one 64-bit number each."""
        a, b = (np.frombuffer(b"".join([w[side] for w in windows]), "<u4") for side in (0, 1))
        last_a, last_b = self._common(a, b)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        links = (a[last_a].astype(np.int64) << 32 | b[last_b]).tobytes()
        # The groups before the end of each window; a window ends with a group.
        stops = group_a[np.cumsum([len(w[0]) // 4 for w in windows]) - 1] + 1
        closes = np.ones(n_a.size, np.int64)
        closes[stops - 1] = 2
        # The ids of a group follow one another, first those of the left.
        parts = np.empty(a.size + b.size, object)
        parts[np.arange(a.size) + (np.cumsum(n_b) - n_b)[group_a]] = self.left_texts[last_a.astype(np.int64), a]
        parts[np.arange(b.size) + np.cumsum(n_a)[group_b]] = self.right_texts[np.where(last_b, closes[group_b], 0), b]
        texts, stops = "".join(parts.tolist()).split("\n"), (stops * 8).tolist()
        return [(text, links[p:q]) for text, p, q in zip(texts, [0, *stops], stops, strict=False)]

    def _common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each id of both ends where one of the other does."""
        ends_a, ends_b = np.cumsum(self.left_sizes[a]), np.cumsum(self.right_sizes[b])
        marks = np.zeros(ends_a[-1] + 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] += 2
        return marks[ends_a] == 3, marks[ends_b] == 3

    def _sections(self, text: str) -> Iterator[str]:
        """A text cut at single spaces into parts to be tokenized each with a space before it."""
        start = 0
        while self.gaps and len(text) - start > SECTION:
            gap = GAP.search(text, start + SECTION)
            if not gap:
                break
            yield text[start : gap.start()]
            start = gap.end()
        yield text[start:]

    def _windows(self, left: bytes, right: bytes) -> list[tuple[bytes, bytes]]:
        """The ids between verified common ends that a space-marked token of both follows."""
        a, b = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
        at_a, at_b = map(np.flatnonzero, self._common(a, b))
        spaced = np.append(self.left_spaced[a[at_a[:-1] + 1]] & self.right_spaced[b[at_b[:-1] + 1]], True)
        cut_a, cut_b = ((x[spaced] + 1) * 4 for x in (at_a, at_b))
        return [
            (left[p:q], right[r:s])
            for p, q, r, s in zip([0, *cut_a[:-1].tolist()], cut_a.tolist(), [0, *cut_b[:-1].tolist()], cut_b.tolist(), strict=True)
        ]

    def align(self, text: str) -> tuple[int, int, str, np.ndarray, np.ndarray] | None:
        """Ids of both, the checksum of the groups, and the distinct links with their counts; None without tokens.

        Works in sections, so that memory beyond the text's own is bounded by them and by the distinct links.
        """
        n_a = n_b = 0
        digest, links, times = hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for section in self._sections(text) if text else ():
            known = self.words.all(GAP.split(section) if self.gaps else [section])
            if None in known:
                return None
            digest.update(b";" * bool(n_a) + ";".join([x[0] for x in known]).encode())
            found, n = np.unique(np.frombuffer(b"".join([x[1] for x in known]), np.int64), return_counts=True)
            links, place = np.unique(np.concatenate([links, found]), return_inverse=True)
            times = np.bincount(place, np.concatenate([times, n])).astype(np.int64)
            n_a, n_b = n_a + sum([x[2] for x in known]), n_b + sum([x[3] for x in known])
        return (n_a, n_b, digest.hexdigest(), links, times) if n_a else None


@cache
def aligner(spec: Tokenizers) -> Aligner:
    return Aligner(spec)


_NONE = (0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(v.size for v in values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))


def _align(spec: Tokenizers) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(spec)
        # What is remembered has no cycles; searching it for some again and again takes a sixth of the time.
        gc.disable()
        try:
            for batch in batches:
                found = [tools.align(text.as_py() or "") or _NONE for text in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *(pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))),
                        *(_lists([f[i] for f in found]) for i in (3, 4)),
                    ],
                    names=["doc_id", "n_a", "n_b", "groups_sha256", "links", "times"],
                )
        finally:
            gc.enable()

    return task


def _weigh(links: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over each document's links, given the sorted links of the corpus."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, times = batch.column("links"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(links, own.flatten().to_numpy())
            row = np.repeat(np.arange(batch.num_rows), own.value_lengths().to_numpy())
            sums = []
            for weight in (np.ones(at.size, np.int64), best[at].astype(np.int64), counts[at]):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, times * weight)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_a", "n_b")), sums[0], *sums, batch.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return task


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, a, b, n, best): how often each pair of ids is linked in the corpus, and whether no pair of ``b`` is more often.

    Bounded by the vocabularies: the bytes of one id of a pair end those of the other.
    """
    each = aligned.select(F.explode(F.arrays_zip("links", "times")).alias("x")).select("x.links", "x.times")
    counts = each.groupBy(F.col("links").alias("link")).agg(F.sum("times").alias("n"))
    counts = written(counts.withColumn("a", F.shiftright("link", 32)).withColumn("b", F.col("link").bitwiseAND(0xFFFFFFFF)), "link-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("link", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def possible_links(spec: Tokenizers) -> int:
    """How many pairs of ids can end together at all."""
    tools = aligner(spec)
    ids: dict[bytes, list[int]] = {}
    for side, table in enumerate((tools.left_bytes, tools.right_bytes)):
        for token in filter(None, table):
            ids.setdefault(token, [0, 0])[side] += 1
    return sum(
        n * ids[token[cut:]][1 - side]
        for token, own in ids.items() for side, n in enumerate(own)
        # Equal bytes are counted from one side only.
        for cut in range(side, len(token)) if token[cut:] in ids
    )


def aligned_tokens(docs: DataFrame, spec: Tokenizers) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a token of each side that end together, which ends a group. ``n_best`` counts the links that are the
    most frequent of their right id in the corpus, ``count_sum`` adds up the frequencies of all. Texts that are
    null, empty or not what the tokens' bytes spell have no tokens: zeros and ''. Repeated rows count each; other
    columns are not read.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    aligned = written(
        texts.mapInArrow(_align(spec), "doc_id long, n_a long, n_b long, groups_sha256 string, links array<long>, times array<long>"),
        "aligned",
    )
    # The links of the corpus go to every task; their number has the vocabularies' bound.
    known = link_counts(aligned).select("link", "n", "best").orderBy("link").toArrow()
    if known.num_rows > possible_links(spec):
        raise ValueError("more links than the vocabularies allow")
    links, counts, best = (known.column(c).to_numpy() for c in ("link", "n", "best"))
    return aligned.mapInArrow(
        _weigh(links, counts, best),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
