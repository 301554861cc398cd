"""Spelling variants: words of the corpus that differ by one code point, by composing finite-state machines.

The vocabulary is an acceptor. Composed with a transducer that makes exactly one edit and with the acceptor again,
it accepts the pairs of near words. A product state before the edit is one state of the acceptor, since both sides
have read the same prefix; behind the edit it is two states, and what both still accept ends the pair.

The work is dealt by initial states. A prefix that few enough words share is one, and its task holds the minimised
acceptor of what may follow. States above these are too wide for one task. Their edits are found by a join instead:
both words then agree in all but one place before a known depth, so they meet in the hash of the word without it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_broadcast, prepare
from tallyloom.plans.durable import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Distinct words a task counts before it hands them on.
COUNTED = 200_000
# Rows of one Arrow batch that a task returns.
ROWS = 1 << 17


@dataclass(frozen=True)
class Variants:
    """Words have ``letters`` code points and occur ``often`` times at least; the form of a word occurs ``times`` as often.
    One run in ``slip`` loses a code point. At most ``words`` words share an initial state; words of ``long`` code
    points or more are compared by the join alone, which costs their length."""

    letters: int = 6
    often: int = 5
    times: int = 5
    slip: int = 199
    words: int = 10_000
    long: int = 64


def slipped(word: str, doc_crc: int, slip: int) -> str:
    """The word, less a code point if ``slip`` divides the checksum that goes on from the document's."""
    mark = zlib.crc32(word.encode(), doc_crc)
    if mark % slip:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1 :]


def _occurrences(spec: Variants) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                # Lower case of bytes changes A-Z alone.
                found = Counter(map(re.Match.group, RUN.finditer((text.as_py() or b"").lower().decode())))
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in found.items():
                    if len(word) < spec.letters:
                        continue
                    if doc_id is not None:
                        word = slipped(word, start, spec.slip)
                    if len(word) >= spec.letters:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield rows(total)
                    total.clear()
        yield rows(total)

    return task


def vocabulary_of(docs: DataFrame, spec: Variants) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough. Counts are added up before they are shuffled."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = texts.mapInArrow(_occurrences(spec), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= spec.often)


class Acceptor:
    """The minimal acyclic acceptor of a few words: states with equal futures are one state."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self._register: dict[tuple, int] = {}
        self._shared: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}
        self.start = self._state(0, len(self.words), 0)

    def _state(self, low: int, high: int, depth: int) -> int:
        """The state behind ``depth`` letters, which the words from ``low`` to ``high`` have in common."""
        final = low < high and len(self.words[low]) == depth
        at, arcs = low + final, {}
        while at < high:
            letter, end = self.words[at][depth], at + 1
            while end < high and self.words[end][depth] == letter:
                end += 1
            arcs[letter] = self._state(at, end, depth + 1)
            at = end
        key = (final, *arcs.items())
        if key not in self._register:
            self._register[key] = len(self.arcs)
            self.final.append(final)
            self.arcs.append(arcs)
        return self._register[key]

    def shared(self, p: int, q: int) -> list[str]:
        """What both states accept: the product of the acceptor with itself behind the edit."""
        key = (p, q) if p < q else (q, p)
        if key not in self._shared:
            ends = [""] if self.final[p] and self.final[q] else []
            other = self.arcs[q]
            for letter, to in self.arcs[p].items():
                if letter in other:
                    ends += [letter + rest for rest in self.shared(to, other[letter])]
            self._shared[key] = ends
        return self._shared[key]

    def pairs(self, p: int) -> list[tuple[str, str]]:
        """All pairs one edit apart that the composition accepts from state ``p`` on, each once."""
        if p not in self._edits:
            found, arcs = [], list(self.arcs[p].items())
            for i, (c, to) in enumerate(arcs):
                for d, other in arcs[i + 1 :]:
                    found += [(c + rest, d + rest) for rest in self.shared(to, other)]
                # Of a row of equal letters the last one counts as the inserted one.
                found += [(rest, c + rest) for rest in self.shared(p, to) if not rest.startswith(c)]
                found += [(c + x, c + y) for x, y in self.pairs(to)]
            self._edits[p] = found
        return self._edits[p]


def _accepted(rows: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one initial state."""
    depth = int(rows["depth"].iloc[0])
    prefix = rows["word"].iloc[0][:depth]
    machine = Acceptor([w[depth:] for w in rows["word"]])
    found = [(prefix + x, prefix + y) for x, y in machine.pairs(machine.start)]
    return pd.DataFrame({"a": [min(p) for p in found], "b": [max(p) for p in found]}, dtype="object")


def initial_states(words: DataFrame, spec: Variants) -> DataFrame:
    """(word, depth, whole): words dealt to the shortest prefixes that at most ``spec.words`` words share.

    ``depth`` is the length of the prefix. ``whole`` marks words that are a wider prefix themselves and very long
    ones; no task holds them, the join has all their places.
    """
    length = F.length("word")
    open_, done, depth = words.where(length <= spec.long).select("word"), [], 0
    while True:
        prefix = F.substring("word", 1, depth)
        wide = written(
            open_.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > spec.words), "wide-states"
        )
        if wide.isEmpty():
            break
        marked = open_.join(bounded_broadcast(wide.select("prefix")), prefix == F.col("prefix"), "left")
        marked = written(marked.select("word", F.col("prefix").isNotNull().alias("wide")), "states")
        ends = F.col("wide") & (length == depth)
        done.append(marked.where(~F.col("wide") | ends).select("word", F.lit(depth).alias("depth"), ends.alias("whole")))
        open_ = marked.where(F.col("wide") & (length > depth)).select("word")
        depth += 1
    done.append(open_.select("word", F.lit(depth).alias("depth"), F.lit(False).alias("whole")))
    # Words of exactly ``long`` code points meet longer ones in the join, shorter ones in a task.
    done.append(words.where(length >= spec.long).select("word", length.alias("depth"), F.lit(True).alias("whole")))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


_PRIMES = (np.uint64(2_147_483_647), np.uint64(2_147_483_629))
_BASES = (np.uint64(1_000_003), np.uint64(69_069))


@cache
def _powers(base: np.uint64, prime: np.uint64, doublings: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    for _ in range(doublings):
        out = np.concatenate([out, out * (out[-1] * base % prime) % prime])
    return out


def without_each(word: str, places: int) -> tuple[np.ndarray, int]:
    """Hashes of the word without its letter at each of the first ``places`` places, and the hash of the word."""
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
    keys, whole = np.zeros(places, np.uint64), 0
    for prime, base in zip(_PRIMES, _BASES, strict=True):
        powers = _powers(base, prime, codes.size.bit_length())
        # Behind the missing letter all others stand one place earlier.
        here = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[: codes.size] % prime)])
        earlier = np.concatenate([[np.uint64(0)], np.cumsum(codes[1:] * powers[: codes.size - 1] % prime)])
        at = np.arange(places)
        keys = (keys << np.uint64(31)) | ((here[at] + earlier[-1] - earlier[at]) % prime)
        whole = whole << 31 | int(here[-1] % prime)
    return keys.astype(np.int64), whole


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, place, id) of the first ``depth`` places of each word; place -1 stands for an insertion at any place,
    -2 for the whole word."""
    def rows(parts: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["key", "place", "id"])

    parts, held = [], 0
    for batch in batches:
        for word, depth, ident in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            keys, whole = without_each(word, depth)
            last = np.array([i + 1 == len(word) or word[i] != word[i + 1] for i in range(depth)], bool)
            key = np.concatenate([keys, keys[last], [whole]]).astype(np.int64)
            place = np.concatenate([np.arange(depth), np.full(int(last.sum()), -1), [-2]]).astype(np.int32)
            parts.append((key, place, np.full(key.size, ident, np.int64)))
            held += key.size
            if held >= ROWS:
                yield rows(parts)
                parts, held = [], 0
    if parts:
        yield rows(parts)


def _above(states: DataFrame) -> DataFrame:
    """The pairs whose edit lies above the initial states, or in a very long word."""
    states = states.where("depth > 0 OR whole").withColumn("id", F.xxhash64("word"))
    places = written(
        states.groupBy("word", "id").agg(F.max("depth").alias("depth")).select("word", "depth", "id")
        .mapInArrow(_places, "key long, place int, id long"), "variant-places",
    )
    x, y = (places.select("key", "place", F.col("id").alias(c)) for c in "xy")
    replaced = x.where("place >= 0").join(y, ["key", "place"]).where("x < y").select("x", "y")
    inserted = x.where("place = -1").drop("place").join(y.where("place = -2").drop("place"), "key").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    )
    named = states.select("id", "word").distinct()
    found = replaced.union(inserted).distinct()
    for c in "xy":
        found = found.join(named.select(F.col("id").alias(c), F.col("word").alias(f"w{c}")), c)
    return found.where(F.levenshtein("wx", "wy", 1) == 1).select(F.least("wx", "wy").alias("a"), F.greatest("wx", "wy").alias("b"))


def near_words(words: DataFrame, spec: Variants | None = None) -> DataFrame:
    """The pairs (a, b), a < b in code-point order, of distinct words that one edit separates, each once.

    ``words`` has a column word; other columns are not read. Repeated words count once, null and empty ones not at all.
    """
    spec = spec or Variants()
    prepare(words.sparkSession)
    words = words.select(F.col("word").cast("string")).where("word <> ''").distinct()
    states = written(initial_states(words, spec), "initial-states")
    inside = (
        states.where("NOT whole").withColumn("prefix", F.expr("substring(word, 1, depth)"))
        .groupBy("depth", "prefix").applyInPandas(_accepted, "a string, b string")
    )
    # Both ways find a pair of words that are just long enough for the second.
    return inside.union(_above(states)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): the last word reached by following forms.

    Pointers double, so the rounds are the logarithm of the longest chain. Forms must not run in circles.
    """
    ended, step = [], written(forms.select("word", F.col("form").alias("root")), "forms")
    while not step.isEmpty():
        onward = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        # A word whose root was settled before is not in ``step`` any more.
        for done in ended:
            onward = onward.union(done.toDF("at", "next"))
        joined = written(step.join(onward, F.col("root") == F.col("at"), "left").select("word", "root", "next"), "forms")
        ended.append(joined.where("next IS NULL").select("word", "root"))
        step = joined.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
    out = forms.select("word", F.col("form").alias("root")).where("false")
    for done in ended:
        out = out.union(done)
    return out


def variants(docs: DataFrame, spec: Variants | None = None) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near, form_n.

    Words are runs of Latin letters with A-Z in lower case, after slips; ``n`` counts their occurrences. ``form`` is the
    near word that occurs most often (ties: the first in code-point order) if it does so ``spec.times`` as often,
    else null, ``form_n`` its count; ``root`` ends the chain of forms and is the word itself without one.

    Null and empty texts have no words, repeated rows count each, rows without doc_id count without slips. Other columns
    are not read.
    """
    spec = spec or Variants()
    words = written(vocabulary_of(docs, spec), "vocabulary")
    pairs = written(near_words(words, spec), "near-words")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counted = both.join(words.toDF("near", "near_n"), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    frequent = -F.col("best.less") >= spec.times * F.col("n")
    found = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
