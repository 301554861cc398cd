"""Unicode normal form NFKC as a column expression inside the JVM.

A text is cut where normalisation cannot reach across: before every character that neither combines with what stands
before it nor decomposes to one that does. Runs of characters that are normal already stay as they are, so only short
segments are decomposed, ordered and composed. All tables come from ``unicodedata`` of the running Python.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE = 256
SURROGATES = range(0xD800, 0xE000)
# Where the Unicode standard has the Korean letters and syllables.
LEADING, VOWEL, TRAILING, SYLLABLE = 0x1100, 0x1161, 0x11A7, 0xAC00
N_LEADING, N_VOWEL, N_TRAILING = 19, 21, 28


@cache
def _compositions() -> dict[str, dict[str, str]]:
    """Per first character: the second ones it composes with, and what to."""
    pairs: dict[str, dict[str, str]] = {}
    for c in map(chr, range(sys.maxunicode + 1)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            first, second = (chr(int(p, 16)) for p in parts)
            # Some composites are excluded: normal texts do not hold them.
            if unicodedata.normalize("NFC", first + second) == c:
                pairs.setdefault(first, {})[second] = c
    return pairs


def _ranges(points: set[int]) -> str:
    """A regular expression class of code points, without its brackets."""
    out, ordered = [], sorted(points)
    start = previous = ordered[0]
    for p in [*ordered[1:], -1]:
        if p != previous + 1:
            out.append(f"\\x{{{start:X}}}-\\x{{{previous:X}}}")
            start = p
        previous = p
    return "".join(out)


@cache
def _classes() -> tuple[str, str, str]:
    """Characters that may join what stands before them, those that are not normal or may join, and marks."""
    seconds = {s for by_second in _compositions().values() for s in by_second}
    seconds |= {chr(VOWEL + i) for i in range(N_VOWEL)} | {chr(TRAILING + i) for i in range(1, N_TRAILING)}
    joins, special, marks = set(), set(), set()
    for p in range(sys.maxunicode + 1):
        if p in SURROGATES:
            continue
        first = unicodedata.normalize("NFKD", chr(p))[0]
        if unicodedata.combining(chr(p)):
            marks.add(p)
        if unicodedata.combining(first) or first in seconds:
            joins.add(p)
        if p in joins or unicodedata.normalize("NFKC", chr(p)) != chr(p):
            special.add(p)
    return _ranges(joins), _ranges(special), _ranges(marks)


def _lookup(values: dict[int, object], kind: str, empty: object):
    """A function from a column of one character to its value, ``empty`` for others: two array accesses."""
    used = sorted({p // PAGE for p in values})
    pages = [[values.get(page * PAGE + i, empty) for i in range(PAGE)] for page in used]
    number = {page: i + 1 for i, page in enumerate(used)}
    index = F.from_json(F.lit(json.dumps([number.get(p, 0) for p in range(used[-1] + 1)])), "array<int>")
    table = F.from_json(F.lit(json.dumps([[empty] * PAGE, *pages])), f"array<array<{kind}>>")

    def get(c: Column) -> Column:
        point = F.ascii(c)
        page = F.coalesce(F.get(index, F.shiftright(point, 8)), F.lit(0))
        return F.get(F.get(table, page), point % PAGE)

    return get


def _character(point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _composed(chars: Column, rank, seconds, composites) -> Column:
    """Starters take the marks and letters behind them that they compose with and that nothing blocks.

    Every step goes on from (text before the starter, starter, marks behind it, rank of the last of these).
    """

    def pair(starter: Column, c: Column) -> Column:
        a, b = F.ascii(starter), F.ascii(c)
        syllable = a - SYLLABLE
        korean = F.when(
            a.between(LEADING, LEADING + N_LEADING - 1) & b.between(VOWEL, VOWEL + N_VOWEL - 1),
            _character(((a - LEADING) * N_VOWEL + b - VOWEL) * N_TRAILING + SYLLABLE),
        ).when(
            syllable.between(0, N_LEADING * N_VOWEL * N_TRAILING - 1) & (syllable % N_TRAILING == 0)
            & b.between(TRAILING + 1, TRAILING + N_TRAILING - 1),
            _character(a + b - TRAILING),
        )
        listed = F.call_function("translate", c, seconds(starter), composites(starter))
        return F.coalesce(korean, F.when(F.contains(seconds(starter), c), listed))

    def step(acc: Column, c: Column) -> Column:
        r = rank(c)
        free = (acc["starter"] != "") & ((acc["marks"] == "") | (acc["last"] < r))
        one = F.when(free, pair(acc["starter"], c))

        def state(text, starter, marks, last):
            return F.struct(text.alias("text"), starter.alias("starter"), marks.alias("marks"), last.alias("last"))

        return (
            F.when(one.isNotNull(), state(acc["text"], one, acc["marks"], acc["last"]))
            .when(r == 0, state(F.concat(acc["text"], acc["starter"], acc["marks"]), c, F.lit(""), F.lit(0)))
            .otherwise(state(acc["text"], acc["starter"], F.concat(acc["marks"], c), r))
        )

    start = F.struct(F.lit("").alias("text"), F.lit("").alias("starter"), F.lit("").alias("marks"), F.lit(0).alias("last"))
    return F.aggregate(chars, start, step, lambda acc: F.concat(acc["text"], acc["starter"], acc["marks"]))


def nfkc(col: Column) -> Column:
    """The text in normal form NFKC; null stays null, empty empty.

    Time grows with the text's length, and with the square of the length of runs of combining characters.
    """
    joins, special, marks = _classes()
    points = [p for p in range(sys.maxunicode + 1) if p not in SURROGATES]
    syllables = range(SYLLABLE, SYLLABLE + N_LEADING * N_VOWEL * N_TRAILING)
    apart = {p: d for p in points if p not in syllables and (d := unicodedata.normalize("NFKD", chr(p))) != chr(p)}
    decomposed = _lookup(apart, "string", "")
    rank = _lookup({p: r for p in points if (r := unicodedata.combining(chr(p)))}, "int", 0)
    pairs = {ord(first): by_second for first, by_second in _compositions().items()}
    seconds = _lookup({p: "".join(x) for p, x in pairs.items()}, "string", "")
    composites = _lookup({p: "".join(x.values()) for p, x in pairs.items()}, "string", "")

    def characters(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit("(?s)."), 0)

    def ordered(run: Column) -> Column:
        """Marks by rank, those of equal rank as they stand; a run of other characters is one character."""
        placed = F.transform(characters(run), lambda c, i: F.struct(rank(c).alias("rank"), i.alias("i"), c.alias("c")))
        return F.when(F.length(run) == 1, run).otherwise(F.array_join(F.transform(F.array_sort(placed), lambda p: p["c"]), ""))

    def normal(segment: Column) -> Column:
        spelled = F.transform(characters(segment), lambda c: F.when(decomposed(c) != "", decomposed(c)).otherwise(c))
        runs = F.regexp_extract_all(F.array_join(spelled, ""), F.lit(f"(?s)[{marks}]+|."), 0)
        return _composed(characters(F.array_join(F.transform(runs, ordered), "")), rank, seconds, composites)

    segments = F.regexp_extract_all(col, F.lit(f"(?s)[^{special}]+(?![{joins}])|[^{joins}][{joins}]*|[{joins}]+"), 0)
    pieces = F.transform(segments, lambda s: F.when(s.rlike(f"[{special}]"), normal(s)).otherwise(s))
    return F.when(col.rlike(f"[{special}]"), F.array_join(pieces, "")).otherwise(col)
