"""Documents that hold benchmark questions, also with other numbers, names and units: template matching.

Texts become sequences of template tokens: numbers, units behind numbers and names inside sentences turn into
typed placeholders, other words into lower case without punctuation. A second form takes all capitalised words for
names, also those that open a sentence, and a name of several words for one. Windows of template tokens of all
documents meet those of the benchmark in a hash join. A run of windows on one diagonal is a match if the slots
agree: within the run, every value of the question has one value of the document wherever it occurs. Slots that
disagree end a run, they do not reject the document.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import unused
from tallyloom.plans.durable import written

NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"
MARKS = f"{NUMBER}{UNIT}{NAME}"
# Between the words of one name.
JOINT = "\u0004"
# Words that are units when they stand behind a number.
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonnes "
    "pound pounds lb lbs ounce ounces oz ml cl l litre litres liter liters gallon gallons s sec second seconds min "
    "minute minutes h hour hours day days week weeks month months year years percent dollar dollars cent cents euro "
    "euros degree degrees kmh mph hz khz mhz ghz watt watts kw volt volts amp amps joule joules kb mb gb tb"
).split()
# Windows of the benchmark that a broadcast may hold; each is three numbers.
BROADCAST_WINDOWS = 500_000

_NUMBER = "\\p{Nd}+(?:[.,:/]\\p{Nd}+)*"
_NAME = "\\p{Lu}(?<=[\\p{Ll}\\p{Nd},;]\\s\\p{Lu})\\p{Ll}+"
# Any capitalised word, and what stands between two of one name: a hyphen, an apostrophe or white space without a blank line.
_CAPITAL = "\\p{Lu}(?<![\\p{L}\\p{M}\\p{Nd}]\\p{Lu})\\p{Ll}[\\p{L}\\p{M}]*"
_WITHIN = f"({NAME}[\\p{{L}}\\p{{M}}]+)(?:[^\\S\\n]*\\n?[^\\S\\n]*|['’-])(?={NAME})"
# A token: a run of letters, digits and marks; single separators between digits belong to it. Most runs are plain letters.
_SIGN = f"[\\p{{L}}\\p{{M}}\\p{{Nd}}{MARKS}{JOINT}]"
_INSIDE = f"(?:[a-z]++{_SIGN}*+|{_SIGN}++)"
_TOKEN = f"{_INSIDE}(?:[.,:/](?<=\\p{{Nd}}[.,:/])(?=\\p{{Nd}}){_INSIDE})*+"


@dataclass(frozen=True)
class Templates:
    """A run must cover ``run`` template tokens (the whole item if that is shorter) by windows of ``window``
    tokens, each with ``literal`` ordinary words at least."""

    window: int = 8
    literal: int = 5
    run: int = 13


def _is_slot(token: Column) -> Column:
    return token.substr(1, 1).isin(*MARKS)


def _tokens(text: Column, openers: bool) -> Column:
    """Template tokens of a text, placeholders followed by what they stand for.

    Names are capitalised words inside sentences or, with ``openers``, all capitalised words, those in a row as one.
    """
    unit = f"{NUMBER}(\\S*)\\s+({'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\\p{{L}}\\p{{Nd}}])"
    marked = F.regexp_replace(text, _CAPITAL if openers else _NAME, f"{NAME}$0")
    if openers:
        marked = F.regexp_replace(marked, _WITHIN, f"$1{JOINT}")
    marked = F.regexp_replace(marked, _NUMBER, f" {NUMBER}$0 ")
    marked = F.lower(F.regexp_replace(marked, unit, f"{NUMBER}$1 {UNIT}$2 "))
    return F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0))


def _typed(tokens: Column) -> Column:
    """The tokens with bare placeholders."""
    return F.transform(tokens, lambda t: F.when(_is_slot(t), t.substr(1, 1)).otherwise(t))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often a lambda in ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def _windows(tokens: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` tokens by place.

    Two windows make one of up to twice the size, so the steps are the logarithm of the size.
    """

    def joined(step: int) -> Callable[[Column], Column]:
        def two(hashes: Column) -> Column:
            left = F.greatest(F.size(hashes) - step, F.lit(0))
            return F.zip_with(F.slice(hashes, 1, left), F.slice(hashes, step + 1, left), lambda a, b: F.xxhash64(a, b))

        return two

    width, hashes = 1, F.transform(tokens, lambda t: F.xxhash64(t))
    while width < size:
        step = min(width, size - width)
        hashes, width = _bound(hashes, joined(step)), width + step
    return hashes


def _items(benchmark: DataFrame, spec: Templates) -> DataFrame:
    """(item_id, openers, valued, length, size, needed, eligible) of the items with tokens, in both forms of names:
    ``size`` tokens make a window, ``needed`` a run, ``eligible`` are the places of windows with enough ordinary words."""
    text = F.col("text").cast("string")
    forms = [benchmark.select("item_id", F.lit(x).alias("openers"), _tokens(text, x).alias("valued")) for x in (False, True)]
    # Without names the forms are the same.
    named = F.exists("valued", lambda t: t.startswith(NAME))
    rows = (
        forms[0].union(forms[1].where(named))
        .withColumn("length", F.size("valued")).where("item_id IS NOT NULL AND length > 0").distinct()
        .withColumn("size", F.least(F.lit(spec.window), F.col("length")))
        .withColumn("needed", F.least(F.lit(spec.run), F.col("length")))
    )

    def ordinary(place: Column) -> Column:
        return F.size(F.filter(F.slice("valued", place + 1, F.col("size")), lambda t: ~_is_slot(t)))

    places = F.sequence(F.lit(0), F.col("length") - F.col("size"))
    return rows.withColumn("eligible", F.filter(places, lambda i: ordinary(i) >= F.least(F.lit(spec.literal), F.col("length"))))


def _keys(items: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, item_id, openers, place, size, valued, least): template windows of enough ordinary words, and the others with
    their values (in the first form only, names and ordinary words differ there no more).

    ``least`` is how many of them a run on one diagonal hits for certain: one with other windows among them may
    hit a single one.
    """
    places = F.col("length") - F.col("size") + 1
    full = F.col("needed") - F.col("size") + 1
    parts = []
    for valued in (False, True):
        tokens = F.col("valued") if valued else _typed(F.col("valued"))
        rows = items.where("NOT openers") if valued else items
        least = full if valued else F.when(F.size("eligible") == places, full).otherwise(1)
        for size in sizes:
            cut = rows.where(F.col("size") == size).select("*", F.posexplode(_windows(tokens, size)).alias("at", "key"))
            held = F.array_contains("eligible", F.col("at"))
            parts.append(cut.where(~held if valued else held).select(
                "key", "item_id", "openers", F.col("at").alias("place"), "size", F.lit(valued).alias("valued"), least.alias("least")
            ))
    return reduce(DataFrame.union, parts).distinct()


def _between(breaks: Column, end: Column, least: Column) -> Column:
    """(first, tokens) of the runs of at least ``least`` places before ``end`` that hold none of the sorted ``breaks``."""
    starts = F.concat(F.array(F.lit(0)), F.transform(breaks, lambda b: b + 1))
    runs = F.zip_with(starts, F.concat(breaks, F.array(end)), lambda a, b: F.struct(a.alias("first"), (b - a).alias("tokens")))
    return F.filter(runs, lambda r: r["tokens"] >= least)


def _places(pairs: Column, test: Callable[[Column], Column]) -> Column:
    """Places of the pairs that ``test`` holds for."""
    return F.filter(F.transform(pairs, lambda p, i: F.when(test(p), i)), lambda i: i.isNotNull())


def _slots(pairs: Column) -> Column:
    return F.array_distinct(F.filter(pairs, lambda p: _is_slot(p["q"])))


def _consistent(pairs: Column) -> Column:
    """Whether every value of the question has one value of the document."""
    return _bound(_slots(pairs), lambda s: F.size(s) == F.size(F.array_distinct(F.transform(s, lambda p: p["q"]))))


def _agreeing(pairs: Column, least: Column) -> Column:
    """(first, tokens) of the runs of at least ``least`` pairs between slots that disagree.

    Where a value of the question has another value of the document than at the slot with it before, both slots
    end a run, since neither is known to be the right one.
    """
    slots = F.filter(F.transform(pairs, lambda p, i: F.struct(p["q"], i.alias("at"), p["d"])), lambda s: _is_slot(s["q"]))

    def clashes(slots: Column) -> Column:
        def clash(s: Column, i: Column) -> Column:
            before = F.get(slots, i - 1)
            return F.when((before["q"] == s["q"]) & (before["d"] != s["d"]), F.array(before["at"], s["at"])).otherwise(F.array().cast("array<int>"))

        return F.array_sort(F.array_distinct(F.flatten(F.transform(slots, clash))))

    return _between(_bound(F.array_sort(slots), clashes), F.size(pairs), least)


def _judged(candidates: DataFrame) -> DataFrame:
    """(doc_id, item_id, openers, diagonal, runs), the runs being (first, tokens, exact) with ``first`` in the item.

    A run is kept if it has ``needed`` tokens and all values of the item, or a window of enough ordinary words and
    consistent slots. Shorter runs count together if they hit as many windows as a run of ``needed`` tokens has
    and their slots are consistent.
    """
    low = F.greatest(F.lit(0), -F.col("diagonal"))
    count = F.least(F.col("length") - low, F.size("found") - low - F.col("diagonal"))
    # Stored, so that what refers to the pairs several times does not make them anew.
    zipped = F.arrays_zip(F.slice("valued", low + 1, count).alias("q"), F.slice("found", low + F.col("diagonal") + 1, count).alias("d"))
    rows = written(
        candidates.select("doc_id", "item_id", "openers", "diagonal", "size", "needed", "eligible", low.alias("low"), zipped.alias("pairs")), "benchmark-pairs"
    )
    pairs, end = F.col("pairs"), F.size("pairs")

    def part(r: Column) -> Column:
        return F.slice(pairs, r["first"] + 1, r["tokens"])

    def ordinary(r: Column) -> Column:
        first = F.col("low") + r["first"]
        return F.size(F.filter("eligible", lambda e: (e >= first) & (e + F.col("size") <= first + r["tokens"])))

    def agreeing(r: Column) -> Column:
        runs = _agreeing(part(r), F.col("needed"))
        return F.transform(runs, lambda x: F.struct((r["first"] + x["first"]).alias("first"), x["tokens"].alias("tokens")))

    differ = _places(pairs, lambda p: p["q"] != p["d"])
    breaks = _places(pairs, lambda p: (p["q"] != p["d"]) & ~(_is_slot(p["q"]) & (p["q"].substr(1, 1) == p["d"].substr(1, 1))))
    pieces = F.filter(_between(breaks, end, F.col("size")), lambda r: ordinary(r) > 0)
    rows = written(rows.withColumn("same", _between(differ, end, F.col("needed"))).withColumn("pieces", pieces), "benchmark-pieces")
    long = F.filter("pieces", lambda r: r["tokens"] >= F.col("needed"))
    typed = F.filter(F.flatten(F.transform(long, agreeing)), lambda r: ordinary(r) > 0)
    # All pieces as one, from the start of the first to the end of the last.
    hit = F.aggregate("pieces", F.lit(0), lambda n, r: n + ordinary(r))
    together = _bound(F.col("pieces"), lambda ps: F.array(F.struct(
        F.get(ps, F.lit(0))["first"].alias("first"),
        (F.element_at(ps, -1)["first"] + F.element_at(ps, -1)["tokens"] - F.get(ps, F.lit(0))["first"]).alias("tokens"),
    )))
    agree = _consistent(F.flatten(F.transform("pieces", part)))
    spread = F.when((F.size("pieces") > 0) & (hit > F.col("needed") - F.col("size")) & agree, together)
    none = F.array().cast("array<struct<first: int, tokens: int>>")
    runs = F.concat("same", typed, F.coalesce(spread, none))
    told = F.transform(runs, lambda r: F.struct(
        (F.col("low") + r["first"]).alias("first"), r["tokens"].alias("tokens"),
        F.forall(part(r), lambda p: (p["q"] == p["d"]) | ~_is_slot(p["q"])).alias("exact"),
    ))
    return written(rows.select("doc_id", "item_id", "openers", "diagonal", told.alias("runs")), "benchmark-matches")


def matches(docs: DataFrame, benchmark: DataFrame, spec: Templates | None = None) -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, first_token, tokens, exact.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text); other columns are not read. ``first_token`` and
    ``tokens`` say where in the document the longest matching run is and how many template tokens it spans,
    ``exact`` whether all slots have the values of the item; a run with all capitalised words as names tells these only
    if there is no other. Null or empty texts and rows without an id match
    nothing; where no window of an item has enough ordinary words, only its own values match. Repeated rows give
    one row.
    """
    spec = spec or Templates()
    items = written(_items(benchmark, spec), "benchmark-items")
    # Items shorter than a window, of any of the few lengths there are, meet windows of their own length.
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [spec.window]
    keys = written(_keys(items, sizes), "benchmark-windows")
    wide = keys if keys.count() > BROADCAST_WINDOWS else F.broadcast(keys)
    with_values = not keys.where("valued").isEmpty()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL AND text <> ''")

    def windows(tokens: Column, openers: bool) -> Column:
        kinds = [_typed(tokens), tokens] if with_values and not openers else [_typed(tokens)]
        return F.array(*(_windows(kind, size) for kind in kinds for size in sizes))

    def hits(openers: bool) -> DataFrame:
        each = F.explode(_bound(_tokens(F.col("text"), openers), lambda t: windows(t, openers))).alias("keys")
        own = wide.where(F.col("openers") == openers)
        return texts.select("doc_id", each).select("doc_id", F.posexplode("keys").alias("at", "key")).join(own, "key")

    # On one diagonal every window of the item counts once.
    near = (
        hits(False).union(hits(True))
        .groupBy("doc_id", "item_id", "openers", "valued", "least", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.count_distinct("place").alias("windows"))
        .where(F.col("windows") >= F.col("least"))
    )
    near = written(near.select("doc_id", "item_id", "openers", "diagonal").distinct(), "benchmark-runs")

    def compared(openers: bool) -> DataFrame:
        some = near.where(F.col("openers") == openers)
        held = texts.join(some.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates()
        held = held.select("doc_id", _tokens(F.col("text"), openers).alias("found"))
        return some.join(held, "doc_id").join(items.where(F.col("openers") == openers), ["item_id", "openers"])

    judged = _judged(compared(False).unionByName(compared(True)))
    runs = judged.select("doc_id", "item_id", "openers", "diagonal", F.explode("runs").alias("run"))
    best = F.max(F.struct(~F.col("openers"), "run.tokens", -F.col("diagonal") - F.col("run.first"), "run.exact")).alias("best")
    return runs.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.col3")).cast("long").alias("first_token"), F.col("best.tokens").cast("long").alias("tokens"),
        "best.exact",
    )


def without_matches(docs: DataFrame, benchmark: DataFrame, spec: Templates | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; rows without doc_id stay."""
    name = unused(docs, "held")
    held = written(matches(docs, benchmark, spec).select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(held, docs["doc_id"].cast("long") == F.col(name), "left_anti")
