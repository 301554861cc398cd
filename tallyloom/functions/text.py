"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EN_DASH = "–"
BRACKETS = r"[()\[\]{}<>]"
UNKNOWN = "Unknown"
STOP_WORDS = (
    "the", "and", "of", "in", "a", "to", "is", "it", "for", "on", "with", "as", "by", "an", "from", "this",
    "that", "at", "be", "are", "was", "were", "or", "but", "not",
)
LIST_NOISE = ("|", "Stars:", "'")

# Compatibility forms that can occur in a year: full-width digits, brackets, dash-like signs and spaces.
_FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_ASCII = "".join(chr(c) for c in range(0x21, 0x7F))
_SUPERSCRIPTS = "⁰¹²³⁴⁵⁶⁷⁸⁹"
_SUBSCRIPTS = "".join(chr(c) for c in range(0x2080, 0x208A))
_WIDE_SPACES = "".join(chr(c) for c in (0xA0, 0x2003, 0x2007, 0x2009, 0x202F, 0x3000))


def compat(col: Column) -> Column:
    """Fold the compatibility characters that matter in numbers to their plain form."""
    source = _FULL_WIDTH + _SUPERSCRIPTS + _SUBSCRIPTS + _WIDE_SPACES
    target = _ASCII + "0123456789" * 2 + " " * len(_WIDE_SPACES)
    return F.translate(col, source, target)


def digits_only(col: Column) -> Column:
    """Drop everything but the digits 0 to 9."""
    return F.regexp_replace(col, "[^0-9]", "")


def digits_value(col: Column) -> Column:
    """The number spelled by the digits of a text, NULL when there are none or too many."""
    return digits_only(col).try_cast("bigint")


def present(col: Column) -> Column:
    """True when a required text is neither NULL nor blank."""
    return F.coalesce(F.length(F.trim(col)) > 0, F.lit(False))


def field_count(col: Column, separator: str = ",") -> Column:
    """Number of fields of a separated line, empty ones included."""
    return F.size(F.split(col, separator, -1))


def without(col: Column, noise: Sequence[str] = LIST_NOISE) -> Column:
    """Remove each literal text in ``noise``."""
    for text in noise:
        col = F.replace(col, F.lit(text), F.lit(""))
    return col


def list_items(col: Column) -> Column:
    """Items of a comma separated cell, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def tidy_list(col: Column, noise: Sequence[str] = LIST_NOISE) -> Column:
    """A comma separated cell without noise, each comma followed by one blank; empty items stay but for final ones."""
    bare = F.regexp_replace(F.trim(without(col, noise)), r"(?:,\s*)+$", "")
    return F.regexp_replace(bare, r",\s*", ", ")


def tidy_list_distinct(col: Column, noise: Sequence[str] = LIST_NOISE) -> Column:
    """As :func:`tidy_list`, each item once, in order of first appearance."""
    return F.array_join(F.array_distinct(list_items(without(col, noise))), ", ")


def tidy_year(col: Column) -> Column:
    """A year (digits only) or a year range (kept whole); ``Unknown`` when nothing is left."""
    bare = F.trim(F.regexp_replace(compat(col), BRACKETS, ""))
    year = F.when(is_year_range(bare), bare).otherwise(digits_only(bare))
    return F.when(F.length(year) > 0, year).otherwise(F.lit(UNKNOWN))


def is_year_range(col: Column) -> Column:
    """True for a range such as ``2015–2022`` or ``2018–``, written with an en dash or between digits a hyphen."""
    return F.coalesce(col.contains(EN_DASH) | col.rlike(r"^[^0-9]*[0-9]{4}\s*-"), F.lit(False))


def words(col: Column) -> Column:
    """Lower-cased texts between white space; the first and last may be empty."""
    return F.split(F.lower(col), r"\s+")


def plain_words(col: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and underscores; the first and last may be empty."""
    return F.split(F.lower(col), "[^a-z0-9_]+")


def number_text(col: Column) -> Column:
    """The number written in a text when it is an unsigned decimal and nothing else, otherwise NULL."""
    bare = F.trim(F.replace(col, F.lit('"'), F.lit("")))
    # Fixed value that must match: what counts as an unsigned decimal.
    return F.when(bare.rlike(r"^\d+(\.\d+)?$"), bare.try_cast("double"))


def percent_text(col: Column) -> Column:
    """A number followed by a percent sign; NULL stays NULL."""
    return F.concat(col.cast("string"), F.lit("%"))
