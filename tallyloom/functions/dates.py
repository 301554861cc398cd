"""Dates from loosely written text, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year, month and day of at most six digits, with blanks before each; what follows the day is not read.
_FIELDS = r"^[ \t]*(\d{1,6})-[ \t]*(\d{1,6})-[ \t]*(\d{1,6})"


def lenient_date(col: Column) -> Column:
    """A date written year-month-day whose fields may exceed their range and roll over, with any text behind it.

    Month 13 is January of the next year, month 0 December of the last, day 0 the last day of the month before.
    Null for null, for text without the three fields and for months outside the years 1 to 9999. Days count by
    the Gregorian calendar in all years.
    """
    year, month, day = (F.regexp_extract(col, _FIELDS, i).try_cast("int") for i in (1, 2, 3))
    months = year * 12 + month - 1
    at = F.when(months.between(12, 9999 * 12 + 11), months)
    first = F.make_date(F.floor(at / 12).cast("int"), (F.pmod(at, F.lit(12)) + 1).cast("int"), F.lit(1))
    return F.date_add(first, day - 1)
