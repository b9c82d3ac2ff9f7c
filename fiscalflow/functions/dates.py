"""Date column functions (lenient text parsing, month ends, year keys).

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalflow.functions._util import col

# Fixed value: the day/month/year text layout of the reference's sources.
DMY_PATTERN = r"(\d{1,2}/\d{1,2}/\d{4})"


def parse_date_lenient(c: str | Column, pattern: str = DMY_PATTERN, fmt: str = "d/M/yyyy") -> Column:
    """Find a ``dd/mm/yyyy`` date anywhere in the text; null when absent or invalid.

    ``regexp_extract`` gives ``''`` when nothing matches, and ``try_to_date``
    turns both ``''`` and impossible dates (31/02) into null.
    """
    return F.try_to_date(F.regexp_extract(col(c), pattern, 1), fmt)


def yyyymm_to_month_start(c: str | Column) -> Column:
    """Integer or text ``yyyymm`` -> first day of that month (null if malformed)."""
    return F.try_to_date(col(c).cast("string"), "yyyyMM")


def yyyymm_to_month_end(c: str | Column) -> Column:
    """Integer or text ``yyyymm`` -> last day of that month (null if malformed)."""
    return F.last_day(yyyymm_to_month_start(c))


def month_end(c: str | Column) -> Column:
    """Last day of the month of a date or timestamp, as a date."""
    return F.last_day(F.to_date(col(c)))


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (integer, may be negative)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def to_yyyymm(c: str | Column) -> Column:
    """Date -> integer ``yyyymm``."""
    d = col(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def date_text(c: str | Column, fmt: str = "dd/MM/yyyy") -> Column:
    """Date -> text in the given layout (the inverse of the lenient parse)."""
    return F.date_format(col(c), fmt)
