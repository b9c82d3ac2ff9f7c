"""Date predicates written so that Parquet can use them.

``to_date(ts) > d`` or ``year(ts) >= y`` hide the column inside a function,
and Spark does not push such predicates into the scan.  These helpers
rewrite them as plain comparisons of the raw column with a literal of the
column's own type, with the same meaning, so they show up in
``PushedFilters`` and prune row groups by their min/max statistics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal_for(df: DataFrame, column: str, day: dt.date) -> Column:
    t = df.schema[column].dataType
    if isinstance(t, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'")
    if isinstance(t, T.TimestampType):
        return F.expr(f"TIMESTAMP '{day.isoformat()} 00:00:00'")
    return F.lit(day)


def _is_time(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType))


def date_after(df: DataFrame, column: str, day: dt.date) -> Column:
    """``to_date(column) > day``."""
    if _is_time(df, column):
        return F.col(column) >= _literal_for(df, column, day + dt.timedelta(days=1))
    return F.col(column) > _literal_for(df, column, day)


def date_before(df: DataFrame, column: str, day: dt.date) -> Column:
    """``to_date(column) < day``."""
    return F.col(column) < _literal_for(df, column, day)


def date_between_exclusive(df: DataFrame, column: str, after: dt.date, before: dt.date) -> DataFrame:
    """Rows whose date is strictly after ``after`` and strictly before ``before``."""
    return df.filter(date_after(df, column, after) & date_before(df, column, before))


def year_at_least(df: DataFrame, column: str, year: int) -> DataFrame:
    """``year(column) >= year`` as a range on the raw column."""
    return df.filter(F.col(column) >= _literal_for(df, column, dt.date(year, 1, 1)))


def year_equals(df: DataFrame, column: str, year: int) -> DataFrame:
    """``year(column) = year`` as a half-open range on the raw column."""
    lo = _literal_for(df, column, dt.date(year, 1, 1))
    hi = _literal_for(df, column, dt.date(year + 1, 1, 1))
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))
