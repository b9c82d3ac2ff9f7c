"""Numeric casts: decimal comma text, lenient and strict double casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.functions._util import col


def decimal_comma_to_double(c: str | Column, strict: bool = False) -> Column:
    """``'12,5'`` -> ``12.5``.

    Lenient (default): anything that is not a plain number after the comma
    swap (``'1.234,5'``, ``'abc'``) becomes null.  Strict: the ANSI cast
    raises on the first bad value, as the reference's strict cast does.
    """
    swapped = F.replace(col(c).cast("string"), F.lit(","), F.lit("."))
    return swapped.cast("double") if strict else swapped.try_cast("double")


def to_numeric(c: str | Column) -> Column:
    """Lenient cast of any value to double (null when it is not a number)."""
    return col(c).try_cast("double")


def cast_columns(df: DataFrame, casts: dict[str, Column | str]) -> DataFrame:
    """Replace columns in place (one ``withColumns``, so one projection).

    Values are either Column expressions or type names for a plain cast.
    """
    exprs = {name: (F.col(name).cast(v) if isinstance(v, str) else v) for name, v in casts.items()}
    return df.withColumns(exprs)