"""Extraction: filters, SQL predicate, validated column list, null handling.

The order is the reference's: filters, then the SQL predicate, then the
column list, so predicates may use columns that are not kept.  Catalyst
pushes all of it into the Parquet scan (``PushedFilters`` and a pruned
``ReadSchema``), which is the storage saving the reference gets by hand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from fiscalflow.functions._util import column


def normalize_columns(columns: Sequence[str] | None) -> list[str] | None:
    """Strip names and drop blanks; ``None`` means keep every column.

    An explicit list that is empty after cleaning is an error.
    """
    if columns is None:
        return None
    if isinstance(columns, str):
        columns = [columns]
    cleaned = [c.strip() for c in columns if c is not None and c.strip()]
    if not cleaned:
        raise ValueError("the column list is empty")
    return list(dict.fromkeys(cleaned))


def select_validated(df: DataFrame, columns: Sequence[str] | None, source: str = "") -> DataFrame:
    """Select the requested columns in the given order, failing early (on the
    driver, from the schema alone) with both lists when any is missing."""
    cols = normalize_columns(columns)
    if cols is None:
        return df
    available = df.columns
    missing = [c for c in cols if c not in available]
    if missing:
        where = f" in {source}" if source else ""
        raise ValueError(f"columns not found{where}: {missing}; available: {available}")
    return df.select(*[column(c) for c in cols])


def normalize_filters(filters: Column | Sequence[Column] | None) -> list[Column]:
    if filters is None:
        return []
    if isinstance(filters, Column):
        return [filters]
    out = list(filters)
    for f in out:
        if not isinstance(f, Column):
            raise TypeError(f"filters must be Column expressions, got {type(f).__name__}")
    return out


def apply_filters(df: DataFrame, filters: Column | Sequence[Column] | None) -> DataFrame:
    """AND the filters in order (one ``Filter`` node after Catalyst merges them)."""
    return reduce(lambda d, c: d.filter(c), normalize_filters(filters), df)


def apply_where(df: DataFrame, where: str | None) -> DataFrame:
    """Apply a SQL boolean expression.  ``DataFrame.where(str)`` parses exactly
    one expression, so text such as ``x = 1 ORDER BY y`` is a parse error
    rather than being spliced into a statement."""
    if where is None or not where.strip():
        return df
    return df.where(where.strip())


def extract(
    df: DataFrame,
    *,
    filters: Column | Sequence[Column] | None = None,
    where: str | None = None,
    columns: Sequence[str] | None = None,
    source: str = "",
) -> DataFrame:
    """Filters, then the SQL predicate, then the validated column list."""
    return select_validated(apply_where(apply_filters(df, filters), where), columns, source)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``subset`` (all columns by default).

    Only nulls count: ``na.drop`` would also drop NaN, which the reference
    keeps, so the predicate is written out.
    """
    cols = list(subset) if subset else df.columns
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [column(c).isNotNull() for c in cols]))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def schema_rows(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """(position, name, type, nullable) from the schema, no data read."""
    return [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]


def fill_nulls(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls with ``value`` in the columns whose type fits it."""
    return df.na.fill(value, subset=list(subset) if subset else None)
