"""Grouped aggregates of the analysis: sums by year and month end, median
duration, null counts, period sums, column means.

All are ``groupBy``/``agg`` with partial (map-side) aggregation, so the
shuffle carries one row per group per task, whatever the skew of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.functions._util import col
from fiscalflow.functions.dates import days_between, month_end


def sum_zero(c: str | Column) -> Column:
    """Sum where a group of only nulls gives 0, as the reference's engine
    does (Spark's ``sum`` would give null)."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def sum_by_year(
    df: DataFrame,
    date_col: str,
    value_col: str,
    year_name: str = "year",
    total_name: str = "total",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Total per calendar year of ``date_col`` (a null date is its own group),
    ordered by year with nulls first."""
    keys = list(keys)
    out = df.groupBy(*keys, F.year(col(date_col)).alias(year_name)).agg(sum_zero(value_col).alias(total_name))
    return out.orderBy(*keys, F.col(year_name).asc_nulls_first())


def sum_by_month_end(
    df: DataFrame,
    date_col: str,
    value_col: str,
    month_name: str = "month_end",
    total_name: str = "total",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Total per month, the month labelled by its last day."""
    keys = list(keys)
    out = df.groupBy(*keys, month_end(date_col).alias(month_name)).agg(sum_zero(value_col).alias(total_name))
    return out.orderBy(*keys, F.col(month_name).asc_nulls_first())


def median_days(
    df: DataFrame, end_col: str, start_col: str, keys: Sequence[str] = (), name: str = "median_days", exact: bool = True
) -> DataFrame:
    """Median of ``end - start`` in days.  ``exact`` uses ``median``
    (a sort-free percentile aggregate); at very large group sizes
    ``percentile_approx`` keeps the per-group state bounded."""
    d = days_between(end_col, start_col)
    agg = F.median(d) if exact else F.percentile_approx(d, 0.5, 10000).cast("double")
    return df.groupBy(*keys).agg(agg.alias(name))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of nulls per column, in one pass."""
    cols = list(columns) if columns else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])


def period_sums(
    df: DataFrame, keys: Sequence[str], date_col: str, value_col: str, years: Sequence[int], prefix: str = "total_"
) -> DataFrame:
    """Per key, the sum of ``value_col`` for each listed year, as columns
    (``SUM(v) FILTER (WHERE year(d) = y)``), in one pass."""
    y = F.year(col(date_col))
    aggs = [
        F.coalesce(F.sum(F.when(y == yr, col(value_col))), F.lit(0)).alias(f"{prefix}{yr}")
        for yr in years
    ]
    return df.filter(y.isin(*years)).groupBy(*keys).agg(*aggs)


def column_means(df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """One row: mean of each (numeric) column."""
    from fiscalflow.operators.extract import numeric_columns

    cols = list(columns) if columns else numeric_columns(df)
    return df.agg(*[F.avg(F.col(c)).alias(f"{c}{suffix}") for c in cols])
