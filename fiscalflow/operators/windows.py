"""Rolling sums and partition totals.

Ordered windows (rolling sums) run on series that are first reduced to one
row per key and period by a partial/final aggregate, so the rows a window
task holds per key are bounded by the number of periods, not by the raw row
count of a hot key.  Unordered per-group totals use an aggregate joined
back (``operators.keyed``), never an unordered window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalflow.functions._util import col
from fiscalflow.operators.keyed import with_key_aggregates


def rolling_sum_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str | Column],
    value_col: str,
    rows: int = 12,
    name: str | None = None,
) -> DataFrame:
    """Sum of the current row and the ``rows - 1`` rows before it, per key, in
    the given order (at least one row: the frame is clipped at the start).

    ``order_cols`` must make the order total (add a tie-break column when
    the period can repeat within a key), or results depend on the plan.
    """
    w = Window.partitionBy(*keys).orderBy(*[col(c) for c in order_cols]).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name or f"{value_col}_{rows}r", F.sum(col(value_col)).over(w))


def rolling_sum_months(
    df: DataFrame,
    keys: Sequence[str],
    month_col: str,
    value_col: str,
    months: int = 12,
    name: str | None = None,
) -> DataFrame:
    """Sum over the trailing ``months`` calendar months (current included) per
    key, right when months are missing or repeated.  Input rows are reduced
    to one row per (key, month) first; the output has one row per
    (key, month) with the month total and the rolling total.

    ``month_col`` is any date in the month; it is truncated to the first day.
    """
    m = F.trunc(F.to_date(col(month_col)), "month")
    monthly = df.groupBy(*keys, m.alias(month_col)).agg(F.sum(col(value_col)).alias(value_col))
    # RANGE frames need a numeric order key: months since year 0.
    idx = F.year(month_col) * 12 + F.month(month_col)
    w = Window.partitionBy(*keys).orderBy(idx).rangeBetween(-(months - 1), 0)
    return monthly.withColumn(name or f"{value_col}_{months}m", F.sum(F.col(value_col)).over(w))


def with_partition_total(
    df: DataFrame, group: Column | str, value_col: str, group_name: str, total_name: str
) -> DataFrame:
    """Every row plus the total of ``value_col`` over its group (e.g. its
    year): ``SUM(v) OVER (PARTITION BY g)`` as an aggregate joined back; the
    rows are not exchanged while the totals can be broadcast."""
    with_g = df.withColumn(group_name, col(group))
    return with_key_aggregates(with_g, [group_name], [F.sum(col(value_col)).alias(total_name)], fact_sized=True)
