"""Rescaling of series: z-score, base-100 index, min-max.

Per-key figures (mean and population deviation, first value, min and max)
come from one grouped aggregate joined back on the key
(``operators.keyed``), so a hot key never lands whole in one task.
Divisions use ``try_divide``: a constant series gives null instead of an
ANSI ``DIVIDE_BY_ZERO`` failure (the reference's libraries give NaN).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.operators.keyed import with_key_aggregates


def _names(prefix: str, cols: Sequence[str]) -> dict[str, str]:
    return {c: f"__{prefix}_{i}" for i, c in enumerate(cols)}


def zscore(df: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = (), suffix: str = "_Z") -> DataFrame:
    """``(x - mean) / std`` per key with the population deviation (ddof 0)."""
    mu, sd = _names("mu", value_cols), _names("sd", value_cols)
    aggs = [F.avg(c).alias(mu[c]) for c in value_cols] + [F.stddev_pop(c).alias(sd[c]) for c in value_cols]
    out = with_key_aggregates(df, keys, aggs)
    out = out.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - F.col(mu[c]), F.col(sd[c])) for c in value_cols})
    return out.drop(*mu.values(), *sd.values())


def base100(
    df: DataFrame, value_cols: Sequence[str], order_col: str, keys: Sequence[str] = (), suffix: str = "_B100"
) -> DataFrame:
    """``x / first(x) * 100`` per key, first in ``order_col`` order
    (``min_by``, an aggregate, instead of an ordered window)."""
    first = _names("first", value_cols)
    aggs = [F.min_by(F.col(c), F.col(order_col)).alias(first[c]) for c in value_cols]
    out = with_key_aggregates(df, keys, aggs)
    out = out.withColumns({f"{c}{suffix}": F.try_divide(F.col(c), F.col(first[c])) * 100 for c in value_cols})
    return out.drop(*first.values())


def minmax(df: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = (), suffix: str = "_MINMAX") -> DataFrame:
    """``(x - min) / (max - min)`` per key, in [0, 1]."""
    lo, hi = _names("lo", value_cols), _names("hi", value_cols)
    aggs = [F.min(c).alias(lo[c]) for c in value_cols] + [F.max(c).alias(hi[c]) for c in value_cols]
    out = with_key_aggregates(df, keys, aggs)
    out = out.withColumns(
        {f"{c}{suffix}": F.try_divide(F.col(c) - F.col(lo[c]), F.col(hi[c]) - F.col(lo[c])) for c in value_cols}
    )
    return out.drop(*lo.values(), *hi.values())


def scale_all(
    df: DataFrame,
    value_cols: Sequence[str],
    keys: Sequence[str] = (),
    order_col: str | None = None,
    methods: Sequence[str] = ("z", "b100", "minmax"),
) -> DataFrame:
    """z-score, base-100 and min-max together: one aggregate, one join."""
    mu, sd, first = _names("mu", value_cols), _names("sd", value_cols), _names("first", value_cols)
    lo, hi = _names("lo", value_cols), _names("hi", value_cols)
    aggs = []
    if "z" in methods:
        aggs += [F.avg(c).alias(mu[c]) for c in value_cols] + [F.stddev_pop(c).alias(sd[c]) for c in value_cols]
    if "b100" in methods:
        if order_col is None:
            raise ValueError("base-100 needs order_col")
        aggs += [F.min_by(F.col(c), F.col(order_col)).alias(first[c]) for c in value_cols]
    if "minmax" in methods:
        aggs += [F.min(c).alias(lo[c]) for c in value_cols] + [F.max(c).alias(hi[c]) for c in value_cols]
    out = with_key_aggregates(df, keys, aggs)
    new = {}
    for c in value_cols:
        if "z" in methods:
            new[f"{c}_Z"] = F.try_divide(F.col(c) - F.col(mu[c]), F.col(sd[c]))
        if "b100" in methods:
            new[f"{c}_B100"] = F.try_divide(F.col(c), F.col(first[c])) * 100
        if "minmax" in methods:
            new[f"{c}_MINMAX"] = F.try_divide(F.col(c) - F.col(lo[c]), F.col(hi[c]) - F.col(lo[c]))
    helpers = [n for d in (mu, sd, first, lo, hi) for n in d.values() if n in out.columns]
    return out.withColumns(new).drop(*helpers)
