"""Additive seasonal decomposition of monthly series, per key.

observed = trend + seasonal + residual, as in the classical method:

* trend: centred moving average over one period (for an even period the
  two end points weigh one half), null for the first and last half period;
* seasonal: mean of (observed - trend) at each phase (position mod
  period, counted from the first row of the series), re-centred so the
  phase means average to zero, repeated along the series;
* residual: observed - trend - seasonal.

The input is one row per (key, period), already reduced by an aggregate,
so a window partition holds one series (hundreds of rows at most), never a
raw hot key.  Phase means are a grouped aggregate (period rows per key)
joined back on (key, phase).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_POS, _N, _PHASE = "__pos", "__n", "__phase"


def _ordered_sum(items, value_field: str):
    """Sum of ``value_field`` over an array of structs sorted by its first
    field, left to right: the same bits whatever the partitioning."""
    return F.aggregate(F.array_sort(items), F.lit(0.0), lambda acc, s: acc + s[value_field])


def seasonal_decompose(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_cols: Sequence[str],
    period: int = 12,
    min_cycles: int = 2,
) -> DataFrame:
    """Add ``<v>_TREND``, ``<v>_SEASONAL``, ``<v>_RESID`` for each value column.

    A series with fewer than ``min_cycles`` full periods, or with a null
    value, gets null components (the reference's library raises; one short
    series should not fail a job over thousands).

    Sums run in series order (an explicit lag/lead chain for the moving
    average, ordered folds for the phase means), so the result does not
    depend on how rows were partitioned; windows and lists stay bounded by
    the length of one series.
    """
    keys = list(keys)
    if not keys:  # one series: a constant key keeps every join an equi-join
        dec = seasonal_decompose(df.withColumn("__series", F.lit(0)), ["__series"], order_col, value_cols, period, min_cycles)
        return dec.drop("__series")
    ordered = Window.partitionBy(*keys).orderBy(F.col(order_col))
    whole = Window.partitionBy(*keys)
    out = df.withColumns(
        {
            _POS: F.row_number().over(ordered) - 1,
            _N: F.count(F.lit(1)).over(whole),
        }
    ).withColumn(_PHASE, F.col(_POS) % period)
    eligible = F.col(_N) >= min_cycles * period

    trend_cols = {}
    for v in value_cols:
        x = F.col(v).cast("double")
        if period % 2 == 0:
            h = period // 2
            terms = [0.5 * F.lag(x, h).over(ordered)]
            terms += [F.lag(x, j).over(ordered) for j in range(h - 1, 0, -1)]
            terms += [x] + [F.lead(x, j).over(ordered) for j in range(1, h)]
            terms += [0.5 * F.lead(x, h).over(ordered)]
        else:
            h = (period - 1) // 2
            terms = [F.lag(x, j).over(ordered) for j in range(h, 0, -1)]
            terms += [x] + [F.lead(x, j).over(ordered) for j in range(1, h + 1)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        ok = eligible & (F.count(x).over(whole) == F.col(_N))
        trend_cols[f"__ok_{v}"] = ok
        trend_cols[f"{v}_TREND"] = F.when(ok, total / period)
    out = out.withColumns(trend_cols)

    # Phase means of the detrended values, then centred on their mean.
    pa_aggs = []
    for i, v in enumerate(value_cols):
        d = F.col(v).cast("double") - F.col(f"{v}_TREND")
        items = F.collect_list(F.when(d.isNotNull(), F.struct(F.col(_POS).alias("k"), d.alias("d"))))
        pa_aggs.append(F.try_divide(_ordered_sum(items, "d"), F.count(d)).alias(f"__pa_{i}"))
    phase_avg = out.groupBy(*keys, _PHASE).agg(*pa_aggs)
    centre_aggs = []
    for i in range(len(value_cols)):
        items = F.collect_list(F.struct(F.col(_PHASE).alias("k"), F.col(f"__pa_{i}").alias("d")))
        centre_aggs.append(F.try_divide(_ordered_sum(items, "d"), F.count(f"__pa_{i}")).alias(f"__mu_{i}"))
    ck = {k: f"__ck{i}" for i, k in enumerate(keys)}
    centres = phase_avg.groupBy(*[F.col(k).alias(ck[k]) for k in keys]).agg(*centre_aggs)
    rk = {k: f"__sk{i}" for i, k in enumerate(keys)}
    on_key = F.lit(True)
    for k in keys:  # null-safe: a null key is a series of its own, as in groupBy
        on_key = on_key & F.col(k).eqNullSafe(F.col(ck[k]))
    seasonal = phase_avg.join(centres, on=on_key, how="inner").drop(*ck.values())
    seasonal = seasonal.select(
        *[F.col(k).alias(rk[k]) for k in keys],
        F.col(_PHASE).alias("__sphase"),
        *[(F.col(f"__pa_{i}") - F.col(f"__mu_{i}")).alias(f"{v}_SEASONAL") for i, v in enumerate(value_cols)],
    )
    cond = F.col(_PHASE) == F.col("__sphase")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(rk[k]))
    joined = out.join(seasonal, on=cond, how="left").drop("__sphase", *rk.values())
    joined = joined.withColumns({f"{v}_SEASONAL": F.when(F.col(f"__ok_{v}"), F.col(f"{v}_SEASONAL")) for v in value_cols})
    joined = joined.withColumns(
        {f"{v}_RESID": F.col(v).cast("double") - F.col(f"{v}_TREND") - F.col(f"{v}_SEASONAL") for v in value_cols}
    )
    return joined.drop(_POS, _N, _PHASE, *[f"__ok_{v}" for v in value_cols])


def deseasonalize(df: DataFrame, value_cols: Sequence[str], suffix: str = "_SEM_SAZONAL") -> DataFrame:
    """observed - seasonal, after :func:`seasonal_decompose`."""
    return df.withColumns({f"{v}{suffix}": F.col(v).cast("double") - F.col(f"{v}_SEASONAL") for v in value_cols})


def seasonal_corr(
    df: DataFrame, keys: Sequence[str], order_col: str, a: str, b: str, period: int = 12, name: str = "r"
) -> DataFrame:
    """Correlation of the seasonal components of two series, per key."""
    from fiscalflow.operators.correlation import pearson

    dec = seasonal_decompose(df, keys, order_col, [a, b], period=period)
    return dec.groupBy(*keys).agg(pearson(f"{a}_SEASONAL", f"{b}_SEASONAL").alias(name))
