"""Decomposition against a numpy restatement of the classical method;
rolling windows against brute force; partition invariance."""

import numpy as np
from pyspark.sql import functions as F

from fiscalflow.operators import seasonal, windows
from tests.conftest import SF_CHECK


def classical(x, period=12):
    x = np.asarray(x, dtype=float)
    n = len(x)
    h = period // 2
    w = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = np.dot(w, x[i - h: i + h + 1])
    det = x - trend
    pa = np.array([np.nanmean(det[i::period]) for i in range(period)])
    pa -= pa.mean()
    seas = np.tile(pa, n // period + 1)[:n]
    return trend, seas, x - trend - seas


def monthly_orders(spark):
    o = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    return o.groupBy("o_orderpriority", F.trunc(F.to_date("o_orderdate"), "month").alias("m")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("v")
    )


def test_decomposition_matches_classical(spark):
    m = monthly_orders(spark)
    dec = seasonal.seasonal_decompose(m, ["o_orderpriority"], "m", ["v"]).toPandas()
    for key, g in dec.groupby("o_orderpriority"):
        g = g.sort_values("m")
        t, s, r = classical(g["v"].to_numpy())
        np.testing.assert_allclose(g["v_TREND"].to_numpy(dtype=float), t, rtol=1e-9, equal_nan=True)
        np.testing.assert_allclose(g["v_SEASONAL"].to_numpy(dtype=float), s, rtol=1e-7, atol=1e-6)
        np.testing.assert_allclose(g["v_RESID"].to_numpy(dtype=float), r, rtol=1e-7, atol=1e-6, equal_nan=True)
        assert np.isnan(t[:6]).all() and np.isnan(t[-6:]).all()


def test_decomposition_identity_and_short_series(spark):
    df = spark.createDataFrame([("a", i, float(i % 5)) for i in range(30)] + [("b", i, 1.0) for i in range(10)], "k string, m int, v double")
    out = seasonal.seasonal_decompose(df, ["k"], "m", ["v"]).collect()
    for r in out:
        if r.k == "b":
            assert r.v_TREND is None and r.v_SEASONAL is None
        elif r.v_TREND is not None:
            assert abs(r.v_TREND + r.v_SEASONAL + r.v_RESID - r.v) < 1e-9


def test_decomposition_partition_invariant(spark):
    m = monthly_orders(spark)
    a = seasonal.seasonal_decompose(m.repartition(1), ["o_orderpriority"], "m", ["v"])
    b = seasonal.seasonal_decompose(m.repartition(7, "m"), ["o_orderpriority"], "m", ["v"])
    cols = ["o_orderpriority", "m", "v_TREND", "v_SEASONAL", "v_RESID"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())  # bit-identical


def test_rolling_rows_and_months(spark):
    rows = [("a", 202401, 1), ("a", 202402, 2), ("a", 202405, 4), ("a", 202501, 8), ("a", 202502, 16), ("b", 202401, 5)]
    df = spark.createDataFrame(rows, "k string, ym int, q long")
    r12 = {(r.k, r.ym): r.q_12r for r in windows.rolling_sum_rows(df, ["k"], ["ym"], "q", 12).collect()}
    assert r12[("a", 202502)] == 31 and r12[("b", 202401)] == 5
    dated = df.withColumn("d", F.to_date(F.col("ym").cast("string"), "yyyyMM"))
    m12 = {(r.k, r.d.strftime("%Y%m")): r.q_12m for r in windows.rolling_sum_months(dated, ["k"], "d", "q", 12).collect()}
    # 2025-02 trailing 12 months = 2024-03 .. 2025-02: 4 + 8 + 16
    assert m12[("a", "202502")] == 28 and m12[("a", "202501")] == 14 and m12[("a", "202405")] == 7


def test_decomposition_null_key_is_a_series(spark):
    rows = [(None, i, float(i % 12)) for i in range(36)] + [("x", i, float(i % 12) * 2) for i in range(36)]
    df = spark.createDataFrame(rows, "k string, m int, v double")
    out = seasonal.seasonal_decompose(df, ["k"], "m", ["v"]).collect()
    assert len(out) == 72
    by = {(r.k, r.m): r for r in out}
    assert by[(None, 20)].v_SEASONAL is not None
    assert abs(by[("x", 20)].v_SEASONAL - 2 * by[(None, 20)].v_SEASONAL) < 1e-9
