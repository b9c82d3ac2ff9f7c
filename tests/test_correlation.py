"""Correlation matrices by merged co-moments."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiscalflow.operators import correlation as C


def plain(x, there):
    p = x.shape[1]
    out = np.full((p, p), np.nan)
    for i in range(p):
        for j in range(p):
            on = there[:, i] & there[:, j]
            if on.sum() >= 2 and np.ptp(x[on, i]) > 0 and np.ptp(x[on, j]) > 0:
                out[i, j] = np.corrcoef(x[on, i], x[on, j])[0, 1]
    return out


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 40), st.integers(1, 4), st.integers(0, 10_000), st.lists(st.integers(0, 40), max_size=5))
def test_merged_parts_are_the_whole(n, p, seed, cuts):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, rng.uniform(0.1, 100, p), (n, p))
    x[:, 0] = 0.1 + 0.2 if seed % 3 == 0 else x[:, 0]  # a constant column stays constant
    there = rng.random((n, p)) < 0.8
    total = C.Moments.of(x[:0], there[:0])
    for lo, hi in zip([0, *sorted(cuts)], [*sorted(cuts), n], strict=True):
        total = total.merged(C.Moments.of(x[lo:hi], there[lo:hi]))
    assert np.allclose(total.pearson().filled(np.nan), plain(x, there), atol=1e-7, equal_nan=True)


@pytest.mark.parametrize("parts", [1, 7])
def test_matrix_equals_pairs(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(["a", "b", None][i % 3], *[None if rng.random() < 0.2 else float(v) for v in rng.normal(5, 2, 3)], 4.0, i) for i in range(200)]
    df = spark.createDataFrame(rows, "`k.1` string, n double, mean double, `z.y` double, c double, q long").repartition(parts)
    got = {(r[0], r.col_a, r.col_b): r.r for r in C.corr_matrix(df, keys=["k.1"]).collect()}
    assert len(got) == 3 * 25
    for a, b in (("n", "mean"), ("mean", "`z.y`"), ("n", "q"), ("n", "c"), ("c", "c")):
        for r in C.corr_pair(df.withColumnRenamed("k.1", "chave"), a, b, ["chave"]).collect():
            mine = got[(r.chave, a.strip("`"), b.strip("`"))]
            assert mine == got[(r.chave, b.strip("`"), a.strip("`"))]
            assert (mine is None and r.r is None) or abs(mine - r.r) < 1e-12
    no_keys = {(r.col_a, r.col_b): r.r for r in C.corr_matrix(df, ["n", "q"]).collect()}
    assert abs(no_keys[("n", "q")] - C.corr_pair(df, "n", "q").first().r) < 1e-12 and abs(no_keys[("q", "q")] - 1) < 1e-12
    assert C.corr_matrix(df.where("false"), ["n", "q"]).count() == 0


def test_no_row_is_unpivoted(spark):
    spark.range(3000).select((F.col("id") % 5).alias("k"), *[F.rand(i).alias(f"v{i}") for i in range(6)]).createOrReplaceTempView("corr_rows")
    plan = C.corr_matrix(spark.table("corr_rows"), [f"v{i}" for i in range(6)], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
