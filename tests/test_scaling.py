"""Closed-form checks of the per-key scalings, on a series derived from orders."""

import math

from pyspark.sql import functions as F

from fiscalflow.operators import scaling
from fiscalflow.operators.keyed import with_key_aggregates
from tests.conftest import SF_SMALL


def monthly(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.groupBy("o_orderpriority", F.trunc(F.to_date("o_orderdate"), "month").alias("m")).agg(
        F.sum("o_totalprice").alias("v"), F.count(F.lit(1)).alias("n")
    )


def test_zscore_mean0_std1(spark):
    z = scaling.zscore(monthly(spark), ["v"], ["o_orderpriority"])
    for r in z.groupBy("o_orderpriority").agg(F.avg("v_Z").alias("mu"), F.stddev_pop("v_Z").alias("sd")).collect():
        assert abs(r.mu) < 1e-9 and abs(r.sd - 1) < 1e-9


def test_base100_first_is_100(spark):
    b = scaling.base100(monthly(spark), ["v"], "m", ["o_orderpriority"])
    firsts = b.groupBy("o_orderpriority").agg(F.min_by("v_B100", "m").alias("f")).collect()
    assert all(abs(r.f - 100) < 1e-9 for r in firsts)


def test_minmax_range(spark):
    mm = scaling.minmax(monthly(spark), ["v"], ["o_orderpriority"])
    for r in mm.groupBy("o_orderpriority").agg(F.min("v_MINMAX").alias("lo"), F.max("v_MINMAX").alias("hi")).collect():
        assert r.lo == 0.0 and r.hi == 1.0


def test_scale_all_equals_separate(spark):
    m = monthly(spark)
    a = scaling.scale_all(m, ["v", "n"], ["o_orderpriority"], "m")
    b = scaling.minmax(scaling.base100(scaling.zscore(m, ["v", "n"], ["o_orderpriority"]), ["v", "n"], "m", ["o_orderpriority"]), ["v", "n"], ["o_orderpriority"])
    cols = ["o_orderpriority", "m"] + [f"{c}{s}" for c in ("v", "n") for s in ("_Z", "_B100", "_MINMAX")]
    ra = sorted(a.select(cols).collect())
    rb = sorted(b.select(cols).collect())
    for x, y in zip(ra, rb):
        for u, w in zip(x, y):
            assert u == w or (isinstance(u, float) and math.isclose(u, w, rel_tol=1e-12))


def test_constant_series_gives_null_not_error(spark):
    df = spark.createDataFrame([("a", i, 5.0) for i in range(4)], "k string, m int, v double")
    out = scaling.scale_all(df, ["v"], ["k"], "m").collect()
    assert all(r.v_Z is None and r.v_MINMAX is None and r.v_B100 == 100.0 for r in out)


def test_global_key_and_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("b", 2.0)], "k string, v double")
    z = scaling.zscore(df, ["v"], ["k"]).collect()
    nulls = sorted(r.v_Z for r in z if r.k is None)
    assert nulls == [-1.0, 1.0]
    g = with_key_aggregates(df, [], [F.sum("v").alias("t")]).collect()
    assert all(r.t == 6.0 for r in g)
