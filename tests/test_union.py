"""Relaxed union: supertype ladder, null fill, first-seen column order."""

import datetime as dt

from pyspark.sql import types as T

from fiscalflow.operators.union import relaxed_union, supertype


def test_ladder():
    L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
    assert supertype(I, L) == L
    assert supertype(I, D) == D
    assert supertype(T.FloatType(), D) == D
    assert supertype(T.NullType(), S) == S
    assert supertype(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert supertype(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert supertype(T.BooleanType(), I) == I
    assert supertype(T.DecimalType(10, 2), I) == T.DecimalType(12, 2)
    assert supertype(T.DecimalType(10, 2), D) == D
    assert supertype(S, I) == S
    assert supertype(T.DateType(), S) == S
    assert supertype(T.BooleanType(), T.DateType()) == S


def test_relaxed_union_values(spark):
    a = spark.createDataFrame([(1, "x", 1.5)], "id bigint, name string, v double")
    b = spark.createDataFrame([("k2", dt.date(2024, 1, 2), True)], "id string, d date, flag boolean")
    c = spark.createDataFrame([(3, 7)], "id int, v int")
    u = relaxed_union([a, b, c])
    assert u.columns == ["id", "name", "v", "d", "flag"]
    types = {f.name: f.dataType for f in u.schema.fields}
    assert types["id"] == T.StringType() and types["v"] == T.DoubleType()
    rows = sorted(u.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == ["1", "3", "k2"]
    assert rows[1].v == 7.0 and rows[2].flag is True and rows[0].d is None


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert relaxed_union([a, a, a]).count() == 3
