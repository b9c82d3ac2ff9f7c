"""Plan properties: pushdown and pruning reach the scan; extraction order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fiscalflow.operators import extract
from fiscalflow.operators.filters import date_between_exclusive, year_equals
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_is_pushed_to_parquet(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    p = plan(date_between_exclusive(o, "o_orderdate", dt.date(1995, 12, 31), dt.date(2001, 2, 1)).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p
    q = year_equals(o, "o_orderdate", 1998)
    assert q.count() == o.filter(F.year("o_orderdate") == 1998).count()


def test_extract_order_filters_where_columns(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = extract.extract(li, filters=F.col("l_quantity") > 10, where="l_returnflag = 'R'", columns=["l_orderkey"])
    assert out.columns == ["l_orderkey"]
    p = plan(out)
    assert "GreaterThan(l_quantity,10.0)" in p and "EqualTo(l_returnflag,R)" in p
    assert out.count() == li.filter("l_quantity > 10 AND l_returnflag = 'R'").count()


def test_validation_errors(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    with pytest.raises(ValueError, match="not found"):
        extract.select_validated(li, ["l_orderkey", "nope"])
    with pytest.raises(ValueError, match="empty"):
        extract.select_validated(li, ["  ", ""])
    with pytest.raises(TypeError):
        extract.apply_filters(li, ["l_quantity > 1"])
    with pytest.raises(Exception):
        extract.apply_where(li, "l_quantity > 1 ORDER BY 1").collect()


def test_drop_nulls_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert extract.drop_nulls(df).count() == 2
