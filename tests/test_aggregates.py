"""Grouped aggregates: null date group, all-null sums, month ends, period sums."""

import datetime as dt

from fiscalflow.operators import aggregates


def test_year_and_month_end_sums(spark):
    rows = [
        (dt.date(2024, 1, 5), 10.0), (dt.date(2024, 1, 31), 5.5), (dt.date(2024, 2, 29), 1.0),
        (dt.date(2025, 3, 1), None), (None, 2.0),
    ]
    df = spark.createDataFrame(rows, "d date, v double")
    y = [tuple(r) for r in aggregates.sum_by_year(df, "d", "v", "ano", "total").collect()]
    assert y == [(None, 2.0), (2024, 16.5), (2025, 0.0)]  # null year first; all-null sum is 0
    m = [tuple(r) for r in aggregates.sum_by_month_end(df, "d", "v", "mes", "total").collect()]
    assert m == [(None, 2.0), (dt.date(2024, 1, 31), 15.5), (dt.date(2024, 2, 29), 1.0), (dt.date(2025, 3, 31), 0.0)]


def test_period_sums_and_null_counts(spark):
    rows = [("a", dt.date(2024, 5, 1), 3), ("a", dt.date(2025, 1, 1), 4), ("b", dt.date(2024, 2, 1), 1), ("b", None, 9)]
    df = spark.createDataFrame(rows, "k string, d date, q long")
    got = {r.k: (r.total_2024, r.total_2025) for r in aggregates.period_sums(df, ["k"], "d", "q", [2024, 2025]).collect()}
    assert got == {"a": (3, 4), "b": (1, 0)}
    assert aggregates.null_counts(df).first().asDict() == {"k": 0, "d": 1, "q": 0}


def test_median_days(spark):
    rows = [("x", dt.date(2024, 1, 1), dt.date(2024, 1, 11)), ("x", dt.date(2024, 1, 1), dt.date(2024, 1, 21)),
            ("y", dt.date(2024, 1, 1), dt.date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "k string, a date, b date")
    got = {r.k: r.median_days for r in aggregates.median_days(df, "b", "a", ["k"]).collect()}
    assert got == {"x": 15.0, "y": 1.0}
    approx = {r.k: r.median_days for r in aggregates.median_days(df, "b", "a", ["k"], exact=False).collect()}
    assert approx["y"] == 1.0 and approx["x"] in (10.0, 20.0)
