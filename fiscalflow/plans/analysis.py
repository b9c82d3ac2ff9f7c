"""The fines-versus-index analysis, expressed on the given star-schema tables.

Mapping of the reference's sources onto the test tables:

* fines (one row per decision, text dates, money, operator id) are derived
  from ``orders``: decision date ``o_orderdate`` as ``dd/MM/yyyy`` text,
  payment date as ``'pago em dd/MM/yyyy'`` text (``'pendente'`` while an
  order is pending), value ``o_totalprice``; the series key is the
  customer's nation;
* the monthly complaint index (``yyyymm`` integer month, decimal-comma
  index text, complaint count) is derived from ``lineitem`` per supplier
  nation and ship month.

The plan is one lineage: Parquet scans with pushed filters and pruned
columns, a dimension join, partial/final aggregates by (nation, month), an
equi-join of the two monthly sides, then per-key scaling.  No collect.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.functions.dates import date_text, month_end, parse_date_lenient, to_yyyymm, yyyymm_to_month_end
from fiscalflow.functions.numbers import decimal_comma_to_double
from fiscalflow.operators.extract import drop_nulls, extract
from fiscalflow.operators.filters import date_after, date_before
from fiscalflow.session import table

# Fixed analysis window of the reference, moved onto the test data's years:
# exclusive on both ends.
RANGE_AFTER = dt.date(1995, 12, 31)
RANGE_BEFORE = dt.date(2001, 2, 1)
PAY_OFFSET_DAYS = 120


def fines(spark: SparkSession, sf_dir: str, with_nation: bool = True, raw_bound: dt.date | None = None) -> DataFrame:
    """Fines-shaped rows (text dates, money, operator) derived from ``orders``.

    ``raw_bound`` keeps only orders dated after that day, as a pushed-down
    predicate on the raw column."""
    o = table(spark, sf_dir, "orders")
    if raw_bound is not None:
        o = o.filter(date_after(o, "o_orderdate", raw_bound))
    decided = F.to_date("o_orderdate")
    paid = F.date_add(decided, (F.col("o_orderkey") % PAY_OFFSET_DAYS).cast("int"))
    out = o.select(
        F.col("o_orderkey").alias("NR_DEMANDA"),
        F.col("o_custkey").alias("REGISTRO_OPERADORA"),
        F.col("o_orderstatus").alias("STATUS_DEMANDA"),
        F.col("o_orderpriority").alias("TIPO_PENALIDADE"),
        date_text(decided).alias("DT_PUBLICACAO_1A_FINAL"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("pago em "), date_text(paid)))
        .otherwise(F.lit("pendente"))
        .alias("DT_PAGTO_A_VISTA_ANS"),
        F.col("o_totalprice").alias("VL_PAGO_A_VISTA_ANS"),
    )
    if not with_nation:
        return out
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("REGISTRO_OPERADORA"), F.col("c_nationkey").alias("NATION")
    )
    return out.join(cust, "REGISTRO_OPERADORA", "inner")


def parsed_fines(spark: SparkSession, sf_dir: str, with_nation: bool = True, raw_bound: dt.date | None = None) -> DataFrame:
    """Fines with both text dates parsed leniently (null when absent)."""
    return fines(spark, sf_dir, with_nation, raw_bound).withColumns(
        {
            "DT_PUBLICACAO_1A_FINAL": parse_date_lenient("DT_PUBLICACAO_1A_FINAL"),
            "DT_PAGTO_A_VISTA_ANS": parse_date_lenient("DT_PAGTO_A_VISTA_ANS"),
        }
    )


def monthly_fines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid value per nation and decision month (month-end date), over
    decisions after the start of the window with both dates present.

    The decision-date bound is also stated on the raw ``o_orderdate`` column
    (same rows: the text is that date) so the Parquet scan prunes row groups.
    Rows are reduced to (operator, month) before the join with the operator
    dimension: the join then moves one row per operator and month instead of
    one per fine, and an operator holding a third of all fines becomes a few
    dozen rows, not a skewed join partition.
    """
    f = parsed_fines(spark, sf_dir, with_nation=False, raw_bound=RANGE_AFTER)
    f = drop_nulls(
        f.select("REGISTRO_OPERADORA", "DT_PUBLICACAO_1A_FINAL", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS")
    ).filter(F.col("DT_PUBLICACAO_1A_FINAL") > F.lit(RANGE_AFTER))
    per_operator = f.groupBy("REGISTRO_OPERADORA", month_end("DT_PUBLICACAO_1A_FINAL").alias("COMPETENCIA")).agg(
        F.sum("VL_PAGO_A_VISTA_ANS").alias("__v")
    )
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("REGISTRO_OPERADORA"), F.col("c_nationkey").alias("NATION")
    )
    joined = per_operator.join(cust, "REGISTRO_OPERADORA", "inner").filter(F.col("NATION").isNotNull())
    return joined.groupBy("NATION", "COMPETENCIA").agg(F.round(F.sum("__v"), 2).alias("VALOR_MES"))


def raw_index(spark: SparkSession, sf_dir: str, window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Complaint-index-shaped rows per supplier nation and ``yyyymm``:
    ``COMPETENCIA`` integer, ``IGR`` decimal-comma text (mean quantity,
    truncated to cents by integer arithmetic), ``QTD_RECLAMACOES`` count.

    ``window`` (exclusive month-end bounds) restricts the ship dates to the
    months that can fall inside it, as a pushed-down raw-column range."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate")
    if window is not None:
        after, before = window
        # last_day(m) > after  <=>  m starts on or after ``start``;
        # last_day(m) < before <=>  m ends before the first of before's month.
        last = after.replace(day=calendar.monthrange(after.year, after.month)[1])
        start = after.replace(day=1) if after < last else last + dt.timedelta(days=1)
        li = li.filter(
            date_after(li, "l_shipdate", start - dt.timedelta(days=1)) & date_before(li, "l_shipdate", before.replace(day=1))
        )
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("NATION"))
    # Reduce to (supplier, month) before joining the supplier dimension
    # (integer sums: the result is the same, the join input is far smaller).
    per_supplier = li.groupBy("l_suppkey", to_yyyymm("l_shipdate").alias("COMPETENCIA")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("__q"), F.count(F.lit(1)).alias("__n")
    )
    g = (
        per_supplier.join(sup, "l_suppkey", "inner")
        .groupBy("NATION", "COMPETENCIA")
        .agg(F.sum("__q").alias("__q"), F.sum("__n").alias("QTD_RECLAMACOES"))
    )
    cents = F.expr("(__q * 100) div QTD_RECLAMACOES")
    igr = F.concat((cents / 100).cast("long").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    return g.select("NATION", "COMPETENCIA", igr.alias("IGR"), "QTD_RECLAMACOES")


def monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index with ``COMPETENCIA`` as month-end date and ``IGR`` as double,
    restricted to the exclusive analysis window."""
    idx = raw_index(spark, sf_dir, (RANGE_AFTER, RANGE_BEFORE)).withColumns(
        {"COMPETENCIA": yyyymm_to_month_end("COMPETENCIA"), "IGR": decimal_comma_to_double("IGR")}
    )
    return extract(
        idx,
        filters=[F.col("COMPETENCIA") > F.lit(RANGE_AFTER), F.col("COMPETENCIA") < F.lit(RANGE_BEFORE)],
        columns=["NATION", "COMPETENCIA", "IGR", "QTD_RECLAMACOES"],
    )


def joined_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index months joined to paid-value months on (nation, month)."""
    f = monthly_fines(spark, sf_dir).withColumnRenamed("COMPETENCIA", "MES_PAGAMENTO")
    return monthly_index(spark, sf_dir).join(
        f.withColumnRenamed("MES_PAGAMENTO", "COMPETENCIA"), ["NATION", "COMPETENCIA"], "inner"
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined monthly series, written once to the shared checkpoint
    folder and read back.

    The series is tiny (nations x months) but every later step (per-key
    statistics joined back, decomposition windows, correlation) refers to
    it more than once; reading the written table keeps the big scans,
    joins and aggregates behind it from running once per reference.
    """
    from fiscalflow.session import materialize

    return materialize(joined_months(spark, sf_dir), spark, "series")
