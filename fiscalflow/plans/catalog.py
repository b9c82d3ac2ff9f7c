"""Query catalog: one entry per operator of the reference, on the test tables.

Each entry is ``(spark_query, oracle_sql)``: ``spark_query(spark, sf_dir)``
returns a DataFrame built with the library; ``oracle_sql`` is the same
result written as DuckDB SQL over the registered views, or ``None`` where the
operator has no SQL form (file bytes, streaming) and is checked by fixtures.

Presentation rounding happens only here, at the end of each query: money
totals to cents (exact, the inputs carry cents), ratios and scores to 6-9
places, far above floating noise and beyond any terminating decimal the
inputs can produce.
"""

from __future__ import annotations

import shutil

import datetime as dt
from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.functions import dates, names, numbers, urls
from fiscalflow.operators import aggregates, correlation, extract, scaling, seasonal, windows
from fiscalflow.plans import analysis
from fiscalflow.plans import oracle_sql as Q
from fiscalflow.session import table

if TYPE_CHECKING:
    import pandas as pd

QueryFn = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        CATALOG[name] = (fn, sql)
        return fn

    return deco


TS_NTZ = "TIMESTAMP_NTZ '{}'"


def rnd(c, digits: int):
    """Round half away from zero as ``round(x * 10^d) / 10^d``; the SQL side
    uses the same formula (:func:`R`), so both engines resolve ties alike."""
    scale = float(10**digits)
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(scale)) / F.lit(scale)


def R(expr: str, digits: int) -> str:
    return f"(round(({expr}) * {float(10**digits)!r}) / {float(10**digits)!r})"


def ts(text: str):
    return F.expr(TS_NTZ.format(text))


# ------------------------------------------------------------------ scans / projection


@register("scan_parquet", "SELECT * FROM lineitem")
def q_scan_parquet(spark, sf):
    return table(spark, sf, "lineitem")


@register("select_columns", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def q_select_columns(spark, sf):
    return extract.select_validated(table(spark, sf, "orders"), ["o_orderkey", "o_orderdate", "o_totalprice"])


@register("select_validated", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_select_validated(spark, sf):
    # Names are stripped, blanks dropped, repeats removed, order kept.
    return extract.select_validated(
        table(spark, sf, "lineitem"), [" l_orderkey ", "l_linenumber", "", "l_quantity", "l_orderkey"], "lineitem"
    )


@register(
    "filter_conjunction",
    "SELECT * FROM lineitem WHERE l_quantity > 25 AND l_discount >= 0.05 AND l_returnflag <> 'N'",
)
def q_filter_conjunction(spark, sf):
    return extract.apply_filters(
        table(spark, sf, "lineitem"),
        [F.col("l_quantity") > 25, F.col("l_discount") >= 0.05, F.col("l_returnflag") != "N"],
    )


@register(
    "where_sql",
    "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 200000",
)
def q_where_sql(spark, sf):
    return extract.apply_where(
        table(spark, sf, "orders"), "  o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 200000 "
    )


@register(
    "extract_filters_where_columns",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_returnflag = 'R' AND l_quantity > 10",
)
def q_extract_filters_where_columns(spark, sf):
    from fiscalflow.sources.sinks import materialize_extract

    return materialize_extract(
        spark,
        table(spark, sf, "lineitem"),
        filters=[F.col("l_shipdate") >= ts("1997-01-01 00:00:00")],
        where="l_returnflag = 'R' AND l_quantity > 10",
        columns=["l_orderkey", "l_linenumber", "l_extendedprice"],
    )


@register("filter_entity", Q.with_ctes([Q.FINES], "SELECT * EXCLUDE (NATION) FROM fines WHERE REGISTRO_OPERADORA = 42"))
def q_filter_entity(spark, sf):
    return analysis.fines(spark, sf, with_nation=False).filter(F.col("REGISTRO_OPERADORA") == 42)


ENTITIES = (3, 17, 42, 99)

_IDX_SUPP = """idx_s AS (
  SELECT REGISTRO_ANS, CAST(try_strptime(CAST(COMPETENCIA AS VARCHAR), '%Y%m') AS DATE) AS COMPETENCIA,
         QTD_RECLAMACOES
  FROM (SELECT l_suppkey AS REGISTRO_ANS, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS COMPETENCIA,
               count(*) AS QTD_RECLAMACOES
        FROM lineitem GROUP BY 1, 2) g)"""


def _index_by_supplier(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    g = li.groupBy(F.col("l_suppkey").alias("REGISTRO_ANS"), dates.to_yyyymm("l_shipdate").alias("COMPETENCIA")).agg(
        F.count(F.lit(1)).alias("QTD_RECLAMACOES")
    )
    return g.withColumn("COMPETENCIA", dates.yyyymm_to_month_start("COMPETENCIA"))


@register(
    "compare_entities",
    Q.with_ctes([_IDX_SUPP], "SELECT * FROM idx_s WHERE REGISTRO_ANS IN (3, 17, 42, 99)"),
)
def q_compare_entities(spark, sf):
    return _index_by_supplier(spark, sf).filter(F.col("REGISTRO_ANS").isin(*ENTITIES))


@register(
    "date_range_filter",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders "
    "WHERE CAST(o_orderdate AS DATE) > DATE '1995-12-31' AND CAST(o_orderdate AS DATE) < DATE '2001-02-01'",
)
def q_date_range_filter(spark, sf):
    from fiscalflow.operators.filters import date_between_exclusive

    o = table(spark, sf, "orders")
    o = date_between_exclusive(o, "o_orderdate", dt.date(1995, 12, 31), dt.date(2001, 2, 1))
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")


@register(
    "year_filter",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, o_totalprice FROM orders "
    "WHERE year(o_orderdate) >= 2000",
)
def q_year_filter(spark, sf):
    from fiscalflow.operators.filters import year_at_least

    o = year_at_least(table(spark, sf, "orders"), "o_orderdate", 2000)
    return o.select("o_orderkey", F.year("o_orderdate").alias("ano"), "o_totalprice")


@register(
    "drop_nulls",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT DT_PUBLICACAO_1A_FINAL, DT_PAGTO_A_VISTA_ANS, VL_PAGO_A_VISTA_ANS FROM parsed "
        "WHERE DT_PUBLICACAO_1A_FINAL IS NOT NULL AND DT_PAGTO_A_VISTA_ANS IS NOT NULL AND VL_PAGO_A_VISTA_ANS IS NOT NULL",
    ),
)
def q_drop_nulls(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False)
    return extract.drop_nulls(f.select("DT_PUBLICACAO_1A_FINAL", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS"))


@register(
    "lineage_columns",
    "SELECT o_orderkey, o_custkey, 'orders.parquet' AS arquivo_origem, 'ORDERS' AS grupo_mescla FROM orders",
)
def q_lineage_columns(spark, sf):
    from fiscalflow.operators.merge import with_lineage

    return with_lineage(table(spark, sf, "orders")).select("o_orderkey", "o_custkey", "arquivo_origem", "grupo_mescla")


@register(
    "cast_columns",
    Q.with_ctes(
        [Q.FINES],
        "SELECT CAST(NR_DEMANDA AS VARCHAR) AS NR_DEMANDA, CAST(REGISTRO_OPERADORA AS DOUBLE) AS REGISTRO_OPERADORA, "
        f"{Q.PARSE.format(c='DT_PUBLICACAO_1A_FINAL')} AS DT_PUBLICACAO_1A_FINAL, "
        f"{Q.PARSE.format(c='DT_PAGTO_A_VISTA_ANS')} AS DT_PAGTO_A_VISTA_ANS, "
        "CAST(VL_PAGO_A_VISTA_ANS AS DOUBLE) AS VL_PAGO_A_VISTA_ANS FROM fines",
    ),
)
def q_cast_columns(spark, sf):
    f = analysis.fines(spark, sf, with_nation=False)
    f = numbers.cast_columns(
        f,
        {
            "NR_DEMANDA": "string",
            "REGISTRO_OPERADORA": "double",
            "DT_PUBLICACAO_1A_FINAL": dates.parse_date_lenient("DT_PUBLICACAO_1A_FINAL"),
            "DT_PAGTO_A_VISTA_ANS": dates.parse_date_lenient("DT_PAGTO_A_VISTA_ANS"),
            "VL_PAGO_A_VISTA_ANS": "double",
        },
    )
    return f.select("NR_DEMANDA", "REGISTRO_OPERADORA", "DT_PUBLICACAO_1A_FINAL", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS")


@register(
    "schema_listing",
    "SELECT CAST(ordinal_position AS INTEGER) AS position, column_name AS name, "
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' "
    "ELSE CASE WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE lower(data_type) END END AS type "
    "FROM information_schema.columns WHERE table_name = 'lineitem'",
)
def q_schema_listing(spark, sf):
    rows = [(i + 1, n, t) for i, n, t, _ in extract.schema_rows(table(spark, sf, "lineitem"))]
    return spark.createDataFrame(rows, "position int, name string, type string")


# ------------------------------------------------------------------ casts / scalar functions


@register(
    "parse_dates_lenient",
    Q.with_ctes(
        [Q.FINES],
        "SELECT NR_DEMANDA, DT_PAGTO_A_VISTA_ANS AS texto, "
        f"{Q.PARSE.format(c='DT_PUBLICACAO_1A_FINAL')} AS dt_decisao, {Q.PARSE.format(c='DT_PAGTO_A_VISTA_ANS')} AS dt_pagto "
        "FROM fines",
    ),
)
def q_parse_dates_lenient(spark, sf):
    f = analysis.fines(spark, sf, with_nation=False)
    return f.select(
        "NR_DEMANDA",
        F.col("DT_PAGTO_A_VISTA_ANS").alias("texto"),
        dates.parse_date_lenient("DT_PUBLICACAO_1A_FINAL").alias("dt_decisao"),
        dates.parse_date_lenient("DT_PAGTO_A_VISTA_ANS").alias("dt_pagto"),
    )


_YYYYMM_SQL = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)"


@register(
    "yyyymm_to_month_end",
    f"SELECT o_orderkey, {_YYYYMM_SQL} AS competencia, "
    f"last_day(CAST(try_strptime(CAST({_YYYYMM_SQL} AS VARCHAR), '%Y%m') AS DATE)) AS mes_fim FROM orders",
)
def q_yyyymm_to_month_end(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", dates.to_yyyymm("o_orderdate").alias("competencia"))
    return o.withColumn("mes_fim", dates.yyyymm_to_month_end("competencia"))


@register(
    "yyyymm_to_month_start",
    f"SELECT o_orderkey, {_YYYYMM_SQL} AS competencia, "
    f"CAST(try_strptime(CAST({_YYYYMM_SQL} AS VARCHAR), '%Y%m') AS DATE) AS mes_inicio FROM orders",
)
def q_yyyymm_to_month_start(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", dates.to_yyyymm("o_orderdate").alias("competencia"))
    return o.withColumn("mes_inicio", dates.yyyymm_to_month_start("competencia"))


@register(
    "date_diff_days",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT NR_DEMANDA, CAST(date_diff('day', DT_PUBLICACAO_1A_FINAL, DT_PAGTO_A_VISTA_ANS) AS INTEGER) AS PRAZO_FINALIZACAO "
        "FROM parsed",
    ),
)
def q_date_diff_days(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False)
    return f.select("NR_DEMANDA", dates.days_between("DT_PAGTO_A_VISTA_ANS", "DT_PUBLICACAO_1A_FINAL").alias("PRAZO_FINALIZACAO"))


@register(
    "decimal_comma",
    Q.with_ctes([Q.RAW_INDEX], "SELECT NATION, COMPETENCIA, IGR AS igr_texto, TRY_CAST(replace(IGR, ',', '.') AS DOUBLE) AS IGR FROM rawidx"),
)
def q_decimal_comma(spark, sf):
    r = analysis.raw_index(spark, sf)
    return r.select("NATION", "COMPETENCIA", F.col("IGR").alias("igr_texto"), numbers.decimal_comma_to_double("IGR").alias("IGR"))


@register(
    "to_numeric",
    "SELECT p_partkey, p_brand, TRY_CAST(regexp_extract(p_brand, '[0-9]+$', 0) AS DOUBLE) AS marca_num, "
    "TRY_CAST(p_name AS DOUBLE) AS nome_num FROM part",
)
def q_to_numeric(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey",
        "p_brand",
        numbers.to_numeric(F.regexp_extract("p_brand", "[0-9]+$", 0)).alias("marca_num"),
        numbers.to_numeric("p_name").alias("nome_num"),
    )


@register(
    "fill_nulls",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT NR_DEMANDA, coalesce(DT_PAGTO_A_VISTA_ANS, DATE '1900-01-01') AS DT_PAGTO_A_VISTA_ANS, "
        "CAST(coalesce(date_diff('day', DT_PUBLICACAO_1A_FINAL, DT_PAGTO_A_VISTA_ANS), 0) AS INTEGER) AS PRAZO FROM parsed",
    ),
)
def q_fill_nulls(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False).select(
        "NR_DEMANDA",
        "DT_PAGTO_A_VISTA_ANS",
        dates.days_between("DT_PAGTO_A_VISTA_ANS", "DT_PUBLICACAO_1A_FINAL").alias("PRAZO"),
    )
    f = extract.fill_nulls(f, 0, ["PRAZO"])
    return f.withColumn("DT_PAGTO_A_VISTA_ANS", F.coalesce("DT_PAGTO_A_VISTA_ANS", F.lit(dt.date(1900, 1, 1))))


@register("strip_accents", "SELECT doc_id, strip_accents(text) AS texto FROM documents")
def q_strip_accents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", names.strip_accents("text").alias("texto"))


# File-name-like strings derived from ``part`` rows: a plain name, a
# ``pda-<code>-<kind>-<number>`` name whose last part has 5 or 6 digits, and
# a data-dictionary name for the bigger sizes.
def _part_file_names(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    plain = F.concat(F.col("p_name"), F.lit(".csv"))
    code = F.concat(
        F.lit("pda-"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("")),
        F.lit("-"),
        F.lower("p_type"),
        F.lit("-"),
        F.round(F.col("p_retailprice") * 100).cast("long").cast("string"),
        F.lit(".zip"),
    )
    dico = F.when(F.col("p_size") > 40, F.concat(F.lit("Dicionário_"), F.col("p_name"), F.lit(".ods")))
    return p.select("p_partkey", F.explode(F.array(plain, code, dico)).alias("nome_arquivo")).filter(
        F.col("nome_arquivo").isNotNull()
    )


_PART_NAMES_SQL = """names AS (
  SELECT p_partkey, nome_arquivo FROM (
    SELECT p_partkey, p_name || '.csv' AS nome_arquivo FROM part
    UNION ALL
    SELECT p_partkey, 'pda-' || replace(p_brand, '#', '') || '-' || lower(p_type) || '-'
           || CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) || '.zip' FROM part
    UNION ALL
    SELECT p_partkey, 'Dicionário_' || p_name || '.ods' FROM part WHERE p_size > 40) u)"""

_STEM_SQL = "regexp_replace(regexp_extract(nome_arquivo, '([^/\\\\]*)$', 1), '^(.+)\\.[^.]+$', '\\1')"

_GROUP_SQL = f"""parts AS (
  SELECT p_partkey, nome_arquivo,
         list_filter(string_split(replace(strip_accents({_STEM_SQL}), '-', '_'), '_'), lambda x: x <> '') AS pp
  FROM names)"""


@register(
    "group_from_name",
    Q.with_ctes(
        [_PART_NAMES_SQL, _GROUP_SQL],
        "SELECT p_partkey, nome_arquivo, CASE WHEN len(pp) = 0 THEN 'SEM_GRUPO' "
        "WHEN len(pp) >= 4 AND lower(pp[1]) = 'pda' AND regexp_matches(pp[-1], '^[0-9]{6}$') "
        "THEN upper(pp[2] || '_' || pp[3] || '_' || left(pp[-1], 4)) ELSE upper(pp[-1]) END AS grupo_mescla FROM parts",
    ),
)
def q_group_from_name(spark, sf):
    n = _part_file_names(spark, sf)
    return n.select("p_partkey", "nome_arquivo", names.group_from_name("nome_arquivo").alias("grupo_mescla"))


@register(
    "ignore_by_name",
    Q.with_ctes(
        [_PART_NAMES_SQL],
        f"SELECT p_partkey, nome_arquivo, contains(lower(strip_accents({_STEM_SQL})), 'dicionario') AS ignorar FROM names",
    ),
)
def q_ignore_by_name(spark, sf):
    n = _part_file_names(spark, sf)
    return n.select("p_partkey", "nome_arquivo", names.ignore_by_name("nome_arquivo").alias("ignorar"))


@register(
    "safe_name",
    "SELECT p_partkey, p_name, coalesce(NULLIF(regexp_replace(regexp_replace(upper(strip_accents(p_name || ' & ' || p_type)), "
    "'[^\\p{L}\\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'SEM_GRUPO') AS nome_saida FROM part",
)
def q_safe_name(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_name", names.safe_name(F.concat("p_name", F.lit(" & "), "p_type")).alias("nome_saida"))


@register(
    "safe_run_name",
    "SELECT c_custkey, NULLIF(regexp_replace(regexp_replace(regexp_replace(strip_accents(trim(c_name || ' / ' || c_mktsegment)), "
    "'[^\\p{L}\\p{N}_]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS nome_execucao FROM customer",
)
def q_safe_run_name(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", names.safe_run_name(F.concat("c_name", F.lit(" / "), "c_mktsegment")).alias("nome_execucao"))


# ------------------------------------------------------------------ aggregates


@register(
    "year_sum",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT CAST(year(DT_PAGTO_A_VISTA_ANS) AS INTEGER) AS ANO_PAGTO, "
        "round(coalesce(sum(VL_PAGO_A_VISTA_ANS), 0), 2) AS TOTAL_ANO_PAGTO FROM parsed GROUP BY 1",
    ),
)
def q_year_sum(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False)
    out = aggregates.sum_by_year(f, "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS", "ANO_PAGTO", "TOTAL_ANO_PAGTO")
    return out.withColumn("TOTAL_ANO_PAGTO", F.round("TOTAL_ANO_PAGTO", 2))


@register("month_end_sum", Q.with_ctes(Q.ANALYSIS[:3], "SELECT * FROM mfines"))
def q_month_end_sum(spark, sf):
    return analysis.monthly_fines(spark, sf)


@register(
    "median_days",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT TIPO_PENALIDADE, CAST(quantile_cont(date_diff('day', DT_PUBLICACAO_1A_FINAL, DT_PAGTO_A_VISTA_ANS), 0.5) AS DOUBLE) "
        "AS MEDIANA_DIAS FROM parsed WHERE DT_PUBLICACAO_1A_FINAL > DATE '1995-12-31' "
        "AND DT_PAGTO_A_VISTA_ANS IS NOT NULL GROUP BY 1",
    ),
)
def q_median_days(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False)
    f = extract.drop_nulls(f, ["DT_PUBLICACAO_1A_FINAL", "DT_PAGTO_A_VISTA_ANS"]).filter(
        F.col("DT_PUBLICACAO_1A_FINAL") > F.lit(analysis.RANGE_AFTER)
    )
    return aggregates.median_days(f, "DT_PAGTO_A_VISTA_ANS", "DT_PUBLICACAO_1A_FINAL", ["TIPO_PENALIDADE"], "MEDIANA_DIAS")


_FINE_COLS = [
    "NR_DEMANDA", "REGISTRO_OPERADORA", "STATUS_DEMANDA", "TIPO_PENALIDADE",
    "DT_PUBLICACAO_1A_FINAL", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS",
]


@register(
    "null_count",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _FINE_COLS) + " FROM parsed",
    ),
)
def q_null_count(spark, sf):
    return aggregates.null_counts(analysis.parsed_fines(spark, sf, with_nation=False), _FINE_COLS)


@register(
    "period_sums",
    Q.with_ctes(
        [_IDX_SUPP],
        "SELECT REGISTRO_ANS, "
        "CAST(coalesce(sum(QTD_RECLAMACOES) FILTER (WHERE year(COMPETENCIA) = 1999), 0) AS BIGINT) AS total_1999, "
        "CAST(coalesce(sum(QTD_RECLAMACOES) FILTER (WHERE year(COMPETENCIA) = 2000), 0) AS BIGINT) AS total_2000 "
        "FROM idx_s WHERE year(COMPETENCIA) IN (1999, 2000) GROUP BY 1",
    ),
)
def q_period_sums(spark, sf):
    return aggregates.period_sums(_index_by_supplier(spark, sf), ["REGISTRO_ANS"], "COMPETENCIA", "QTD_RECLAMACOES", [1999, 2000])


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "column_means",
    "SELECT " + ", ".join(f"{R(f'avg({c})', 6)} AS {c}" for c in _LI_NUM) + " FROM lineitem",
)
def q_column_means(spark, sf):
    m = aggregates.column_means(table(spark, sf, "lineitem"))
    return m.select(*[rnd(c, 6).alias(c) for c in m.columns])


# ------------------------------------------------------------------ series: join, scaling, windows


@register("inner_join_months", Q.with_ctes(Q.ANALYSIS, "SELECT * FROM joined"))
def q_inner_join_months(spark, sf):
    return analysis.joined_months(spark, sf).orderBy("NATION", "COMPETENCIA")


def _rounded(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})


_SERIES = ["IGR", "VALOR_MES"]


def _scaled_sql(suffix: str) -> str:
    cols = ", ".join(f"{R(c + suffix, 9)} AS {c}{suffix}" for c in _SERIES)
    return Q.with_ctes(Q.ANALYSIS + [Q.scaled_sql(_SERIES)], f"SELECT NATION, COMPETENCIA, IGR, VALOR_MES, {cols} FROM scaled")


@register("zscore_scale", _scaled_sql("_Z"))
def q_zscore_scale(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    return _rounded(scaling.zscore(j, _SERIES, ["NATION"]), ["IGR_Z", "VALOR_MES_Z"], 9)


@register("base100_scale", _scaled_sql("_B100"))
def q_base100_scale(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    return _rounded(scaling.base100(j, _SERIES, "COMPETENCIA", ["NATION"]), ["IGR_B100", "VALOR_MES_B100"], 9)


@register("minmax_scale", _scaled_sql("_MINMAX"))
def q_minmax_scale(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    return _rounded(scaling.minmax(j, _SERIES, ["NATION"]), ["IGR_MINMAX", "VALOR_MES_MINMAX"], 9)


@register(
    "corr_pair",
    Q.with_ctes(
        Q.ANALYSIS,
        "SELECT NATION, "
        + R("CASE WHEN stddev_pop(IGR) > 0 AND stddev_pop(VALOR_MES) > 0 "
            "THEN covar_pop(IGR, VALOR_MES) / (stddev_pop(IGR) * stddev_pop(VALOR_MES)) END", 9)
        + " AS r FROM joined GROUP BY 1",
    ),
)
def q_corr_pair(spark, sf):
    c = correlation.corr_pair(analysis.joined_months(spark, sf), "IGR", "VALOR_MES", ["NATION"])
    return c.withColumn("r", rnd("r", 9))


_DEC_OUT = [f"{c}_{p}" for c in _SERIES for p in ("TREND", "SEASONAL", "RESID")]


@register(
    "seasonal_decompose",
    Q.with_ctes(
        Q.ANALYSIS + Q.decompose_sql("joined", "NATION", "COMPETENCIA", _SERIES),
        "SELECT NATION, COMPETENCIA, IGR, VALOR_MES, " + ", ".join(f"{R(c, 6)} AS {c}" for c in _DEC_OUT) + " FROM dec",
    ),
)
def q_seasonal_decompose(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    return _rounded(seasonal.seasonal_decompose(j, ["NATION"], "COMPETENCIA", _SERIES), _DEC_OUT, 6)


@register(
    "deseasonalize",
    Q.with_ctes(
        Q.ANALYSIS + Q.decompose_sql("joined", "NATION", "COMPETENCIA", _SERIES),
        "SELECT NATION, COMPETENCIA, "
        + ", ".join(f"{R(f'CAST({c} AS DOUBLE) - {c}_SEASONAL', 6)} AS {c}_SEM_SAZONAL" for c in _SERIES)
        + " FROM dec",
    ),
)
def q_deseasonalize(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    d = seasonal.deseasonalize(seasonal.seasonal_decompose(j, ["NATION"], "COMPETENCIA", _SERIES), _SERIES)
    out = [f"{c}_SEM_SAZONAL" for c in _SERIES]
    return _rounded(d.select("NATION", "COMPETENCIA", *out), out, 6)


@register(
    "seasonal_corr",
    Q.with_ctes(
        Q.ANALYSIS + Q.decompose_sql("joined", "NATION", "COMPETENCIA", _SERIES),
        "SELECT NATION, "
        + R("CASE WHEN count(IGR_SEASONAL) FILTER (WHERE VALOR_MES_SEASONAL IS NOT NULL) >= 2 "
            "AND stddev_pop(IGR_SEASONAL) > 0 AND stddev_pop(VALOR_MES_SEASONAL) > 0 "
            "THEN covar_pop(IGR_SEASONAL, VALOR_MES_SEASONAL) / (stddev_pop(IGR_SEASONAL) * stddev_pop(VALOR_MES_SEASONAL)) END", 6)
        + " AS r FROM dec GROUP BY 1",
    ),
)
def q_seasonal_corr(spark, sf):
    j = analysis.series(spark, sf).select("NATION", "COMPETENCIA", *_SERIES)
    return seasonal.seasonal_corr(j, ["NATION"], "COMPETENCIA", "IGR", "VALOR_MES").withColumn("r", rnd("r", 6))


_MATRIX_COLS = _SERIES + ["QTD_RECLAMACOES"] + [f"{c}{s}" for s in ("_Z", "_B100", "_MINMAX") for c in _SERIES] + [
    f"{c}_SEM_SAZONAL" for c in _SERIES
]


def _corr_matrix_sql() -> str:
    ctes = Q.ANALYSIS + [Q.scaled_sql(_SERIES)] + Q.decompose_sql("scaled", "NATION", "COMPETENCIA", _SERIES)
    ctes.append(
        "full_t AS (SELECT *, " + ", ".join(f"CAST({c} AS DOUBLE) - {c}_SEASONAL AS {c}_SEM_SAZONAL" for c in _SERIES) + " FROM dec)"
    )
    sel = []
    cols = _MATRIX_COLS
    for i, a in enumerate(cols):
        for b in cols[i:]:
            x = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            y = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            expr = (
                f"CASE WHEN count({x}) >= 2 AND stddev_pop({x}) * stddev_pop({y}) <> 0 "
                f"THEN covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
            )
            sel.append((a, b, expr))
    unions = []
    for a, b, expr in sel:
        unions.append(f"SELECT NATION, '{a}' AS col_a, '{b}' AS col_b, {R(expr, 6)} AS r FROM full_t GROUP BY NATION")
        if a != b:
            unions.append(f"SELECT NATION, '{b}' AS col_a, '{a}' AS col_b, {R(expr, 6)} AS r FROM full_t GROUP BY NATION")
    return Q.with_ctes(ctes, "\nUNION ALL\n".join(unions))


@register("corr_matrix", _corr_matrix_sql())
def q_corr_matrix(spark, sf):
    j = scaling.scale_all(analysis.series(spark, sf), _SERIES, ["NATION"], "COMPETENCIA")
    j = seasonal.deseasonalize(seasonal.seasonal_decompose(j, ["NATION"], "COMPETENCIA", _SERIES), _SERIES)
    m = correlation.corr_matrix(j, _MATRIX_COLS, keys=["NATION"])
    return m.withColumn("r", rnd("r", 6))


_ORDERS_MONTHLY_SQL = """om AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS COMPETENCIA, count(*) AS QTD
  FROM orders GROUP BY 1, 2)"""


@register(
    "rolling_12_rows",
    Q.with_ctes(
        [_ORDERS_MONTHLY_SQL],
        "SELECT o_orderpriority, COMPETENCIA, QTD, CAST(sum(QTD) OVER (PARTITION BY o_orderpriority ORDER BY COMPETENCIA "
        "ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS QTD_12 FROM om",
    ),
)
def q_rolling_12_rows(spark, sf):
    o = table(spark, sf, "orders")
    m = o.groupBy("o_orderpriority", dates.to_yyyymm("o_orderdate").alias("COMPETENCIA")).agg(F.count(F.lit(1)).alias("QTD"))
    return windows.rolling_sum_rows(m, ["o_orderpriority"], ["COMPETENCIA"], "QTD", 12, "QTD_12")


@register(
    "rolling_12_months",
    "SELECT o_custkey, mes, QTD, CAST(sum(QTD) OVER (PARTITION BY o_custkey ORDER BY year(mes) * 12 + month(mes) "
    "RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS QTD_12M FROM ("
    "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, count(*) AS QTD FROM orders GROUP BY 1, 2) m",
)
def q_rolling_12_months(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("mes"), F.lit(1).cast("long").alias("QTD"))
    return windows.rolling_sum_months(o, ["o_custkey"], "mes", "QTD", 12, "QTD_12M")


@register(
    "window_year_total",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT NR_DEMANDA, CAST(year(DT_PAGTO_A_VISTA_ANS) AS INTEGER) AS ANO_PAGTO, VL_PAGO_A_VISTA_ANS, "
        "round(sum(VL_PAGO_A_VISTA_ANS) OVER (PARTITION BY year(DT_PAGTO_A_VISTA_ANS)), 2) AS TOTAL_ANO_PAGTO FROM parsed",
    ),
)
def q_window_year_total(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False).select("NR_DEMANDA", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS")
    out = windows.with_partition_total(f, F.year("DT_PAGTO_A_VISTA_ANS"), "VL_PAGO_A_VISTA_ANS", "ANO_PAGTO", "TOTAL_ANO_PAGTO")
    return out.select("NR_DEMANDA", "ANO_PAGTO", "VL_PAGO_A_VISTA_ANS", F.round("TOTAL_ANO_PAGTO", 2).alias("TOTAL_ANO_PAGTO"))


# ------------------------------------------------------------------ sorts, limits


@register(
    "sort_desc",
    Q.with_ctes(
        [Q.FINES, Q.PARSED_FINES],
        "SELECT NR_DEMANDA, DT_PAGTO_A_VISTA_ANS, VL_PAGO_A_VISTA_ANS FROM parsed ORDER BY DT_PAGTO_A_VISTA_ANS DESC NULLS FIRST",
    ),
)
def q_sort_desc(spark, sf):
    f = analysis.parsed_fines(spark, sf, with_nation=False)
    # The unique id breaks ties: the range partitioner then splits a block of
    # equal keys (a third of the rows have no payment date) across tasks.
    return f.select("NR_DEMANDA", "DT_PAGTO_A_VISTA_ANS", "VL_PAGO_A_VISTA_ANS").orderBy(
        F.col("DT_PAGTO_A_VISTA_ANS").desc_nulls_first(), F.col("NR_DEMANDA")
    )


@register(
    "head_n",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def q_head_n(spark, sf):
    # A top-10 report: the limit is the feature (TakeOrderedAndProject, no full sort).
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(10)


# ------------------------------------------------------------------ links, kinds


_VARIANTS_SQL = """variants AS (
  SELECT page_id, v AS url FROM (
    SELECT page_id, url AS v FROM pages
    UNION ALL SELECT page_id, regexp_extract(url, '^[^?#]*', 0) || '.zip' FROM pages
    UNION ALL SELECT page_id, regexp_extract(url, '^[^?#]*', 0) || '.CSV' FROM pages
    UNION ALL SELECT page_id, regexp_replace(url, '^https?://', 'ftp://') FROM pages
    UNION ALL SELECT page_id, regexp_replace(url, '^https?://', 'gopher://') FROM pages) u)"""

_URL_RE = "^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#(.*))?$"
_SUFFIX_SQL = "lower(regexp_extract(regexp_extract({p}, '([^/\\\\]*)$', 1), '^.+(\\.[^.]+)$', 1))"


def _url_variants(spark, sf) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", "url")
    no_q = F.regexp_extract("url", r"^[^?#]*", 0)
    vs = F.array(
        F.col("url"),
        F.concat(no_q, F.lit(".zip")),
        F.concat(no_q, F.lit(".CSV")),
        F.regexp_replace("url", r"^https?://", "ftp://"),
        F.regexp_replace("url", r"^https?://", "gopher://"),
    )
    return p.select("page_id", F.explode(vs).alias("url"))


@register(
    "source_kind",
    Q.with_ctes(
        [_VARIANTS_SQL],
        f"SELECT page_id, url, CASE WHEN lower(regexp_extract(url, '{_URL_RE}', 2)) NOT IN ('http', 'https', 'ftp') THEN NULL "
        f"WHEN sfx = '.zip' THEN 'arquivo_zip' WHEN sfx IN ('.csv', '.xlsx', '.xls', '.ods') THEN 'arquivo_tabular' "
        f"WHEN lower(regexp_extract(url, '{_URL_RE}', 2)) = 'ftp' THEN 'ftp_pasta' ELSE 'http_pagina' END AS tipo_origem "
        f"FROM (SELECT *, {_SUFFIX_SQL.format(p=f'regexp_extract(url, {chr(39)}{_URL_RE}{chr(39)}, 5)')} AS sfx FROM variants) v",
    ),
)
def q_source_kind(spark, sf):
    v = _url_variants(spark, sf)
    return v.select("page_id", "url", urls.source_kind("url").alias("tipo_origem"))


@register(
    "file_kind",
    Q.with_ctes(
        [_VARIANTS_SQL],
        "SELECT page_id, url, sfx AS extensao, CASE sfx WHEN '.csv' THEN 'csv' WHEN '.xlsx' THEN 'xlsx' WHEN '.xls' THEN 'xls' "
        "WHEN '.ods' THEN 'ods' WHEN '.parquet' THEN 'parquet' WHEN '.zip' THEN 'zip' END AS leitor "
        f"FROM (SELECT *, {_SUFFIX_SQL.format(p=f'regexp_extract(url, {chr(39)}{_URL_RE}{chr(39)}, 5)')} AS sfx FROM variants) v",
    ),
)
def q_file_kind(spark, sf):
    v = _url_variants(spark, sf)
    path = urls.url_path("url")
    return v.select("page_id", "url", names.file_suffix(path).alias("extensao"), urls.file_kind(path).alias("leitor"))


# The page without comments, cut at each anchor's start; the attribute's end is found by position.
_ANCHORS_SQL = """anc AS (
  SELECT page_id, url, pos, trim(replace(replace(replace(replace(replace(substr(piece, 1, strpos(piece, '"') - 1),
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS href
  FROM (SELECT page_id, url, unnest(l) AS piece, unnest(range(len(l))) AS pos
        FROM (SELECT page_id, url, string_split(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<a href="')[2:] AS l FROM pages) p) q)"""


@register("distinct_links", Q.with_ctes([_ANCHORS_SQL], "SELECT page_id, href, min(pos) AS posicao FROM anc GROUP BY 1, 2"))
def q_distinct_links(spark, sf):
    from fiscalflow.sources.listings import distinct_hrefs

    return distinct_hrefs(table(spark, sf, "pages").select("page_id", "html"))


@register(
    "listing_links",
    Q.with_ctes(
        [_ANCHORS_SQL],
        f"""SELECT page_id, url_link, caminho_relativo, pasta, min(pos) AS posicao FROM (
  SELECT page_id, pos, href LIKE '%/' AS pasta,
         regexp_extract(url, '{_URL_RE}', 2) || '://' || regexp_extract(url, '{_URL_RE}', 4) || href AS url_link,
         substr(regexp_replace(regexp_extract(href, '^[^?#]*', 0), '/+$', ''), 2) AS caminho_relativo
  FROM anc
  WHERE href <> '' AND href NOT IN ('../', './', '/') AND NOT starts_with(href, '#') AND NOT starts_with(href, '?')
    AND starts_with(href, '/') AND NOT starts_with(href, '//')
    AND regexp_extract(regexp_replace(regexp_extract(href, '^[^?#]*', 0), '/+$', ''), '([^/]*)$', 1) <> '') x
GROUP BY 1, 2, 3, 4""",
    ),
)
def q_listing_links(spark, sf):
    from fiscalflow.sources.listings import listing_links

    return listing_links(table(spark, sf, "pages"), root="/", suffixes=None)


# ------------------------------------------------------------------ files: round trips, union, merge


@register("parquet_roundtrip", "SELECT * FROM orders")
def q_parquet_roundtrip(spark, sf):
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_parquet

    path = write_parquet(table(spark, sf, "orders"), scratch_path(spark, "orders-parquet"))
    return spark.read.parquet(path)


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf):
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.files import read_csv
    from fiscalflow.sources.sinks import write_csv

    c = table(spark, sf, "customer")
    path = write_csv(c, scratch_path(spark, "customer-csv"), sep=";")
    return read_csv(spark, path, sep=";", schema=c.schema)


@register("csv_latin1_roundtrip", "SELECT doc_id, lang, source, text FROM documents")
def q_csv_latin1_roundtrip(spark, sf):
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.files import read_csv
    from fiscalflow.sources.sinks import write_csv

    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    path = write_csv(d, scratch_path(spark, "documents-latin1"), sep=";", encoding="ISO-8859-1")
    return read_csv(spark, path, sep=";", encoding="ISO-8859-1", schema=d.schema, multiline=True)


@register(
    "diagonal_relaxed_union",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome, CAST(c_nationkey AS BIGINT) AS nacao,
       c_acctbal AS saldo, c_mktsegment AS segmento, CAST(NULL AS BOOLEAN) AS ativo FROM customer
UNION ALL
SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS BIGINT), s_acctbal, NULL, NULL FROM supplier
UNION ALL
SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS BIGINT), CAST(NULL AS DOUBLE), NULL,
       n_nationkey % 2 = 0 FROM nation""",
)
def q_diagonal_relaxed_union(spark, sf):
    from fiscalflow.operators.union import relaxed_union

    cust = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"), F.col("c_nationkey").alias("nacao"),
        F.col("c_acctbal").alias("saldo"), F.col("c_mktsegment").alias("segmento"),
    )
    supp = table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("nome"),
        F.col("s_nationkey").cast("long").alias("nacao"), F.col("s_acctbal").alias("saldo"),
    )
    nat = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome"), F.col("n_regionkey").alias("nacao"),
        ((F.col("n_nationkey") % 2) == 0).alias("ativo"),
    )
    return relaxed_union([cust, supp, nat])


# Landing data for the merge: ``orders`` written as three schema classes
# (all columns; without the status; customer key as text), each file named
# ``pedidos-<priority>-<year>`` as a Hive-style partition value.
def _landing(spark, sf) -> list[DataFrame]:
    from fiscalflow.operators.merge import with_lineage
    from fiscalflow.session import scratch_path

    o = table(spark, sf, "orders")
    word = F.lower(F.regexp_replace("o_orderpriority", r"^[0-9]+-", ""))
    name = F.concat(F.lit("pedidos-"), word, F.lit("-"), F.year("o_orderdate").cast("string"))
    o = o.withColumn("arquivo", name)
    classes = [
        o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")),
        o.filter(F.col("o_orderpriority") == "3-MEDIUM").drop("o_orderstatus"),
        o.filter(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")).withColumn("o_custkey", F.col("o_custkey").cast("string")),
    ]
    root = scratch_path(spark, "landing")
    scans = []
    for i, c in enumerate(classes):
        path = f"{root}/classe{i}"
        c.write.mode("overwrite").partitionBy("arquivo").parquet(path)
        scans.append(with_lineage(spark.read.parquet(path), name_col="arquivo"))
    return scans


def _merged(spark, sf):
    from fiscalflow.operators.merge import merge_by_group
    from fiscalflow.session import scratch_path

    return merge_by_group(spark, _landing(spark, sf), scratch_path(spark, "merged"))


_MERGED_SQL = """merged AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS grupo_mescla,
         'pedidos-' || lower(regexp_replace(o_orderpriority, '^[0-9]+-', '')) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS arquivo_origem,
         o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders)"""


@register(
    "merge_by_group",
    Q.with_ctes(
        [_MERGED_SQL],
        "SELECT grupo_mescla, count(*) AS linhas, count(DISTINCT arquivo_origem) AS arquivos, "
        "round(sum(o_totalprice), 2) AS total FROM merged GROUP BY 1",
    ),
)
def q_merge_by_group(spark, sf):
    res = _merged(spark, sf)
    return res.unified.groupBy("grupo_mescla").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_distinct("arquivo_origem").alias("arquivos"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@register("unified_union", Q.with_ctes([_MERGED_SQL], "SELECT * FROM merged"))
def q_unified_union(spark, sf):
    return _merged(spark, sf).unified


# ------------------------------------------------------------------ file layer on files derived from the tables
#
# These write table data as landed files (Spark writes, several dialects or
# schema classes), then run the file-layer operator on them.


_DIALECTS = [("ponto_e_virgula", ";", "ISO-8859-1"), ("virgula", ",", "UTF-8"), ("tab", "\t", "UTF-8"), ("barra", "|", "UTF-8")]


def _customer_landing(spark, sf) -> str:
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv

    root = scratch_path(spark, "landing-csv")
    c = table(spark, sf, "customer")
    for folder, sep, enc in _DIALECTS:
        write_csv(c, f"{root}/{folder}", sep=sep, encoding=enc)
    return root


def _land_groups(frame: DataFrame, key: str, root: str, name: Callable[[int], str], render: Callable[[int, "pd.DataFrame"], bytes]) -> None:
    """One landed file for each value of ``key``, written by the task that holds its rows (a bounded number a key)."""
    import io

    import pandas as pd

    from fiscalflow.sources.archives import write_stream

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf[key].iloc[0])
        write_stream(f"{root}/{name(k)}", io.BytesIO(render(k, pdf)))
        return pd.DataFrame({"k": [k]})

    frame.groupBy(key).applyInPandas(write, "k long").agg(F.count(F.lit(1))).collect()


#: Customers in a landed file.
_PER_FILE = 200


def _customer_files(spark, sf) -> str:
    """``customer`` as one CSV file a range of keys; separator, encoding and line breaks within quotes differ by file."""
    from fiscalflow.session import scratch_path

    root = scratch_path(spark, "landing-files")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.floor(F.col("c_custkey") / _PER_FILE).cast("long").alias("parte"))

    def render(k, pdf):
        sep, name = ";,\t|"[k % 4], "ção" if k % 3 == 0 else "cao"
        rows = [sep.join((str(r.c_custkey), f'"{r.c_name}\n{name}"' if k % 5 == 0 else f"{r.c_name} {name}", r.c_mktsegment)) for r in pdf.itertuples()]
        return ("\n".join([sep.join(("codigo", "nome", "segmento")), *rows]) + "\n").encode("latin-1" if k % 2 else "utf-8")

    _land_groups(c, "parte", root, "clientes_{}.csv".format, render)
    return root


@register(
    "csv_dialect",
    "SELECT 'clientes_' || parte || '.csv' AS arquivo, CASE WHEN parte % 3 = 0 AND parte % 2 = 1 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, "
    "CASE parte % 4 WHEN 0 THEN ';' WHEN 1 THEN ',' WHEN 2 THEN chr(9) ELSE '|' END AS sep, parte % 5 = 0 AS multilinha, count(*) + 1 AS registros "
    "FROM (SELECT CAST(c_custkey // 200 AS BIGINT) AS parte FROM customer) GROUP BY parte",
)
def q_csv_dialect(spark, sf):
    """What is found out about each landed file, by ranges of it."""
    from fiscalflow.sources.dialect import detect_dialects

    listing = spark.read.format("binaryFile").load(_customer_files(spark, sf))
    found = detect_dialects(listing.select("path")).where("erro IS NULL")
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo"), "encoding", "sep", "multilinha", "registros")


_CUSTOMER_TEXT = (
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
    "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"
)


@register("bronze_convert", _CUSTOMER_TEXT)
def q_bronze_convert(spark, sf):
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.files import bronze_convert

    root = _customer_landing(spark, sf)
    out = bronze_convert(spark, f"{root}/ponto_e_virgula", scratch_path(spark, "bronze"), sep=";", encoding="ISO-8859-1")
    return out.drop("arquivo_origem")


_SCHEMA_CLASSES_SQL = """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders"""


@register("scan_parquet_dir", _SCHEMA_CLASSES_SQL)
def q_scan_parquet_dir(spark, sf):
    from fiscalflow.operators.union import relaxed_union
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.files import scan_parquet_dir

    o = table(spark, sf, "orders")
    folder = scratch_path(spark, "parquet-dir")
    o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).write.mode("append").parquet(folder)
    o.filter(F.col("o_orderpriority") == "3-MEDIUM").drop("o_orderstatus").write.mode("append").parquet(folder)
    o.filter(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")).withColumn(
        "o_custkey", F.col("o_custkey").cast("string")
    ).write.mode("append").parquet(folder)
    return relaxed_union(scan_parquet_dir(spark, folder))


def _ingested(spark, sf, merge: bool = True):
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv, write_parquet

    root = scratch_path(spark, "landing-ingest")
    write_csv(table(spark, sf, "customer"), f"{root}/clientes", sep=";", encoding="ISO-8859-1")
    write_csv(table(spark, sf, "supplier"), f"{root}/fornecedores", sep="|")
    write_parquet(table(spark, sf, "nation"), f"{root}/nacoes")
    return ingest(spark, root, scratch_path(spark, "ingest"), group="CADASTRO", merge=merge)


@register(
    "ingest_end_to_end",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment,
       NULL::VARCHAR AS s_suppkey, NULL::VARCHAR AS s_name, NULL::VARCHAR AS s_nationkey, NULL::VARCHAR AS s_acctbal,
       NULL::INTEGER AS n_nationkey, NULL::VARCHAR AS n_name, NULL::INTEGER AS n_regionkey, 'CADASTRO' AS grupo_mescla
FROM customer
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR),
       NULL, NULL, NULL, 'CADASTRO' FROM supplier
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, n_nationkey, n_name, n_regionkey, 'CADASTRO' FROM nation""",
)
def q_ingest_end_to_end(spark, sf):
    return _ingested(spark, sf).unified.drop("arquivo_origem")


_MANIFEST_SQL = (
    "SELECT DISTINCT 'clientes_' || (c_custkey // 200) || '.csv' AS nome_arquivo, 'clientes_' || (c_custkey // 200) || '.csv' AS caminho_relativo, "
    "'clientes_' || (c_custkey // 200) || '.csv' AS arquivo_origem, 'CADASTRO' AS grupo_mescla_padrao, 'arquivo_tabular' AS origem_tipo FROM customer"
)


def _listed_customers(spark, sf):
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path

    return ingest(spark, _customer_files(spark, sf), scratch_path(spark, "ingest-files"), group="CADASTRO", merge=False)


_MANIFEST_COLUMNS = ("nome_arquivo", "caminho_relativo", "arquivo_origem", "grupo_mescla_padrao", "origem_tipo")


@register("manifest_build", _MANIFEST_SQL)
def q_manifest_build(spark, sf):
    return _listed_customers(spark, sf).manifest.select(*_MANIFEST_COLUMNS)


@register("manifest_roundtrip", _MANIFEST_SQL)
def q_manifest_roundtrip(spark, sf):
    from fiscalflow.sources.manifest import read_manifest

    return read_manifest(spark, f"{_listed_customers(spark, sf).out_dir}/manifesto").select(*_MANIFEST_COLUMNS)


@register("csv_quoted_ranges", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents")
def q_csv_quoted_ranges(spark, sf):
    """``documents`` as CSV with line breaks between quotes, each file cut into records by as many tasks as it has ranges."""
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.csv_ranges import read_csv_by_ranges
    from fiscalflow.sources.sinks import write_csv

    root = write_csv(table(spark, sf, "documents").select("doc_id", "lang", "text"), scratch_path(spark, "csv-ranges"), sep=";")
    files = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(root).select("path").collect()]
    return read_csv_by_ranges(spark, files, ["doc_id", "lang", "text"], sep=";").select("doc_id", "lang", "text")


_FAULT_LINE = (
    "n || ';' || o_orderkey || ';' || CASE WHEN o_orderkey % 13 = 0 THEN 'n/d' ELSE CAST(o_custkey AS VARCHAR) END || ';' || "
    "CASE WHEN o_orderkey % 17 = 0 THEN '31/02' ELSE strftime(o_orderdate, '%Y-%m-%d') END || ';\"linha ' || n || chr(10) || 'de \"\"' || o_orderstatus || '\"\"\"' || "
    "CASE WHEN o_orderkey % 19 = 0 THEN ';extra' ELSE '' END"
)


@register(
    "csv_rejected_rows",
    "WITH o AS (SELECT *, CAST(o_orderkey // 5000 AS BIGINT) AS parte, row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) AS n FROM orders), "
    f"l AS (SELECT 'pedidos_' || parte || '.csv' AS arquivo, n AS registro, o_orderkey, {_FAULT_LINE} AS linha FROM o) "
    "SELECT arquivo, registro, linha, 'o_custkey' AS coluna, 'nao e int' AS motivo FROM l WHERE o_orderkey % 13 = 0 UNION ALL "
    "SELECT arquivo, registro, linha, 'o_orderdate', 'nao e date' FROM l WHERE o_orderkey % 17 = 0 UNION ALL "
    "SELECT arquivo, registro, linha, NULL, 'numero de valores diferente do cabecalho' FROM l WHERE o_orderkey % 19 = 0",
)
def q_csv_rejected_rows(spark, sf):
    """``orders`` landed with bad values and rows too long; each fault comes back with its file, record number and line."""
    from pyspark.sql.window import Window

    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path

    root = scratch_path(spark, "landing-faults")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dia"), F.floor(F.col("o_orderkey") / 5000).cast("long").alias("parte"))
    o = o.withColumn("n", F.row_number().over(Window.partitionBy("parte").orderBy("o_orderkey")))  # at most 5000 rows a file

    def render(k, pdf):
        lines = ["n;o_orderkey;o_custkey;o_orderdate;nota"]
        for r in pdf.sort_values("n").itertuples():
            key = r.o_orderkey
            lines.append(f'{r.n};{key};{"n/d" if key % 13 == 0 else r.o_custkey};{"31/02" if key % 17 == 0 else r.dia};"linha {r.n}\nde ""{r.o_orderstatus}"""{";extra" if key % 19 == 0 else ""}')
        return ("\n".join(lines) + "\n").encode()

    _land_groups(o, "parte", root, "pedidos_{}.csv".format, render)
    res = ingest(spark, root, scratch_path(spark, "ingest-faults"), group="PEDIDOS", schema="o_custkey int, o_orderdate date", merge=False)
    return res.rejected_rows()


@register(
    "odd_headers_ingest",
    "SELECT CAST(c_custkey AS VARCHAR) AS codigo, CAST(c_nationkey AS VARCHAR) AS valor_total, c_name AS nome, "
    "CASE WHEN (c_custkey // 200) % 3 = 2 THEN c_mktsegment END AS repetida, "
    "CASE WHEN (SELECT count(DISTINCT c_custkey // 200) FROM customer) = 1 THEN 'dados.csv' ELSE 'p' || (c_custkey // 200) || '/dados.csv' END AS arquivo_origem, "
    "'CADASTRO' AS grupo_mescla FROM customer",
)
def q_odd_headers_ingest(spark, sf):
    """Files of one name in many folders; headers with a dot, in other case, or with a name twice."""
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path

    root = scratch_path(spark, "landing-odd")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment", F.floor(F.col("c_custkey") / _PER_FILE).cast("long").alias("parte"))
    headers = ["codigo;valor.total;Nome", "CODIGO;nome;Valor.Total", "codigo;valor.total;nome;nome"]

    def render(k, pdf):
        rows = [[str(r.c_custkey), *((r.c_name, str(r.c_nationkey)) if k % 3 == 1 else (str(r.c_nationkey), r.c_name)), *([r.c_mktsegment] if k % 3 == 2 else [])] for r in pdf.itertuples()]
        return "\n".join([headers[k % 3], *map(";".join, rows), ""]).encode()

    _land_groups(c, "parte", root, "p{}/dados.csv".format, render)
    res = ingest(spark, root, scratch_path(spark, "ingest-odd"), group="CADASTRO")
    if res.errors.count() or res.files_read.count() != res.manifest.count():
        raise ValueError("a file was not read")
    u = res.unified
    repeated = F.col("nome_2") if "nome_2" in u.columns else F.lit(None).cast("string")  # few customers: no file with a name twice
    return u.select("codigo", F.col("`valor.total`").alias("valor_total"), F.col("nome").alias("nome"), repeated.alias("repetida"), "arquivo_origem", "grupo_mescla")


#: Bytes of text of ``documents`` that go into one landed file, twice.
_LATE_BYTES = 32 << 20


@register(
    "csv_late_quotes",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents UNION ALL "
    "SELECT 'a' || CAST(doc_id AS VARCHAR), replace(text, chr(10), ' ') FROM documents",
)
def q_csv_late_quotes(spark, sf):
    """``documents`` landed so that each file starts with texts on one line; line breaks between quotes come after them."""
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv

    root = scratch_path(spark, "landing-late")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    flat = d.select(F.concat(F.lit("a"), "doc_id").alias("doc_id"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    both = flat.withColumn("depois", F.lit(0)).union(d.withColumn("depois", F.lit(1)))
    held = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = both.repartition(max(4, held // _LATE_BYTES), F.regexp_replace("doc_id", "^a", "")).sortWithinPartitions("depois").select("doc_id", "text")
    write_csv(ordered, f"{root}/csv", sep=";")
    return ingest(spark, root, scratch_path(spark, "ingest-late"), group="DOCUMENTOS").unified.select("doc_id", "text")


@register(
    "csv_blanks_roundtrip",
    "SELECT doc_id, unnest(['  ' || text || ' ', '', NULL, 'a \"b\", ' || text, text]) AS v FROM documents",
)
def q_csv_blanks_roundtrip(spark, sf):
    """Blanks around values, empty texts, nulls, quotes and line breaks survive a CSV round trip: every text in each form."""
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.files import read_csv
    from fiscalflow.sources.sinks import write_csv

    forms = F.array(F.concat(F.lit("  "), "text", F.lit(" ")), F.lit(""), F.lit(None).cast("string"), F.concat(F.lit('a "b", '), "text"), F.col("text"))
    out = write_csv(table(spark, sf, "documents").select("doc_id", F.explode(forms).alias("v")), scratch_path(spark, "csv-blanks"))
    return read_csv(spark, out, schema="doc_id long, v string", multiline=True)


@register(
    "xls_rows",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, o_totalprice FROM orders",
)
def q_xls_rows(spark, sf):
    """``orders`` written as binary ``.xls`` workbooks by tasks, and their rows read back."""
    import uuid

    from fiscalflow.session import materialize, scratch_path
    from fiscalflow.sources.sheets import promote_header, spreadsheet_rows

    root = scratch_path(spark, "landing-xls")

    def write(batches):
        import io

        import pandas as pd

        from fiscalflow.plans.xls_landing import xls_bytes
        from fiscalflow.sources.archives import write_stream

        for pdf in batches:
            target = f"{root}/{uuid.uuid4().hex}.xls"
            rows = zip(pdf["o_orderkey"].tolist(), [d.to_pydatetime() for d in pd.to_datetime(pdf["dia"])], pdf["o_orderpriority"], pdf["o_totalprice"].tolist(), strict=True)
            write_stream(target, io.BytesIO(xls_bytes([["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"], *rows])))
            yield pd.DataFrame({"path": [target]})

    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dia"), "o_orderpriority", "o_totalprice")
    books = materialize(o.mapInPandas(write, "path string"), spark, "workbooks")
    (_names, rows), = promote_header(materialize(spreadsheet_rows(books), spark, "cells"))
    return rows.select("o_orderkey", "o_orderdate", "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@register(
    "spreadsheet_rows",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
)
def q_spreadsheet_rows(spark, sf):
    """``orders`` written as ``.xlsx`` workbooks by tasks (dates as styled day counts), and their rows read back."""
    from fiscalflow.session import materialize, scratch_path
    from fiscalflow.sources.sheets import promote_header, spreadsheet_rows

    root = scratch_path(spark, "landing-xlsx")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    o = table(spark, sf, "orders").select("o_orderkey", day.alias("dia"), "o_orderpriority")
    books = materialize(o.mapInPandas(_write_workbooks(root), "path string"), spark, "workbooks")
    (_names, rows), = promote_header(materialize(spreadsheet_rows(books), spark, "cells"))
    return rows.select("o_orderkey", "o_orderdate", "o_orderpriority")


def _write_workbooks(root: str):
    """mapInPandas body: one workbook for each batch of rows, its sheet streamed out row by row."""
    import uuid

    import pandas as pd

    from fiscalflow.sources.archives import write_stream

    def run(batches):
        import tempfile
        import zipfile
        from xml.sax.saxutils import escape

        main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        for pdf in batches:
            target = f"{root}/{uuid.uuid4().hex}.xlsx"
            with tempfile.TemporaryFile() as raw:
                with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zf:
                    zf.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" sheetId="1" r:id="r1"/></sheets></workbook>')
                    zf.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
                    with zf.open("xl/worksheets/sheet1.xml", "w") as fh:
                        text = lambda v: f'<c t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
                        fh.write(f'<worksheet {main}><sheetData><row>{text("o_orderkey")}{text("o_orderdate")}{text("o_orderpriority")}</row>'.encode())
                        for key, day, priority in zip(pdf["o_orderkey"], pdf["dia"], pdf["o_orderpriority"], strict=True):
                            fh.write(f'<row><c><v>{key}</v></c><c s="1"><v>{day}</v></c>{text(priority)}</row>'.encode())
                        fh.write(b"</sheetData></worksheet>")
                raw.seek(0)
                write_stream(target, raw)
            yield pd.DataFrame({"path": [target]})

    return run


@register(
    "sql_over_frame",
    "SELECT year(o_orderdate) AS ano, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2",
)
def q_sql_over_frame(spark, sf):
    """SQL over a DataFrame by name, without a view."""
    frame = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return spark.sql("SELECT year(o_orderdate) AS ano, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM {df} GROUP BY 1, 2", df=frame)


@register(
    "typed_ingest",
    "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_nationkey END AS s_nationkey, "
    "s_acctbal, CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS rejeitada FROM supplier WHERE s_suppkey > 4",
)
def q_typed_ingest(spark, sf):
    """``supplier`` as CSV text with a bad value in every tenth row: typed on ingest, so numeric predicates work; bad values are counted."""
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv

    root = scratch_path(spark, "landing-typed")
    s = table(spark, sf, "supplier")
    bad = F.when(F.col("s_suppkey") % 10 == 0, F.lit("n/d")).otherwise(F.col("s_nationkey").cast("string"))
    write_csv(s.withColumn("s_nationkey", bad), f"{root}/f", sep="|")
    schema = "s_suppkey long, s_nationkey int, s_acctbal double"
    res = ingest(spark, root, scratch_path(spark, "ingest-typed"), group="F", schema=schema, where="s_suppkey > 4")
    rejected = res.rejects.agg(F.sum("linhas")).first()[0] or 0
    if rejected != s.where("s_suppkey % 10 = 0").count():
        raise ValueError(f"{rejected} rows counted as rejected")
    flag = F.when(F.col("s_nationkey").isNull(), 1).otherwise(0)
    return res.unified.select("s_suppkey", "s_name", F.col("s_nationkey"), "s_acctbal", flag.alias("rejeitada"))


@register(
    "single_file_manifest",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'PEDIDOS' AS grupo_mescla FROM orders",
)
def q_single_file_manifest(spark, sf):
    """A manifest of one row, the table's own file, with ``merge_single=False``: nothing is written, the tagged rows are the result."""
    from fiscalflow.plans.ingest import merge_from_manifest
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.manifest import MANIFEST_SCHEMA

    path = f"{sf.rstrip('/')}/orders.parquet"
    row = (path, "orders.parquet", "pedidos.parquet", path, "pedidos.parquet", "", "arquivo_tabular")
    res = merge_from_manifest(spark, spark.createDataFrame([row], MANIFEST_SCHEMA), scratch_path(spark, "merged-single"), merge_single=False)
    if res.merge.outputs:
        raise ValueError("a single file was rewritten")
    return res.unified.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "grupo_mescla")


@register(
    "merge_from_manifest",
    "SELECT upper(lower(regexp_replace(o_orderpriority, '^[0-9]+-', ''))) AS grupo_mescla, count(*) AS linhas, "
    "round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def q_merge_from_manifest(spark, sf):
    """Orders landed as one Parquet folder per priority; the manifest names
    each file after its priority (``pedidos_<priority>.parquet``)."""
    from fiscalflow.plans.ingest import list_files, merge_from_manifest, norm_path
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.manifest import MANIFEST_SCHEMA

    root = scratch_path(spark, "landing-manifest")
    o = table(spark, sf, "orders").withColumn("prioridade", F.lower(F.regexp_replace("o_orderpriority", r"^[0-9]+-", "")))
    o.write.mode("overwrite").partitionBy("prioridade").parquet(root)
    rows = []
    for p in list_files(spark, root):
        local = norm_path(p)
        if not local.endswith(".parquet"):
            continue
        prio = local.split("prioridade=", 1)[1].split("/", 1)[0]
        name = f"pedidos_{prio}.parquet"
        rows.append((local, local[len(norm_path(root)) + 1:], name, local, name, "", "arquivo_tabular"))
    res = merge_from_manifest(spark, spark.createDataFrame(rows, MANIFEST_SCHEMA), scratch_path(spark, "merged-manifest"))
    return res.unified.groupBy("grupo_mescla").agg(
        F.count(F.lit(1)).alias("linhas"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@register(
    "incremental_ingest",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y%m%d') AS grupo_mescla FROM events",
)
def q_incremental_ingest(spark, sf):
    """``events`` land as CSV files by day in two waves; each incremental run
    picks up only the files it has not seen."""
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv
    from fiscalflow.streaming.incremental import read_output, run_incremental

    ev = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyyMMdd").alias("dia")
    )
    src, out = scratch_path(spark, "events-src"), scratch_path(spark, "events-out")
    schema = "event_id long, user_id long, event_type string, value double"
    days = ev.select(F.min("dia").alias("lo"), F.max("dia").alias("hi")).first()
    cut = str((int(days.lo) + int(days.hi)) // 2)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"dia=([0-9]{8})", 1)
    for cond in (F.col("dia") <= cut, F.col("dia") > cut):
        # the second wave lands after the first run: only its files are read
        ev.filter(cond).write.mode("append").partitionBy("dia").option("header", True).csv(src)
        run_incremental(spark, src, schema, out, name=day)
    got = read_output(spark, out)
    return got.select("event_id", "user_id", "event_type", "value", F.col("grupo_mescla"))


def _zip_parts(out_dir: str):
    """mapInPandas body: pack each landed CSV part into its own archive
    (every second one nested one level deeper), written under ``out_dir``."""
    import tempfile
    import zipfile

    import pandas as pd

    from fiscalflow.sources.archives import open_input, write_stream

    def run(batches):
        for pdf in batches:
            made = []
            for path in pdf["path"]:
                stem = path.rsplit("/", 1)[-1].split(".", 1)[0]
                target = f"{out_dir.rstrip('/')}/documentos_{stem}.zip"
                with tempfile.TemporaryFile() as inner, tempfile.TemporaryFile() as outer:
                    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as zf, open_input(path) as src, zf.open(f"documentos/{stem}.csv", "w") as dst:
                        shutil.copyfileobj(src, dst, 8 << 20)
                    inner.seek(0)
                    if sum(map(ord, stem)) % 2:  # nest this one: outer.zip::inner.zip::entry
                        with zipfile.ZipFile(outer, "w", zipfile.ZIP_STORED) as zf, zf.open(f"interno_{stem}.zip", "w") as dst:
                            shutil.copyfileobj(inner, dst, 8 << 20)
                        outer.seek(0)
                    write_stream(target, outer if sum(map(ord, stem)) % 2 else inner)
                made.append(target)
            yield pd.DataFrame({"path": made})

    return run


@register(
    "zip_entries",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, text, 'DOCUMENTOS' AS grupo_mescla FROM documents",
)
def q_zip_entries(spark, sf):
    """``documents`` landed as ``;`` CSV parts, each packed into a zip (some
    nested), then expanded and ingested: whole texts, quoted newlines
    included, must come back unchanged."""
    from fiscalflow.plans.ingest import ingest
    from fiscalflow.session import scratch_path
    from fiscalflow.sources.sinks import write_csv

    root = scratch_path(spark, "landing-zip")
    write_csv(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), f"{root}/csv", sep=";")
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{root}/csv").select("path")
    parts.mapInPandas(_zip_parts(f"{root}/zips"), "path string").collect()  # one row per archive written
    res = ingest(spark, f"{root}/zips", scratch_path(spark, "ingest-zip"), group="DOCUMENTOS")
    return res.unified.select("doc_id", "lang", "source", "text", "grupo_mescla")


_GRAPH = "CAST(page_id AS BIGINT) AS i, (SELECT count(*) FROM pages) AS n"


@register(
    "recursive_listing",
    f"WITH RECURSIVE p AS (SELECT {_GRAPH} FROM pages), "
    "e AS (SELECT i, 2 * i + 1 AS j FROM p WHERE i % 5 <> 3 UNION ALL SELECT i, 2 * i + 2 FROM p WHERE i % 7 <> 4 UNION ALL SELECT i, i // 3 FROM p), "
    "r AS (SELECT CAST(0 AS BIGINT) AS i UNION SELECT e.j FROM r JOIN e ON e.i = r.i) "
    "SELECT 'http://lista.example.org/p/' || r.i AS pagina, 'http://lista.example.org/p/' || r.i || '/dados_' || r.i || '.csv' AS url_link FROM r JOIN p ON p.i = r.i",
)
def q_recursive_listing(spark, sf):
    """``pages`` as listing pages that link to each other's folders, with cycles and dead ends; every file reached from the first."""
    from fiscalflow.sources.crawl import crawl

    i = F.col("page_id").cast("long")
    link = lambda cond, j: F.when(cond, F.concat(F.lit('<a href="/p/'), j.cast("string"), F.lit('/">pasta</a>'))).otherwise(F.lit(""))
    links = F.concat(link(i % 5 != 3, 2 * i + 1), link(i % 7 != 4, 2 * i + 2), link(F.lit(True), F.floor(i / 3)), F.lit('<a href="dados_'), i.cast("string"), F.lit('.csv">dados</a>'))
    pages = table(spark, sf, "pages").select(F.concat(F.lit("http://lista.example.org/p/"), i.cast("string"), F.lit("/")).alias("url"), F.concat(links, "html").alias("html"))
    return crawl(pages, ["http://lista.example.org/p/0/"]).files.select("pagina", "url_link")


@register(
    "exact_median",
    "SELECT l_returnflag, l_linestatus, median(l_extendedprice * (1 - l_discount)) AS mediana FROM lineitem GROUP BY 1, 2",
)
def q_exact_median(spark, sf):
    """The exact median of a continuous column, by selection: no state that grows with a key."""
    from fiscalflow.operators.selection import exact_median

    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("valor"))
    return exact_median(rows, ["l_returnflag", "l_linestatus"], "valor")


_REGIONS = ("NORTE", "SUL", "LESTE", "OESTE")


@register(
    "merge_changed_groups",
    "WITH c AS (SELECT c_custkey, c_name, CAST(c_custkey // 200 AS BIGINT) AS parte FROM customer), "
    "g AS (SELECT *, CASE parte % 4 WHEN 0 THEN 'NORTE' WHEN 1 THEN 'SUL' WHEN 2 THEN 'LESTE' ELSE 'OESTE' END AS grupo_mescla FROM c), "
    "u AS (SELECT DISTINCT grupo_mescla FROM g WHERE parte = (SELECT max(parte) FROM g)) "
    "SELECT CAST(c_custkey AS VARCHAR) AS codigo, c_name AS nome, grupo_mescla, CASE WHEN grupo_mescla IN (FROM u) AND (SELECT max(parte) FROM g) > 0 THEN 2 ELSE 1 END AS desde FROM g",
)
def q_merge_changed_groups(spark, sf):
    """All files but the last are merged, then the last one lands: only its group is merged again."""
    from fiscalflow.plans.versions import merge_changed, read_version
    from fiscalflow.session import scratch_path

    root, out = scratch_path(spark, "landing-versions"), scratch_path(spark, "versions")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.floor(F.col("c_custkey") / _PER_FILE).cast("long").alias("parte"))
    last = c.agg(F.max("parte")).first()[0]

    def render(k, pdf):
        return "\n".join(["codigo;nome", *(f"{r.c_custkey};{r.c_name}" for r in pdf.itertuples()), ""]).encode()

    for wave in ([F.col("parte") < last, F.col("parte") == last] if last else [F.lit(True)]):
        _land_groups(c.where(wave), "parte", root, lambda k: f"clientes-{k}_{_REGIONS[k % 4]}.csv", render)
        merge_changed(spark, root, out)
    return read_version(spark, out).select("codigo", "nome", "grupo_mescla", "desde")


@register(
    "landing_stream",
    "SELECT CAST(c_custkey AS VARCHAR) AS codigo, c_name AS nome, CASE WHEN (c_custkey // 200) % 3 = 0 THEN 'clientes_' || (c_custkey // 200) || '.zip::dados.csv' "
    "WHEN (c_custkey // 200) % 3 = 1 THEN 'clientes_' || (c_custkey // 200) || '.xls' ELSE 'clientes_' || (c_custkey // 200) || '.csv' END AS arquivo_origem, "
    "CAST(CASE WHEN (c_custkey // 200) % 2 = 0 THEN 0 ELSE 1 END AS BIGINT) AS lote FROM customer",
)
def q_landing_stream(spark, sf):
    """Archives, binary workbooks and CSV files land in two waves; each run takes only the files it has not seen."""
    import io
    import zipfile

    from fiscalflow.plans.xls_landing import xls_bytes
    from fiscalflow.session import scratch_path
    from fiscalflow.streaming.landing import read_landing, run_landing

    root, out = scratch_path(spark, "landing-stream"), scratch_path(spark, "stream-out")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.floor(F.col("c_custkey") / _PER_FILE).cast("long").alias("parte"))

    def render(k, pdf):
        rows = [["codigo", "nome"], *([int(r.c_custkey), r.c_name] for r in pdf.itertuples())]
        if k % 3 == 1:
            return xls_bytes(rows)
        text = "".join(f"{a};{b}\n" for a, b in rows).encode()
        if k % 3 == 2:
            return text
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as zf:
            zf.writestr("dados.csv", text)
        return raw.getvalue()

    ext = ("zip", "xls", "csv")
    for wave in (0, 1):
        _land_groups(c.where(F.col("parte") % 2 == wave), "parte", root, lambda k: f"clientes_{k}.{ext[k % 3]}", render)
        run_landing(spark, root, out)
    return read_landing(spark, out).select("codigo", "nome", "arquivo_origem", "lote")
