"""DuckDB restatements of the derived tables used by the query catalog.

These are the SQL twins of ``plans.analysis``; each catalog entry prefixes
its final SELECT with the CTEs it needs.  Plain ANSI SQL plus DuckDB's
``regexp_extract``/``strftime``/``try_strptime``/``list_reduce``.
"""

from __future__ import annotations

FINES = """fines AS (
  SELECT o.o_orderkey AS NR_DEMANDA, o.o_custkey AS REGISTRO_OPERADORA, o.o_orderstatus AS STATUS_DEMANDA,
         o.o_orderpriority AS TIPO_PENALIDADE,
         strftime(CAST(o.o_orderdate AS DATE), '%d/%m/%Y') AS DT_PUBLICACAO_1A_FINAL,
         CASE WHEN o.o_orderstatus <> 'P'
              THEN 'pago em ' || strftime(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 120 AS INTEGER), '%d/%m/%Y')
              ELSE 'pendente' END AS DT_PAGTO_A_VISTA_ANS,
         o.o_totalprice AS VL_PAGO_A_VISTA_ANS,
         c.c_nationkey AS NATION
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

PARSE = "CAST(try_strptime(NULLIF(regexp_extract({c}, '(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})', 1), ''), '%d/%m/%Y') AS DATE)"

PARSED_FINES = f"""parsed AS (
  SELECT NR_DEMANDA, REGISTRO_OPERADORA, STATUS_DEMANDA, TIPO_PENALIDADE,
         {PARSE.format(c='DT_PUBLICACAO_1A_FINAL')} AS DT_PUBLICACAO_1A_FINAL,
         {PARSE.format(c='DT_PAGTO_A_VISTA_ANS')} AS DT_PAGTO_A_VISTA_ANS,
         VL_PAGO_A_VISTA_ANS, NATION
  FROM fines)"""

MONTHLY_FINES = """mfines AS (
  SELECT NATION, last_day(DT_PUBLICACAO_1A_FINAL) AS COMPETENCIA, round(sum(VL_PAGO_A_VISTA_ANS), 2) AS VALOR_MES
  FROM parsed
  WHERE NATION IS NOT NULL AND DT_PUBLICACAO_1A_FINAL IS NOT NULL AND DT_PAGTO_A_VISTA_ANS IS NOT NULL
    AND VL_PAGO_A_VISTA_ANS IS NOT NULL AND DT_PUBLICACAO_1A_FINAL > DATE '1995-12-31'
  GROUP BY 1, 2)"""

RAW_INDEX = """rawidx AS (
  SELECT NATION, COMPETENCIA,
         CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS IGR,
         QTD_RECLAMACOES
  FROM (
    SELECT s.s_nationkey AS NATION,
           CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS COMPETENCIA,
           (sum(CAST(l.l_quantity AS BIGINT)) * 100) // count(*) AS cents,
           count(*) AS QTD_RECLAMACOES
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    GROUP BY 1, 2) g)"""

MONTHLY_INDEX = """midx AS (
  SELECT NATION, COMPETENCIA, IGR, QTD_RECLAMACOES FROM (
    SELECT NATION,
           last_day(CAST(try_strptime(CAST(COMPETENCIA AS VARCHAR), '%Y%m') AS DATE)) AS COMPETENCIA,
           TRY_CAST(replace(IGR, ',', '.') AS DOUBLE) AS IGR,
           QTD_RECLAMACOES
    FROM rawidx) x
  WHERE COMPETENCIA > DATE '1995-12-31' AND COMPETENCIA < DATE '2001-02-01')"""

JOINED = """joined AS (
  SELECT i.NATION, i.COMPETENCIA, i.IGR, i.QTD_RECLAMACOES, f.VALOR_MES
  FROM midx i JOIN mfines f ON i.NATION = f.NATION AND i.COMPETENCIA = f.COMPETENCIA)"""

ANALYSIS = [FINES, PARSED_FINES, MONTHLY_FINES, RAW_INDEX, MONTHLY_INDEX, JOINED]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def scaled_sql(cols: list[str]) -> str:
    """CTE ``scaled``: joined + z-score, base-100 and min-max per nation."""
    parts = ["j.*"]
    for c in cols:
        parts.append(
            f"CASE WHEN stddev_pop({c}) OVER w > 0 THEN ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w END AS {c}_Z"
        )
        parts.append(
            f"CASE WHEN first_value({c}) OVER wo <> 0 THEN {c} / first_value({c}) OVER wo * 100 END AS {c}_B100"
        )
        parts.append(
            f"CASE WHEN max({c}) OVER w - min({c}) OVER w <> 0 "
            f"THEN ({c} - min({c}) OVER w) / (max({c}) OVER w - min({c}) OVER w) END AS {c}_MINMAX"
        )
    return (
        "scaled AS (SELECT " + ", ".join(parts) + " FROM joined j "
        "WINDOW w AS (PARTITION BY NATION), wo AS (PARTITION BY NATION ORDER BY COMPETENCIA "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
    )


def decompose_sql(source: str, key: str, order: str, cols: list[str], period: int = 12) -> list[str]:
    """CTEs ``dec_base``, ``dec_pa``, ``dec_mu``, ``dec`` for the additive
    decomposition, summing in series order like the Spark side."""
    h = period // 2
    tr = []
    for c in cols:
        terms = [f"0.5 * lag({c}, {h}) OVER w"]
        terms += [f"lag({c}, {j}) OVER w" for j in range(h - 1, 0, -1)]
        terms += [f"CAST({c} AS DOUBLE)"] + [f"lead({c}, {j}) OVER w" for j in range(1, h)]
        terms += [f"0.5 * lead({c}, {h}) OVER w"]
        tr.append(f"CASE WHEN count(*) OVER wa >= {2 * period} THEN ({' + '.join(terms)}) / {period} END AS {c}_TREND")
    base = (
        f"dec_base AS (SELECT s.*, row_number() OVER w - 1 AS pos, (row_number() OVER w - 1) % {period} AS phase, "
        + ", ".join(tr)
        + f" FROM {source} s WINDOW w AS (PARTITION BY {key} ORDER BY {order}), wa AS (PARTITION BY {key}))"
    )
    pa = []
    for i, c in enumerate(cols):
        d = f"(CAST({c} AS DOUBLE) - {c}_TREND)"
        pa.append(
            f"list_reduce(list_prepend(0.0, list({d} ORDER BY pos) FILTER (WHERE {d} IS NOT NULL)), lambda a, b: a + b)"
            f" / NULLIF(count({d}), 0) AS pa{i}"
        )
    pa_cte = f"dec_pa AS (SELECT {key}, phase, " + ", ".join(pa) + f" FROM dec_base GROUP BY {key}, phase)"
    mu = [
        f"list_reduce(list_prepend(0.0, list(pa{i} ORDER BY phase)), lambda a, b: a + b) / NULLIF(count(pa{i}), 0) AS mu{i}"
        for i in range(len(cols))
    ]
    mu_cte = f"dec_mu AS (SELECT {key}, " + ", ".join(mu) + f" FROM dec_pa GROUP BY {key})"
    seas = []
    for i, c in enumerate(cols):
        s = f"CASE WHEN b.{c}_TREND IS NOT NULL OR cnt.n >= {2 * period} THEN p.pa{i} - m.mu{i} END"
        seas.append(f"{s} AS {c}_SEASONAL")
    dec = (
        "dec0 AS (SELECT b.*, "
        + ", ".join(seas)
        + f" FROM dec_base b JOIN dec_pa p ON b.{key} = p.{key} AND b.phase = p.phase"
        f" JOIN dec_mu m ON b.{key} = m.{key}"
        f" JOIN (SELECT {key}, count(*) AS n FROM {source} GROUP BY {key}) cnt ON b.{key} = cnt.{key})"
    )
    resid = ", ".join(f"CAST({c} AS DOUBLE) - {c}_TREND - {c}_SEASONAL AS {c}_RESID" for c in cols)
    final = f"dec AS (SELECT *, {resid} FROM dec0)"
    return [base, pa_cte, mu_cte, dec, final]
