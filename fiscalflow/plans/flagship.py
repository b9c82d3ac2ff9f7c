"""Flagship plan: the reference's central question on the test tables.

Monthly paid value (fines derived from ``orders``, per customer nation and
decision month) against the monthly complaint index (derived from
``lineitem``, per supplier nation and ship month), inner-joined on
(nation, month) inside the exclusive analysis window, then z-scored,
base-100 indexed and min-max scaled per nation, ordered by nation and
month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.operators import scaling
from fiscalflow.plans.analysis import joined_months

SERIES = ["IGR", "VALOR_MES"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = scaling.scale_all(joined_months(spark, sf_dir), SERIES, ["NATION"], "COMPETENCIA")
    return j.orderBy("NATION", "COMPETENCIA").select(
        "NATION",
        "COMPETENCIA",
        "IGR",
        "QTD_RECLAMACOES",
        "VALOR_MES",
        *[F.round(f"{c}{s}", 6).alias(f"{c}{s}") for s in ("_Z", "_B100", "_MINMAX") for c in SERIES],
    )
