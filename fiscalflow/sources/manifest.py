"""The manifest: one row per ingested file, seven text fields.

It is a DataFrame built from the file listing and the archive expansion,
written once (no per-file appends), and read back with an all-string schema
so that a group such as ``043`` stays ``043``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Manifest fields; origin kinds (files stay as they landed, so the
# kinds do not claim a conversion).
FIELDS = (
    "caminho_local",
    "caminho_relativo",
    "nome_arquivo",
    "origem_url",
    "arquivo_origem",
    "grupo_mescla_padrao",
    "origem_tipo",
)
KIND_ZIP_ENTRY = "zip_extraido"
KIND_TABULAR = "arquivo_tabular"
KIND_REMOTE = "arquivo_remoto"

MANIFEST_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in FIELDS])
ERROR_SCHEMA = "arquivo string, erro string"
IGNORED_SCHEMA = "arquivo string, motivo string"


def blank_to_null(c: str):
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def normalize_manifest(df: DataFrame) -> DataFrame:
    """Seven text fields in order; blanks become null (``value or ''`` then
    ``strip()`` in the reference, so a blank group means "no group")."""
    cols = []
    for f in FIELDS:
        cols.append(blank_to_null(f).alias(f) if f in df.columns else F.lit(None).cast("string").alias(f))
    return df.select(*cols)


def write_manifest(df: DataFrame, path: str, as_csv: bool = True) -> str:
    """Write once, overwrite on rerun: CSV with header (UTF-8), or Parquet."""
    out = normalize_manifest(df)
    if as_csv:
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        out.write.mode("overwrite").parquet(path)
    return path


def read_manifest(spark: SparkSession, path: str, as_csv: bool = True) -> DataFrame:
    if as_csv:
        return spark.read.schema(MANIFEST_SCHEMA).option("header", True).option("escape", '"').csv(path)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)