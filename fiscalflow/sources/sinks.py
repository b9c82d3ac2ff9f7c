"""Sinks: Parquet and CSV writes, and the filtered materialisation.

Writes go through Spark's commit protocol (task output is promoted only
when the job commits), which replaces the reference's "file exists after
writing" check and keeps a rerun idempotent with ``mode("overwrite")``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.operators.extract import extract
from fiscalflow.session import scratch_path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(
    df: DataFrame, path: str, *, sep: str = ",", encoding: str = "UTF-8", header: bool = True
) -> str:
    """CSV with a header, RFC 4180 quoting (a quote inside a field is doubled).

    Blanks around values and empty texts are kept.  A value that ``encoding``
    cannot hold fails the write: Spark would put ``?`` in its place.
    """
    from fiscalflow.sources.csv_options import writer_options

    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8", "UTF-16"):
        checked = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StringType):
                held = ~c.rlike(r"[^\x00-\xFF]") if encoding.upper() == "ISO-8859-1" else F.decode(F.encode(c, encoding), encoding) == c
                c = F.when(held, c).otherwise(F.when(c.isNotNull(), F.raise_error(F.concat(F.lit(f"{encoding} cannot hold: "), c)))).alias(f.name)
            checked.append(c)
        df = df.select(*checked)
    df.write.mode("overwrite").options(**writer_options(sep, encoding, header)).csv(path)
    return path


def materialize_extract(
    spark: SparkSession,
    df: DataFrame,
    *,
    filters: Column | Sequence[Column] | None = None,
    where: str | None = None,
    columns: Sequence[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Filters, SQL predicate and columns applied at the scan, result written
    as Parquet (under the shared checkpoint folder unless ``path`` is
    given) and read back."""
    out = path or scratch_path(spark, "extract")
    write_parquet(extract(df, filters=filters, where=where, columns=columns), out)
    return spark.read.parquet(out)
