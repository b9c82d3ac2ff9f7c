"""File sources: Parquet (file, folder), CSV with a given dialect, and the
bronze conversion (CSV read as all-string columns, written as Parquet).

The bronze layer reads every CSV column as ``string``: one pass, no type
guessing (``inferSchema`` would turn ``007`` into 7 and needs a second pass
over the data).  Typed columns come from a declared schema or from lenient
``try_*`` casts in the silver step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.functions._util import column

REJECTED = "__linha_rejeitada"

#: Encodings in which quotes, separators and line ends are the bytes of ASCII, and no others.
ASCII_BASED = ("UTF-8", "ISO-8859-1", "US-ASCII", "WINDOWS-1252")


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def scan_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def _footer_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    from fiscalflow.sources.dialect import local_or_fs

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                fs, inner = local_or_fs(path)
                schema = pq.read_schema(inner, filesystem=fs) if fs is not None else pq.read_schema(inner)
                out.append((path, str(schema.remove_metadata()), None))
            except Exception as e:  # noqa: BLE001 - an unreadable footer is an error row
                out.append((path, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(out, columns=["path", "esquema", "erro"])


def parquet_schema_classes(spark: SparkSession, paths: Sequence[str]) -> tuple[list[list[str]], list[tuple[str, str]]]:
    """Group Parquet files by footer schema, reading footers in tasks.

    Returns (classes of paths, unreadable (path, error)).  Only one row per
    file comes back to the driver; each class is then read by one scan.
    """
    if not paths:
        return [], []
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = files.mapInPandas(_footer_batches, "path string, esquema string, erro string").collect()
    classes: dict[str, list[str]] = {}
    bad = []
    for r in rows:
        if r.erro:
            bad.append((r.path, r.erro))
        else:
            classes.setdefault(r.esquema, []).append(r.path)
    return [sorted(v) for v in classes.values()], bad


def scan_parquet_dir(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Parquet files directly inside ``folder`` (not recursive; suffix
    matched case-insensitively), one scan per distinct schema.

    Files are listed by Spark's own file index (no bytes read); footers are
    read in tasks.  Files sharing a schema are read by a single scan, so the
    list has one DataFrame per schema class, ready for ``relaxed_union``.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .load(folder)
        .select("path")
        .where(F.lower("path").endswith(".parquet"))
    )
    paths = sorted(r.path for r in listing.collect())  # file names only: metadata-sized
    classes, bad = parquet_schema_classes(spark, paths)
    if bad:
        raise ValueError(f"unreadable Parquet footers: {bad[:5]}")
    return [spark.read.parquet(*map(literal_path, ps)) for ps in classes]


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    schema: T.StructType | str | None = None,
    header: bool = True,
    multiline: bool = False,
    infer: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """CSV with a known dialect.  Malformed values become null (PERMISSIVE);
    with no schema every column is read as string unless ``infer``.

    ``rejects`` adds the text column ``REJECTED``: the whole line of a row
    with too many or too few fields, or with a value that its type cannot
    hold; null for sound rows.  Paths are taken literally (no globs).

    With ``multiline`` and a schema of several columns many tasks read one
    file, by ranges (``csv_ranges``): Spark's own multi-line scan gives a file
    to one task.  (A lone column's blank value would be a blank line there.)
    """
    from fiscalflow.sources.csv_options import reader_options, restore_empties

    if multiline and schema is not None and header and not rejects and sep.strip() and encoding.upper() in ASCII_BASED:
        from fiscalflow.sources.csv_ranges import read_typed_by_ranges

        typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if len(typed.fields) > 1:
            return read_typed_by_ranges(spark, paths, typed, sep=sep, encoding=encoding)
    paths = [literal_path(p) for p in ([paths] if isinstance(paths, str) else paths)]
    options = reader_options(sep, encoding, header, multiline)
    r = spark.read.options(**options)
    if rejects:
        if schema is None:
            schema = (r.option("inferSchema", True) if infer else r).csv(paths).schema
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        return restore_empties(spark.read.options(**options).option("columnNameOfCorruptRecord", REJECTED).schema(schema).csv(paths))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return restore_empties(r.csv(paths))


def bronze_convert(spark: SparkSession, csv_paths: str | Sequence[str], out: str, *, sep: str, encoding: str, multiline: bool = False) -> DataFrame:
    """CSV -> Parquet with every column as string, plus the source file."""
    df = read_csv(spark, csv_paths, sep=sep, encoding=encoding, multiline=multiline)
    df = df.withColumn("arquivo_origem", F.col("_metadata.file_name"))
    df.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def bad_value(field: T.StructField) -> Column:
    """Whether a row's text is neither blank nor a value of the field's type."""
    text = column(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.lit(False)
    return F.coalesce(F.trim(text) != "", F.lit(False)) & text.try_cast(field.dataType).isNull()


def cast_with_rejects(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast an all-string frame to ``schema`` leniently.

    Returns the typed frame (bad values null, rows kept) and a one-row frame
    counting, per column, the non-empty values that failed to cast.
    """
    typed_cols, rejects = [], []
    for f in schema.fields:
        src = column(f.name)
        cast = src if isinstance(f.dataType, T.StringType) else src.try_cast(f.dataType)
        typed_cols.append(cast.alias(f.name))
        rejects.append(F.count_if(src.isNotNull() & (F.trim(src) != "") & cast.isNull()).alias(f.name))
    others = [column(c) for c in raw.columns if c not in schema.fieldNames()]
    counts = raw.agg(*rejects) if rejects else raw.sparkSession.range(1).drop("id")
    return raw.select(*typed_cols, *others), counts


def read_partitioned(spark: SparkSession, path: str, text_columns: Sequence[str] = ("grupo_mescla",)) -> DataFrame:
    """Read a ``partitionBy`` output keeping the given partition columns as
    text: partition-value type inference would turn a group such as ``043``
    into the integer 43 (and ``2024`` into an int)."""
    inferred = spark.read.parquet(path).schema
    fields = [
        T.StructField(f.name, T.StringType(), True) if f.name in text_columns else f for f in inferred.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)
