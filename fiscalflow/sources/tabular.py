"""Tabular files of any kind: CSV by dialect class, workbooks by header, Parquet by footer; conversion to CSV or Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.session import materialize
from fiscalflow.sources.csv_ranges import Quotes, csv_names, decoded, read_csv_by_ranges, records
from fiscalflow.sources.dialect import detect_dialects
from fiscalflow.sources.files import REJECTED, literal_path, parquet_schema_classes, read_csv
from fiscalflow.sources.paths import norm_path, plain_path
from fiscalflow.sources.sheets import PATH, ROW, WORKBOOKS, promote_header, spreadsheet_rows
from fiscalflow.sources.sinks import write_csv, write_parquet


def dialect_classes(spark: SparkSession, dialects: Sequence[Row]) -> dict[tuple, list[str]]:
    """Paths by (encoding, separator, column names, whether records have line breaks), for files with a header."""
    classes: dict[tuple, list[str]] = {}
    for d in dialects:
        header = d.header
        if d.multilinha and Quotes(d.sep).after(header.encode(d.encoding), False):  # the header goes on in the next line
            header = records(spark, [d.path], d.sep).where("record = 0").select(decoded(F.col("raw"), d.encoding)).first()[0]
        classes.setdefault((d.encoding, d.sep, tuple(csv_names(header, d.sep)), bool(d.multilinha)), []).append(d.path)
    return classes


def read_dialect_class(spark: SparkSession, paths: Sequence[str], encoding: str, sep: str, names: Sequence[str], multi: bool) -> tuple[DataFrame, Column]:
    """(rows as text, with ``REJECTED``; their file's plain path) of one class: by ranges where records have line breaks, else by Spark's scan."""
    if multi:
        return read_csv_by_ranges(spark, paths, names, sep=sep, encoding=encoding), F.col(PATH)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv(spark, paths, sep=sep, encoding=encoding, schema=schema, rejects=True), plain_path(F.col("_metadata.file_path"))


def suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    dot = name.rfind(".")
    return name[dot:].lower() if 0 < dot < len(name) - 1 else ""


def read_tabular(spark: SparkSession, paths: Sequence[str]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """(frames, faults) of CSV, workbook and Parquet files.

    A frame a schema class, all text (Parquet: typed), with a column
    ``sheets.PATH`` naming the source file; a fault (path, why) a file that
    is empty, damaged or of another kind.  One bad file stops no other.
    """
    out: list[DataFrame] = []
    faults = [(p, f"sem leitor para {suffix(p) or '(sem extensao)'}") for p in paths if suffix(p) not in (".csv", ".parquet", *WORKBOOKS)]
    csvs = [p for p in paths if suffix(p) == ".csv"]
    if csvs:
        dia = detect_dialects(spark.createDataFrame([(p,) for p in csvs], "path string")).collect()
        faults += [(d.path, d.erro or "arquivo vazio") for d in dia if d.erro or not d.header]
        for (enc, sep, names, multi), ps in dialect_classes(spark, [d for d in dia if not d.erro and d.header]).items():
            df, plain = read_dialect_class(spark, ps, enc, sep, names, multi)
            out.append(df.withColumn(PATH, plain).drop(ROW, REJECTED))
    sheets = [p for p in paths if suffix(p) in WORKBOOKS]
    if sheets:
        cells = materialize(spreadsheet_rows(spark.createDataFrame([(p,) for p in sheets], "path string")), spark, "cells")
        faults += [tuple(r) for r in cells.where("erro IS NOT NULL").select("path", "erro").collect()]  # a row a bad workbook
        full = {r.path for r in cells.select("path").distinct().collect()}
        faults += [(p, "planilha vazia") for p in sheets if p not in full]
        out += [df.drop(ROW) for _names, df in promote_header(cells)]
    classes, bad = parquet_schema_classes(spark, [p for p in paths if suffix(p) == ".parquet"])
    faults += bad
    out += [spark.read.parquet(*map(literal_path, ps)).withColumn(PATH, plain_path(F.col("_metadata.file_path"))) for ps in classes]
    return out, [(norm_path(p), why) for p, why in faults]


@dataclass
class Converted:
    """Folders written, one a schema class, and the files that could not be read: (arquivo, erro)."""

    folders: list[str] = field(default_factory=list)
    errors: DataFrame | None = None


def convert_tabular(spark: SparkSession, paths: Sequence[str], out: str, fmt: str = "csv") -> Converted:
    """Convert tabular files to CSV (UTF-8, header) or Parquet, one output folder per schema class (``out/parte_<i>``)."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    frames, faults = read_tabular(spark, paths)
    folders = []
    for i, df in enumerate(frames):
        target = f"{out.rstrip('/')}/parte_{i}"
        (write_csv if fmt == "csv" else write_parquet)(df.drop(PATH), target)
        folders.append(target)
    return Converted(folders, spark.createDataFrame(faults, "arquivo string, erro string"))
