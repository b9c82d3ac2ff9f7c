"""Merged output in versions: a rerun merges only the groups whose files changed.

Under the output folder:

* ``arquivos/v=N``   the files of version N: path, size, time, group and a
  fingerprint of the content;
* ``execucoes/v=N``  the groups that version N merged anew;
* ``versoes/v=N``    a row a group: the folder that holds its rows.  It is
  one file, written last: a version is there when this file is, and a run that
  dies before leaves the version before as it was.

A file whose size and time are those of the last version keeps its
fingerprint; others are read, by ranges, for theirs, so a file that was only
touched changes nothing.  Listings are compared as tables; only the paths of
the groups to be merged come to the driver, for the reader calls.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fiscalflow.operators.merge import GROUP
from fiscalflow.operators.union import relaxed_union
from fiscalflow.plans.ingest import NothingReadError, classified_files, ingest
from fiscalflow.session import materialize
from fiscalflow.sources.csv_ranges import scan_lines
from fiscalflow.sources.files import read_partitioned


@dataclass
class Version:
    number: int
    #: Groups merged in this run; those of no file any more are in ``removed``.
    merged: list[str]
    removed: list[str]
    #: (arquivo, erro) of this run's files.
    errors: DataFrame | None = None


_PLACES = "grupo string, tabela string, desde int"
_FILES = "path string, tamanho long, modificado timestamp, grupo string, impressao string, opcoes string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # not there yet
        return spark.createDataFrame([], schema)


def latest(spark: SparkSession, out: str) -> int:
    """The last complete version, 0 before the first."""
    try:
        return int(spark.read.schema(f"{_PLACES}, v int").parquet(f"{out}/versoes").agg(F.max("v")).first()[0] or 0)
    except AnalysisException:
        return 0


#: Base of the polynomial of line hashes, modulo 2^64.
_BASE, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, impressao) of files read by ranges; ``file`` is ``scan_lines``' hash of the path.

    A polynomial of the hashes of a file's lines: those of its ranges are put
    together in order, so it does not depend on where a file is cut.
    """

    def of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        for b in batches:
            for file, block, line in zip(*(b[c].to_pylist() for c in ("file", "block", "value")), strict=True):
                own = found.setdefault((file, block), [0, 0])
                own[0] = (own[0] * _BASE + int.from_bytes(hashlib.blake2b(line, digest_size=8).digest())) & _WORD
                own[1] += 1
        yield pa.RecordBatch.from_pylist([{"file": f, "block": k, "sum": str(s), "lines": n} for (f, k), (s, n) in found.items()], pa.schema([("file", pa.int64()), ("block", pa.int64()), ("sum", pa.string()), ("lines", pa.int64())]))

    def of_file(table: pa.Table) -> pa.Table:
        total = lines = 0
        for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
            total = (total * pow(_BASE, r["lines"], 1 << 64) + int(r["sum"])) & _WORD
            lines += r["lines"]
        return pa.table({"file": table["file"].slice(0, 1), "impressao": [f"{lines}-{total:016x}"]})

    ranges = scan_lines(spark, paths).mapInArrow(of_range, "file long, block long, sum string, lines long")
    return ranges.groupBy("file").applyInArrow(of_file, "file long, impressao string")


def listed_files(spark: SparkSession, landing: str, before: DataFrame, options: str, group: str | None = None, recursive: bool = True) -> DataFrame:
    """The files of a landing folder with their fingerprints (``_FILES``)."""
    found = classified_files(spark, landing, group, recursive).where("NOT ignored")
    listing = found.select("path", F.col("length").alias("tamanho"), F.col("modified").alias("modificado"), F.col("group").alias("grupo"), "number")
    known = before.select(F.col("path").alias("_p"), F.col("tamanho").alias("_n"), F.col("modificado").alias("_t"), F.col("impressao").alias("_known"))
    listing = listing.join(known, (F.col("path") == F.col("_p")) & (F.col("tamanho") == F.col("_n")) & (F.col("modificado") == F.col("_t")), "left").drop("_p", "_n", "_t")
    listing = materialize(listing, spark, "versions-listing")
    unread = [r.path for r in listing.where("_known IS NULL AND tamanho > 0").select("path").collect()]  # for the reader call
    if unread:
        listing = listing.join(fingerprints(spark, unread), F.col("number") == F.col("file"), "left").drop("file")
    else:
        listing = listing.withColumn("impressao", F.lit(None).cast("string"))
    content = F.concat_ws("-", F.col("tamanho"), F.coalesce("impressao", F.lit("")))
    return listing.select("path", "tamanho", "modificado", "grupo", F.coalesce("_known", content).alias("impressao"), F.lit(options).alias("opcoes"))


def merge_changed(spark: SparkSession, landing: str, out: str, *, group: str | None = None, recursive: bool = True, **options) -> Version:
    """Bring the merged output under ``out`` up to the files now under ``landing``; a new version if anything changed.

    ``options`` are those of ``ingest``; with other ones than before every
    group is merged anew.
    """
    out = out.rstrip("/")
    number = latest(spark, out)
    digest = hashlib.sha1(json.dumps([group, recursive, sorted((k, str(v)) for k, v in options.items())]).encode()).hexdigest()
    before = _read(spark, f"{out}/arquivos/v={number}", _FILES)
    new = number + 1
    listed_files(spark, landing, before, digest, group, recursive).write.mode("overwrite").parquet(f"{out}/arquivos/v={new}")
    now = _read(spark, f"{out}/arquivos/v={new}", _FILES)

    old = before.select(*[F.col(c).alias(f"_{c}") for c in ("path", "grupo", "impressao", "opcoes")])
    both = now.join(old, F.col("path") == F.col("_path"), "full_outer")
    same = F.col("path").isNotNull() & F.col("_path").isNotNull() & (F.col("impressao") == F.col("_impressao")) & (F.col("opcoes") == F.col("_opcoes")) & F.col("grupo").eqNullSafe(F.col("_grupo"))
    touched = both.where(~F.coalesce(same, F.lit(False))).select(F.explode(F.array("grupo", "_grupo")).alias("g")).where("g IS NOT NULL").distinct()
    touched = materialize(touched, spark, "versions-touched")
    names = sorted(r.g for r in touched.collect())  # groups, not files
    if not names:
        return Version(number, [], [])
    paths = [r.path for r in now.join(touched, F.col("grupo") == F.col("g"), "left_semi").select("path").collect()]
    places = _read(spark, f"{out}/versoes/v={number}", _PLACES).where(~F.col("grupo").isin(names))
    merged: dict[str, str] = {}
    errors = None
    if paths:
        try:
            result = ingest(spark, sorted(paths), f"{out}/execucoes/v={new}", root=landing, group=group, **options)
            merged = {g: folder.rsplit("/", 1)[0] for g, folder in result.merge.outputs.items()}
            errors = result.errors
        except NothingReadError:  # none of these files can be read: their groups have no rows
            merged = {}
    fresh = spark.createDataFrame([(g, t, new) for g, t in merged.items()], _PLACES)
    places.unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(f"{out}/versoes/v={new}")  # a row a group; one file, so there or not there
    return Version(new, sorted(merged), sorted(set(names) - set(merged)), errors)


def read_version(spark: SparkSession, out: str, number: int | None = None) -> DataFrame:
    """The merged rows of a version (default: the last), with ``desde``: the version that merged their group."""
    out = out.rstrip("/")
    number = latest(spark, out) if number is None else number
    places = spark.read.schema(_PLACES).parquet(f"{out}/versoes/v={number}").groupBy("tabela", "desde").agg(F.collect_list("grupo").alias("grupos")).collect()  # a row a written table
    if not places:
        raise ValueError(f"version {number} has no groups")
    return relaxed_union([read_partitioned(spark, r.tabela, (GROUP,)).where(F.col(GROUP).isin(r.grupos)).withColumn("desde", F.lit(r.desde)) for r in sorted(places, key=lambda r: r.tabela)])
