"""Incremental ingest of whatever lands: CSV, workbooks, archives, Parquet.

A stream of file names (``binaryFile``, no content read) decides what is new;
each micro-batch runs the batch ingest on its files (archives expanded, one
scan a schema class, errors as tables) into a folder named by the batch's
number, then commits it with one row.  A batch that is replayed after a
failure writes the same folder and the same row again, so it adds nothing;
rows of a batch without its row are not read.  ``trigger(availableNow=True)``
takes what has landed, then stops.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fiscalflow.operators.union import relaxed_union
from fiscalflow.plans.ingest import NothingReadError, ingest
from fiscalflow.session import checkpoint_root
from fiscalflow.sources import manifest as M
from fiscalflow.sources.sinks import write_parquet

_COMMITS = "lote long, arquivos long, linhas long, pastas array<string>"


@dataclass
class LandingRun:
    batches: list[int]
    rows_written: int
    output: str


def _committed(spark: SparkSession, output: str) -> DataFrame:
    try:
        return spark.read.schema(f"{_COMMITS}, n long").parquet(f"{output}/commits").drop("n")
    except AnalysisException:  # before the first batch
        return spark.createDataFrame([], _COMMITS)


def run_landing(spark: SparkSession, source_dir: str, output: str, checkpoint: str | None = None, max_files_per_trigger: int | None = None, **options) -> LandingRun:
    """Ingest every file under ``source_dir`` not seen before; ``options`` are those of ``ingest``."""
    output = output.rstrip("/")
    if checkpoint is None:
        digest = hashlib.sha1(f"{source_dir}|{output}".encode()).hexdigest()[:16]
        checkpoint = f"{checkpoint_root(spark).rstrip('/')}/landing-{digest}"
    done: list[int] = []

    def batch(found: DataFrame, number: int) -> None:
        paths = sorted(r.path for r in found.select("path").collect())  # a batch's names, for the reader call
        if not paths:
            return
        folder = f"{output}/lotes/lote={number}"
        try:
            result = ingest(spark, paths, folder, root=source_dir, merge=False, **options)
        except NothingReadError:
            result = None
        folders, rows = [], 0
        for k, frame in enumerate(result.frames if result else []):
            folders.append(write_parquet(frame, f"{folder}/classe_{k}"))
            rows += spark.read.parquet(folders[-1]).count()
        errors = result.errors if result else spark.createDataFrame([(p, "nenhum arquivo do lote foi lido") for p in paths], M.ERROR_SCHEMA)
        write_parquet(errors, f"{folder}/erros")
        commit = spark.createDataFrame([(number, len(paths), rows, folders)], _COMMITS)
        commit.coalesce(1).write.mode("overwrite").parquet(f"{output}/commits/n={number}")  # one file, so there or not there
        done.append(number)

    stream = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    names = stream.schema("path string, modificationTime timestamp, length long, content binary").load(source_dir).select("path")
    names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = _committed(spark, output).where(F.col("lote").isin(done)).agg(F.sum("linhas")).first()[0] if done else 0
    return LandingRun(done, int(rows or 0), output)


def read_landing(spark: SparkSession, output: str) -> DataFrame | None:
    """The rows of all committed batches, with their lineage and ``lote``; None before the first."""
    frames = []
    for r in _committed(spark, output.rstrip("/")).orderBy("lote").collect():  # a row a batch
        frames += [spark.read.parquet(f).withColumn("lote", F.lit(r.lote)) for f in r.pastas]
    return relaxed_union(frames) if frames else None


def read_landing_errors(spark: SparkSession, output: str) -> DataFrame | None:
    """(arquivo, erro, lote) of all committed batches."""
    frames = [spark.read.parquet(f"{output.rstrip('/')}/lotes/lote={r.lote}/erros").withColumn("lote", F.lit(r.lote)) for r in _committed(spark, output.rstrip("/")).collect()]
    return relaxed_union(frames) if frames else None
