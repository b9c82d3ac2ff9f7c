"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.session import ensure_checkpoint_dir, materialize, scratch_path, ship_package

__all__ = ["BROADCAST_ROWS", "anti_join", "arrow_rows", "binary_column", "discard", "documents", "held_out", "materialize", "mix64", "released", "scratch_path", "semi_join", "text_rows"]

#: Arrow batches of at most this many documents bound a Python worker's memory (texts of 100 kB: 25 MB a batch).
ARROW_ROWS = 256
#: Rows that a task reads from Parquet at a time.
READER_ROWS = 512
#: A side of a join is broadcast when it has at most this many rows of one id (8 bytes each: 16 MB); else both sides are shuffled.
BROADCAST_ROWS = 2_000_000


def arrow_rows(spark: SparkSession, n: int = ARROW_ROWS) -> None:
    """Bound the documents per Arrow batch, and per batch that the JVM reads from Parquet (4096 by default: several copies of 12 MB and more of
    texts a task, for which an executor's heap grows and stays); make sure that a shared checkpoint folder is known and that workers can import this package."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))


def discard(*tables: DataFrame) -> None:
    """Remove written tables (``materialize``) that nothing reads any more, on whatever store they are."""
    for table in tables:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text as UTF-8 bytes): null texts are empty, other columns are left out, so their names cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def held_out(doc_id: Column) -> Column:
    """True for a quarter of the ids; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def semi_join(rows: DataFrame, ids: DataFrame, key: str = "doc_id", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is in ids (null matches null), each row once.

    ids is a written table: its row count is read from metadata, and it is
    broadcast up to ``limit`` rows; beyond that Spark shuffles both sides.
    """
    small = ids.select(F.col(key).alias("_wanted"))
    if ids.count() <= limit:
        small = F.broadcast(small)
    return rows.join(small, rows[key].eqNullSafe(F.col("_wanted")), "left_semi")


def anti_join(rows: DataFrame, dropped: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is not in the one column of ``dropped``, a written table; broadcast as in ``semi_join``."""
    name = dropped.columns[0]
    side = F.broadcast(dropped) if dropped.count() <= limit else dropped
    return rows.join(side, rows[key] == side[name], "left_anti")


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a fixed bijection of unsigned 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def released() -> None:
    """Give freed memory back to the system at the end of a task: workers are used again, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)
