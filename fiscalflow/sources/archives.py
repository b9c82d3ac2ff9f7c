"""Zip archives: recursive expansion inside tasks, entries landed as files.

Two light passes a nesting level.  The first reads the central directories
(one row per entry, no entry bytes); names are classified by the Column
rules.  The second spreads the (archive, entry) rows over tasks, and each
task opens the archive by path with random access and streams its entries
out in chunks, so one large archive is worked on by many tasks in bounded
memory.  Nested archives are landed and go through the same two passes, down
to ``max_depth``.  Landed entries come back as *paths*: their bytes never
travel inside Spark rows.

Per entry the output says what happened (``ok``, ``ignorado`` with the
reason, ``erro`` with the message), which feeds the error and ignored
tables.  Entry names are never used as paths (a ``../x.csv`` entry cannot
escape): landed files are named by a hash of the full origin chain, which
also keeps two archives with the same stem apart.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.functions.names import file_suffix, group_from_name, ignore_by_name
from fiscalflow.session import materialize

# Fixed values of the reference: chain separator and default depth limit.
CHAIN_SEP = "::"
MAX_DEPTH = 20
TABULAR = (".csv", ".xlsx", ".xls", ".ods")

ENTRY_SCHEMA = (
    "arquivo_zip string, arquivo_origem string, entrada string, nome_arquivo string, profundidade int, "
    "grupo_mescla_padrao string, status string, motivo string, caminho_local string"
)


def _local(path: str) -> str | None:
    from fiscalflow.sources.dialect import local_or_fs

    fs, inner = local_or_fs(path)
    return inner if fs is None else None


def open_input(path: str):
    """Random-access binary handle on local or shared storage, from a task."""
    from fiscalflow.sources.dialect import local_or_fs

    fs, inner = local_or_fs(path)
    return open(inner, "rb") if fs is None else fs.open_input_file(inner)


def write_stream(path: str, src, chunk: int = 8 << 20) -> None:
    """Copy a readable stream to ``path`` in chunks (bounded memory).

    Local files are written under a temporary name of their own and renamed,
    so a retried task rewrites the same name atomically; object stores commit on close.
    """
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        tmp = f"{local}.tmp-{uuid.uuid4().hex}"
        with open(tmp, "wb") as fh:
            shutil.copyfileobj(src, fh, chunk)
        os.replace(tmp, local)
        return
    from fiscalflow.sources.dialect import local_or_fs

    fs, inner = local_or_fs(path)
    with fs.open_output_stream(inner) as fh:
        shutil.copyfileobj(src, fh, chunk)


_LISTED = "archive string, outer string, chain string, depth int, entry string, error string"


def _list_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per entry of each archive, or one error row for an archive that cannot be read."""
    for pdf in batches:
        for archive, outer, chain, depth in zip(pdf["archive"], pdf["outer"], pdf["chain"], pdf["depth"], strict=True):
            entries, error = [], None
            try:
                with open_input(archive) as raw, zipfile.ZipFile(raw) as zf:
                    entries = [i.filename for i in zf.infolist() if not i.is_dir()]
            except Exception as e:  # noqa: BLE001 - corrupt archive: one error row
                entries, error = [None], f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"archive": archive, "outer": outer, "chain": chain, "depth": depth, "entry": entries, "error": error}).astype({"depth": "int32"})


def _extract_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream each entry to its target; rows of one archive that stand together share one open handle."""
    for pdf in batches:
        errors = []
        for _, group in pdf.groupby((pdf["archive"] != pdf["archive"].shift()).cumsum(), sort=False):
            errors += _extract(group["archive"].iloc[0], group["entry"], group["target"])
        yield pdf.assign(error=pd.Series(errors, index=pdf.index, dtype="object"))


def _extract(archive: str, entries, targets) -> list[str | None]:
    out: list[str | None] = []
    try:
        with open_input(archive) as raw, zipfile.ZipFile(raw) as zf:
            for entry, target in zip(entries, targets, strict=True):
                try:
                    with zf.open(entry) as src:  # CRC is checked as the stream ends
                        write_stream(target, src)
                    out.append(None)
                except Exception as e:  # noqa: BLE001 - a bad entry is recorded, the rest goes on
                    out.append(f"{type(e).__name__}: {e}")
    except Exception as e:  # noqa: BLE001 - the archive went away between the passes
        out += [f"{type(e).__name__}: {e}"] * (len(entries) - len(out))
    return out


def zip_entries(
    archives: DataFrame, land_dir: str, max_depth: int = MAX_DEPTH, group: str | None = None, entries_per_task: int = 16
) -> DataFrame:
    """``archives`` has a ``path`` column (e.g. a ``binaryFile`` listing with
    only ``path`` selected: no bytes are read by Spark).

    One row per entry (``ENTRY_SCHEMA``).  A nested entry keeps the group of
    the outermost archive.
    """
    from fiscalflow.sources.sheets import one_file_per_task

    spark = archives.sparkSession
    root = land_dir.rstrip("/")
    paths = one_file_per_task(archives)
    level = paths.select(F.col("path").alias("archive"), F.col("path").alias("outer"), F.regexp_extract("path", r"([^/]*)$", 1).alias("chain"), F.lit(0).alias("depth"))
    done: list[DataFrame] = []
    for depth in range(max_depth + 1):
        listed = level.mapInPandas(_list_batches, _LISTED)
        name = F.regexp_extract("entry", r"([^/]*)$", 1)
        ext = file_suffix(name)
        safe = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}._-]", "_"), r"^\.+", "")
        key = F.substring(F.sha1(F.concat_ws(CHAIN_SEP, "outer", "origin")), 1, 20)
        kinds = (
            F.when(F.col("error").isNotNull(), "erro")
            .when(ignore_by_name(name), "dicionario")
            .when(ext == ".zip", "zip")
            .when(ext.isin(*TABULAR), "tabular")
            .otherwise("outro")
        )
        listed = listed.withColumn("origin", F.when(F.col("entry").isNull(), F.col("chain")).otherwise(F.concat_ws(CHAIN_SEP, "chain", "entry")))
        listed = listed.select("*", kinds.alias("kind"), ext.alias("ext"), key.alias("key"), safe.alias("safe"))
        target = F.when(F.col("kind") == "zip", F.concat(F.lit(f"{root}/_aninhados/"), "key", F.lit(".zip"))).otherwise(
            F.concat(F.lit(f"{root}/"), "key", F.lit("/"), F.when(F.col("safe") == "", F.lit("entrada")).otherwise(F.col("safe")))
        )
        listed = materialize(listed.withColumn("target", target), spark, "zip-listed")
        wanted = listed.where(F.col("kind").isin("zip", "tabular") & ((F.col("kind") != "zip") | F.lit(depth < max_depth)))
        parts = max(1, -(-wanted.count() // entries_per_task))
        schema = listed.schema
        extracted = wanted.repartition(parts, "archive", "entry").sortWithinPartitions("archive").mapInPandas(_extract_batches, schema)
        extracted = materialize(extracted, spark, "zip-extracted")
        nested = extracted.where("kind = 'zip' AND error IS NULL")
        done += [
            listed.where(~F.col("kind").isin("zip", "tabular")),
            extracted.where("kind = 'tabular' OR error IS NOT NULL"),
        ]
        if depth == max_depth:
            done.append(listed.where("kind = 'zip'").withColumn("error", F.lit(f"ValueError: maximum archive depth {max_depth} exceeded")))
        if depth == max_depth or not nested.take(1):
            break
        level = nested.select(F.col("target").alias("archive"), "outer", F.col("origin").alias("chain"), F.lit(depth + 1).alias("depth"))
    found = reduce(DataFrame.unionByName, done)
    why = (
        F.when(F.col("kind") == "dicionario", F.lit("dicionario de dados"))
        .when(F.col("kind") == "outro", F.concat(F.lit("extensao nao suportada: "), F.when(F.col("ext") == "", "(nenhuma)").otherwise(F.col("ext"))))
        .otherwise(F.col("error"))
    )
    status = F.when(F.col("kind").isin("dicionario", "outro"), "ignorado").when(F.col("error").isNotNull() | (F.col("kind") == "erro"), "erro").otherwise("ok")
    file_name = F.regexp_extract(F.coalesce("entry", "chain"), r"([^/]*)$", 1)
    return found.select(
        F.col("outer").alias("arquivo_zip"), F.col("origin").alias("arquivo_origem"), F.col("entry").alias("entrada"), file_name.alias("nome_arquivo"), F.col("depth").alias("profundidade"),
        group_from_name(F.regexp_extract("outer", r"([^/]*)$", 1), group).alias("grupo_mescla_padrao"), status.alias("status"), why.alias("motivo"), F.when(status == "ok", F.col("target")).alias("caminho_local"),
    )
