"""End-to-end ingest of a landing folder, and merge from an existing manifest.

The reference downloads, unzips, converts and merges one file after
another.  Here the files are already landed (network download is not part
of the library), and the work is a handful of Spark jobs whatever the file
count:

1. list the folder (``binaryFile`` with only ``path`` selected: no bytes
   read) and classify each file by name and suffix;
2. expand archives in tasks (entries landed as files, see
   ``sources.archives``);
3. find CSV dialects by ranges of the files (``sources.dialect``);
4. read each *class* of files (same dialect and header, same workbook
   header, same Parquet schema) with one scan, CSV with line breaks between
   quotes by ranges (``sources.csv_ranges``);
5. tag rows with their origin and group by joining the scan's
   ``_metadata.file_path`` to the manifest (one row per file);
6. apply filters, SQL predicate and columns per class (a class that lacks
   a requested column becomes error rows for its files);
7. merge by group (``operators.merge``).

Only per-file metadata (paths, dialects, headers, schemas) is collected on
the driver; row data never is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fiscalflow.functions._util import column
from fiscalflow.functions.names import file_suffix, group_from_name, ignore_by_name
from fiscalflow.operators.extract import apply_filters, apply_where, normalize_columns
from fiscalflow.operators.merge import GROUP, ORIGIN, MergeResult, merge_by_group
from fiscalflow.session import materialize, scratch_path
from fiscalflow.sources import manifest as M
from fiscalflow.sources.archives import MAX_DEPTH, zip_entries
from fiscalflow.sources.csv_options import EMPTY
from fiscalflow.sources.csv_ranges import RECORD, read_csv_by_ranges
from fiscalflow.sources.dialect import detect_dialects
from fiscalflow.sources.files import REJECTED, bad_value, cast_with_rejects, literal_path, parquet_schema_classes
from fiscalflow.sources.paths import norm_path, plain_path
from fiscalflow.sources.sheets import PATH, ROW, WORKBOOKS, promote_header, spreadsheet_rows
from fiscalflow.sources.tabular import dialect_classes, read_dialect_class

MERGEABLE = {".csv", ".parquet", *WORKBOOKS}
READABLE = {*MERGEABLE, ".zip"}
#: Files of one scan whose names are sent to every task (about 300 bytes each: 30 MB).
TAGS_SENT = 100_000


class NothingReadError(ValueError):
    """No file could be read; the message names the first errors."""


@dataclass
class IngestResult:
    manifest: DataFrame
    errors: DataFrame
    ignored: DataFrame
    frames: list[DataFrame] = field(default_factory=list)
    merge: MergeResult | None = None
    out_dir: str = ""
    #: (arquivo, linhas): rows with too many or too few fields, or values of the wrong type, by file.
    rejects: DataFrame | None = None
    include_metadata: bool = True
    #: One function a schema class: its rejected rows, see ``rejected_rows``.
    reject_readers: list[Callable[[], DataFrame]] = field(default_factory=list)

    def rejected_rows(self) -> DataFrame | None:
        """(arquivo, registro, linha, coluna, motivo): each fault of each rejected row of CSV files and workbooks.

        ``registro`` counts the rows of its file after the header, ``linha``
        is the row as it stands in the file (cells as JSON for workbooks),
        ``coluna`` is null where the number of values is wrong.  The files are
        read again, by ranges, only when this is called.
        """
        found = [read() for read in self.reject_readers]
        return reduce(DataFrame.unionByName, found) if found else None

    @property
    def files_read(self) -> DataFrame:
        """Origins of the files that were read (those with an error row are not)."""
        failed = self.errors.select(F.col("arquivo").alias("_failed"))  # origins tell files apart, see ``shown_names``
        read = self.manifest.select("arquivo_origem").distinct()
        return read.join(failed, F.col("arquivo_origem") == F.col("_failed"), "left_anti")

    @property
    def unified(self) -> DataFrame | None:
        out = self.merge.unified if self.merge else None
        return out.drop(ORIGIN, GROUP) if out is not None and not self.include_metadata else out


def classified_files(spark: SparkSession, landing: str | Sequence[str], group: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, name, suffix, ignored, group, length, modified, number) of the files under a folder, or of the paths given (content not read).

    ``number`` is the ``file`` of ``csv_ranges.scan_lines``.
    """
    paths = landing if isinstance(landing, str) else [literal_path(p) for p in landing]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(paths)
    named = listing.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified"), F.xxhash64("_metadata.file_path").alias("number"))
    return named.select("path", "name", file_suffix("name").alias("suffix"), ignore_by_name("name").alias("ignored"), group_from_name("name", group).alias("group"), "length", "modified", "number")


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> list[str]:
    """Paths under ``folder`` (content not read)."""
    return sorted(r.path for r in classified_files(spark, folder, None, recursive).select("path").collect())


def tag_rows(df: DataFrame, members: Sequence[dict], spark: SparkSession, plain: Column) -> DataFrame:
    """Join rows to their file's origin and group; lineage columns the data already have are replaced."""
    tags = spark.createDataFrame([(norm_path(r["caminho_local"]), r["arquivo_origem"], r["grupo"]) for r in members], "__path string, __origin string, __group string")
    if len(members) <= TAGS_SENT:  # no row moves; dealt by file, a large file's rows would go to one task
        tags = F.broadcast(tags)
    own = [c for c in df.columns if c.lower() not in (ORIGIN, GROUP)]
    tagged = df.select(*[column(c) for c in own], plain.alias("__file")).join(tags, F.col("__file") == F.col("__path"))
    return tagged.select(*[column(c) for c in own], F.col("__origin").alias(ORIGIN), F.col("__group").alias(GROUP))


def shown_names(files: Sequence[Row], root: str) -> dict[str, str]:
    """What each listed file is called in every table: its name, or its path under the landing folder where another file has that name."""
    times = Counter(f.name for f in files)
    plain = {f.path: norm_path(f.path) for f in files}
    return {f.path: f.name if times[f.name] == 1 else plain[f.path].removeprefix(f"{root}/") for f in files}


def row_faults(rows: DataFrame, names: Sequence[str], schema: T.StructType | None) -> DataFrame:
    """(PATH, registro, linha, coluna, motivo) of rows that have ``ROW``, ``RECORD`` and perhaps ``REJECTED``; a row a fault."""
    fault = lambda name, why: F.struct(F.lit(name).cast("string").alias("coluna"), F.lit(why).alias("motivo"))
    typed = [f for f in (schema.fields if schema is not None else []) if f.name in names]
    faults = [F.when(bad_value(f), fault(f.name, f"nao e {f.dataType.simpleString()}")) for f in typed]
    if REJECTED in rows.columns:
        faults.append(F.when(F.col(REJECTED).isNotNull(), fault(None, "numero de valores diferente do cabecalho")))
    if not faults:
        return rows.select(PATH, F.lit(0).cast("long").alias("registro"), F.lit("").alias("linha"), F.lit("").alias("coluna"), F.lit("").alias("motivo")).where("false")
    found = rows.select(PATH, F.col(ROW).cast("long").alias("registro"), F.col(RECORD).alias("linha"), F.explode(F.filter(F.array(*faults), lambda x: x.isNotNull())).alias("__f"))
    return found.select(PATH, "registro", "linha", "__f.coluna", "__f.motivo")


def _with_origin(faults: DataFrame, members: Sequence[dict], spark: SparkSession) -> DataFrame:
    tagged = tag_rows(faults, members, spark, F.regexp_replace(PATH, r"^file:/*", "/"))
    return tagged.select(F.col(ORIGIN).alias("arquivo"), "registro", "linha", "coluna", "motivo")


def csv_faults(spark: SparkSession, members: Sequence[dict], encoding: str, sep: str, names: Sequence[str], schema: T.StructType | None) -> DataFrame:
    rows = read_csv_by_ranges(spark, [m["caminho_local"] for m in members], names, sep=sep, encoding=encoding, record=True)
    return _with_origin(row_faults(rows, names, schema), members, spark)


def sheet_faults(spark: SparkSession, rows: DataFrame, members: Sequence[dict], names: Sequence[str], schema: T.StructType | None) -> DataFrame:
    return _with_origin(row_faults(rows.withColumn(RECORD, F.to_json(F.array(*[column(n) for n in names]))), names, schema), members, spark)


def ingest(
    spark: SparkSession,
    landing: str | Sequence[str],
    out: str | None = None,
    *,
    root: str | None = None,
    merge: bool = True,
    columns: Sequence[str] | None = None,
    filters: Column | Sequence[Column] | None = None,
    where: str | None = None,
    include_metadata: bool = True,
    max_zip_depth: int = MAX_DEPTH,
    group: str | None = None,
    recursive: bool = True,
    merge_single: bool = True,
    schema: T.StructType | str | None = None,
) -> IngestResult:
    """Ingest every readable file under ``landing`` (a folder, or the paths of files under ``root``) and merge by group.

    CSV and workbook columns named in ``schema`` are cast to its types before
    filters and predicate; a value that does not fit becomes null and its row
    is counted in ``rejects``, as are CSV rows with too many or too few fields.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = normalize_columns(columns)
    out = (out or scratch_path(spark, "ingest")).rstrip("/")
    root = norm_path((root or (landing if isinstance(landing, str) else "")).rstrip("/"))
    errors: list[tuple[str, str]] = []
    ignored: list[tuple[str, str]] = []
    entries: list[dict] = []  # manifest rows plus the reader suffix

    # 1. listing and classification (driver holds one path per file).
    zips = []
    listed = sorted(classified_files(spark, landing, group, recursive).collect(), key=lambda f: f.path)
    shown = shown_names(listed, root)
    for f in listed:
        plain, name, ext = norm_path(f.path), f.name, f.suffix
        if f.ignored:
            ignored.append((shown[f.path], "dicionario de dados"))
        elif ext not in READABLE:
            ignored.append((shown[f.path], f"extensao nao suportada: {ext or '(nenhuma)'}"))
        elif ext == ".zip":
            zips.append(f.path)
        else:
            rel = plain[len(root) + 1:] if plain.startswith(root + "/") else plain
            entries.append(
                {
                    "caminho_local": plain, "caminho_relativo": rel, "nome_arquivo": name, "origem_url": plain,
                    "arquivo_origem": shown[f.path], "grupo_mescla_padrao": group or "", "origem_tipo": M.KIND_TABULAR,
                    "ext": ext, "grupo": f.group,
                }
            )

    # 2. archives: expanded in tasks, tabular entries landed as files.
    if zips:
        land = f"{out}/_extraidos"
        ent = materialize(
            zip_entries(spark.createDataFrame([(z,) for z in zips], "path string"), land, max_zip_depth, group),
            spark,
            "zip-entries",
        )
        called = {norm_path(z): shown[z] for z in zips}
        for r in ent.withColumn("ext", file_suffix("nome_arquivo")).collect():  # one row per archive entry
            zip_path = norm_path(r.arquivo_zip)
            origin = called[zip_path] + r.arquivo_origem[len(zip_path.rsplit("/", 1)[-1]):]  # the chain, from the archive as it is shown
            if r.status == "ok":
                local = norm_path(r.caminho_local)
                entries.append(
                    {
                        "caminho_local": local, "caminho_relativo": local[len(norm_path(out)) + 1:],
                        "nome_arquivo": r.nome_arquivo, "origem_url": norm_path(r.arquivo_zip),
                        "arquivo_origem": origin, "grupo_mescla_padrao": r.grupo_mescla_padrao,
                        "origem_tipo": M.KIND_ZIP_ENTRY, "ext": r.ext,
                        "grupo": r.grupo_mescla_padrao,
                    }
                )
            elif r.status == "ignorado":
                ignored.append((origin, r.motivo))
            else:
                errors.append((origin, r.motivo))

    frames: list[DataFrame] = []
    frame_files: list[list[tuple[str, str]]] = []  # (origin, group) of each frame's files
    by_path = {e["caminho_local"]: e for e in entries}

    rejected: list[DataFrame] = []
    reject_readers: list[Callable[[], DataFrame]] = []

    def add_class(read: Callable[[], tuple[DataFrame, Column]], members: list[dict], text: bool = False) -> None:
        """One scan's rows, tagged and filtered; whatever fails in it becomes error rows of its files."""
        try:
            df, plain = read()
            if text and schema is not None:
                named = T.StructType([f for f in schema.fields if f.name in df.columns])
                bad = reduce(lambda a, b: a | b, [bad_value(f) for f in named.fields], F.lit(False))
                reject = F.when(bad, F.lit("")) if REJECTED not in df.columns else F.coalesce(F.col(REJECTED), F.when(bad, F.lit("")))
                df = cast_with_rejects(df.withColumn(REJECTED, reject), named)[0]
            tagged = tag_rows(df, members, spark, plain)
            if REJECTED in tagged.columns:
                # The parser judges a line by the columns asked for, so the count looks at all of them in passing.
                others = [column(c).cast("string") for c in df.columns if c.lower() not in (REJECTED, ORIGIN, GROUP, PATH, ROW)]
                line = F.when(F.concat_ws("", *others) != EMPTY, F.col(REJECTED))
                rejected.append(tagged.groupBy(F.col(ORIGIN).alias("arquivo")).agg(F.count(line).alias("linhas")).where("linhas > 0"))
                tagged = tagged.drop(REJECTED)
            kept = apply_where(apply_filters(tagged.drop(PATH, ROW), filters), where)
            if cols is not None:
                wanted = list(dict.fromkeys([*cols, ORIGIN, GROUP]))
                missing = [c for c in wanted if c not in kept.columns]
                if missing:
                    raise ValueError(f"colunas ausentes: {missing}; disponiveis: {kept.columns}")
                kept = kept.select(*[column(c) for c in wanted])
            frames.append(kept)
            frame_files.append([(m["arquivo_origem"], m["grupo"]) for m in members])
        except (ValueError, AnalysisException) as e:
            for m in members:
                errors.append((m["arquivo_origem"], f"{type(e).__name__}: {str(e).splitlines()[0]}"))

    # 3-4. CSV: dialect classes, one scan per class.
    csvs = [e for e in entries if e["ext"] == ".csv"]
    if csvs:
        dia = detect_dialects(spark.createDataFrame([(e["caminho_local"],) for e in csvs], "path string")).collect()
        for d in dia:
            if d.erro or not d.header:
                errors.append((by_path[d.path]["arquivo_origem"], d.erro or "arquivo vazio"))
        for (enc, sep, names, multi), paths in dialect_classes(spark, [d for d in dia if not d.erro and d.header]).items():
            add_class(partial(read_dialect_class, spark, paths, enc, sep, names, multi), [by_path[p] for p in paths], text=True)
            reject_readers.append(partial(csv_faults, spark, [by_path[p] for p in paths], enc, sep, names, schema))

    # Spreadsheets: parsed in tasks once (bronze cells), one frame per header.
    sheets = [e for e in entries if e["ext"] in WORKBOOKS]
    if sheets:
        cells = materialize(
            spreadsheet_rows(spark.createDataFrame([(s["caminho_local"],) for s in sheets], "path string"), len(sheets)),
            spark,
            "cells",
        )
        for r in cells.where("erro IS NOT NULL").select("path", "erro").collect():  # one row per bad workbook
            errors.append((by_path[norm_path(r.path)]["arquivo_origem"], r.erro))
        seen = {norm_path(r.path) for r in cells.select("path").distinct().collect()}
        for s in sheets:
            if s["caminho_local"] not in seen:
                errors.append((s["arquivo_origem"], "planilha vazia"))
        for names, df in promote_header(cells):
            paths = sorted({norm_path(r[PATH]) for r in df.select(PATH).distinct().collect()})
            members = [by_path[p] for p in paths if p in by_path]
            add_class(lambda df=df: (df, F.regexp_replace(PATH, r"^file:/*", "/")), members, text=True)
            reject_readers.append(partial(sheet_faults, spark, df, members, names, schema))

    # Parquet: one scan per distinct footer schema (footers read in tasks).
    parquets = [e for e in entries if e["ext"] == ".parquet"]
    classes, bad = parquet_schema_classes(spark, [e["caminho_local"] for e in parquets])
    for p, err in bad:
        errors.append((by_path[norm_path(p)]["arquivo_origem"], err))
    for paths in classes:
        members = [by_path[norm_path(p)] for p in paths]
        add_class(lambda paths=paths: (spark.read.parquet(*map(literal_path, paths)), plain_path(F.col("_metadata.file_path"))), members)

    manifest = M.normalize_manifest(
        spark.createDataFrame([tuple(e[f] for f in M.FIELDS) for e in entries], M.MANIFEST_SCHEMA)
    )
    M.write_manifest(manifest, f"{out}/manifesto")
    err_df = spark.createDataFrame(errors, M.ERROR_SCHEMA)
    ign_df = spark.createDataFrame(ignored, M.IGNORED_SCHEMA)
    rejects = reduce(DataFrame.union, rejected) if rejected else spark.createDataFrame([], "arquivo string, linhas long")
    result = IngestResult(manifest=manifest, errors=err_df, ignored=ign_df, frames=frames, out_dir=out, rejects=rejects, include_metadata=include_metadata, reject_readers=reject_readers)

    if not frames:
        sample = "; ".join(f"{a}: {e}" for a, e in errors[:5])
        raise NothingReadError("nenhum arquivo foi lido com sucesso" + (f"; primeiros erros: {sample}" if sample else ""))
    if merge:
        result.merge = merge_by_group(
            spark, frames, f"{out}/mesclas", merge_single=merge_single, file_groups=frame_files
        )
    return result


def merge_from_manifest(
    spark: SparkSession,
    manifest: DataFrame | str,
    out: str,
    *,
    columns: Sequence[str] | None = None,
    merge_single: bool = True,
) -> IngestResult:
    """Merge the files a manifest lists (Parquet, CSV, workbooks), by group.

    Missing files become error rows; an empty manifest, or one whose files
    are all missing, is an error.  Two rows on one path are two files with
    the same content.
    """
    man = M.read_manifest(spark, manifest) if isinstance(manifest, str) else M.normalize_manifest(manifest)
    local = F.regexp_replace(F.coalesce("caminho_local", F.lit("")), r"^file:/*", "/")
    name = F.coalesce("nome_arquivo", F.regexp_extract(local, r"([^/]*)$", 1))
    listed = man.select(
        local.alias("caminho_local"), name.alias("nome_arquivo"), F.coalesce("arquivo_origem", name).alias("arquivo_origem"),
        group_from_name(name, F.coalesce("grupo_mescla_padrao", F.lit(""))).alias("grupo"), ignore_by_name(name).alias("ignored"), file_suffix(local).alias("suffix"),
    )
    rows = [r.asDict() for r in listed.collect()]  # one row per file
    if not rows:
        raise ValueError("o manifesto esta vazio")
    existing: set[str] = set()
    for folder in sorted({r["caminho_local"].rsplit("/", 1)[0] for r in rows if r["caminho_local"]}):
        try:
            existing |= {norm_path(p) for p in list_files(spark, literal_path(folder), recursive=False)}
        except AnalysisException:
            pass  # folder gone: all its files are missing
    errors, ignored = [], []
    present: dict[str, list[dict]] = {}
    for r in rows:
        if r["ignored"]:
            ignored.append((r["nome_arquivo"], "dicionario de dados"))
        elif r["caminho_local"] not in existing:
            errors.append((r["arquivo_origem"], f"arquivo local nao encontrado: {r['caminho_local']}"))
        elif r["suffix"] not in MERGEABLE:
            errors.append((r["arquivo_origem"], f"sem leitor para {r['suffix'] or '(sem extensao)'}: {r['caminho_local']}"))
        else:
            present.setdefault(r["caminho_local"], []).append(r)
    cols = normalize_columns(columns)
    frames: list[DataFrame] = []
    known: list[list[tuple[str, str]]] = []

    def add(df: DataFrame, paths: Sequence[str], plain: Column) -> None:
        members = [m for p in paths for m in present[norm_path(p)]]
        df = tag_rows(df, members, spark, plain).drop(PATH, ROW, REJECTED)
        if cols is not None:
            wanted = list(dict.fromkeys([*cols, ORIGIN, GROUP]))
            missing = [c for c in wanted if c not in df.columns]
            if missing:
                errors.extend((m["arquivo_origem"], f"colunas ausentes: {missing}") for m in members)
                return
            df = df.select(*[column(c) for c in wanted])
        frames.append(df)
        known.append([(m["arquivo_origem"], m["grupo"]) for m in members])

    of = lambda *kinds: sorted(p for p, ms in present.items() if ms[0]["suffix"] in kinds)
    classes, bad = parquet_schema_classes(spark, of(".parquet"))
    errors.extend((m["arquivo_origem"], err) for p, err in bad for m in present[norm_path(p)])
    for paths in classes:
        add(spark.read.parquet(*map(literal_path, paths)), paths, plain_path(F.col("_metadata.file_path")))
    if of(".csv"):
        dia = detect_dialects(spark.createDataFrame([(p,) for p in of(".csv")], "path string")).collect()
        for d in dia:
            if d.erro or not d.header:
                errors.extend((m["arquivo_origem"], d.erro or "arquivo vazio") for m in present[d.path])
        for (enc, sep, names, multi), paths in dialect_classes(spark, [d for d in dia if not d.erro and d.header]).items():
            df, plain = read_dialect_class(spark, paths, enc, sep, names, multi)
            add(df, paths, plain)
    if of(*WORKBOOKS):
        cells = materialize(spreadsheet_rows(spark.createDataFrame([(p,) for p in of(*WORKBOOKS)], "path string")), spark, "cells")
        errors.extend((m["arquivo_origem"], r.erro) for r in cells.where("erro IS NOT NULL").collect() for m in present[r.path])
        for _names, df in promote_header(cells):
            add(df, sorted(r[PATH] for r in df.select(PATH).distinct().collect()), F.col(PATH))
    result = IngestResult(
        manifest=man,
        errors=spark.createDataFrame(errors, M.ERROR_SCHEMA),
        ignored=spark.createDataFrame(ignored, M.IGNORED_SCHEMA),
        frames=frames,
        out_dir=out,
    )
    if not frames:
        sample = "; ".join(f"{a}: {e}" for a, e in errors[:5])
        raise ValueError("nenhum arquivo do manifesto pode ser mesclado" + (f"; primeiros erros: {sample}" if sample else ""))
    result.merge = merge_by_group(spark, frames, out, merge_single=merge_single, file_groups=known)
    return result
