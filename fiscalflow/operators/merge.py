"""Lineage tags and merge by group (one merged output per group).

Lineage is a column expression, not a per-file literal: the source file
comes from the scan's hidden ``_metadata.file_name`` (or from a Hive-style
partition column when the landing data were written by Spark), and the
group is computed from that name by the name rule.  A source is read once
per distinct schema, however many files it holds, so the plan width is the
number of schema classes, not the number of files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.functions._util import column
from fiscalflow.functions.names import group_from_name, ignore_by_name
from fiscalflow.operators.extract import apply_filters, apply_where, normalize_columns
from fiscalflow.operators.union import relaxed_union

ORIGIN = "arquivo_origem"
GROUP = "grupo_mescla"


def with_lineage(
    df: DataFrame, name_col: str | None = None, group: str | None = None, drop_name_col: bool = True
) -> DataFrame:
    """Add ``arquivo_origem`` (source file name) and ``grupo_mescla``.

    ``name_col`` defaults to the scan's ``_metadata.file_name``; a caller
    ``group`` overrides the rule for every row.  Both tags are a projection
    of the scan: no row moves.  Lineage columns that the data already have
    (an earlier merged output) are replaced.
    """
    name = F.col("_metadata.file_name") if name_col is None else F.col(name_col)
    keep = [c for c in df.columns if c.lower() not in (ORIGIN, GROUP) or c == name_col]
    if drop_name_col and name_col is not None:
        keep = [c for c in keep if c != name_col]
    origin = name.cast("string")
    return df.select(*[column(c) for c in keep if c.lower() not in (ORIGIN, GROUP)], origin.alias(ORIGIN), group_from_name(origin, group).alias(GROUP))


def ignored_origin() -> Column:
    """Whether the file that ``arquivo_origem`` names (by name, path or chain of archives) is left out."""
    return ignore_by_name(F.regexp_extract(ORIGIN, r"([^/:]*)$", 1))


def select_for_merge(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Requested columns plus the two lineage columns, de-duplicated in order."""
    cols = normalize_columns(columns)
    if cols is None:
        return df
    wanted = [c for c in dict.fromkeys([*cols, ORIGIN, GROUP]) if c != ORIGIN or ORIGIN in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")
    return df.select(*[column(c) for c in wanted])


@dataclass
class MergeResult:
    """Outputs of :func:`merge_by_group` (all DataFrames are lazy)."""

    outputs: dict[str, str] = field(default_factory=dict)  # group -> folder holding its rows
    tables: list[str] = field(default_factory=list)  # one written table per schema class of groups
    files: DataFrame | None = None  # (arquivo_origem, grupo_mescla, ignorado)
    unified: DataFrame | None = None

    def group(self, spark: SparkSession, name: str) -> DataFrame:
        """The merged rows of one group, with its lineage columns."""
        from fiscalflow.sources.files import read_partitioned

        path = self.outputs[name]
        base = path.rsplit("/", 1)[0]
        return read_partitioned(spark, base, (GROUP,)).filter(F.col(GROUP) == name)


def merge_by_group(
    spark: SparkSession,
    sources: Sequence[DataFrame],
    out_dir: str,
    *,
    columns: Sequence[str] | None = None,
    filters: Column | Sequence[Column] | None = None,
    where: str | None = None,
    merge_single: bool = True,
    file_groups: Sequence[Sequence[tuple[str, str]]] | None = None,
) -> MergeResult:
    """Merge tagged sources into one output per group.

    ``sources`` are scans already carrying ``arquivo_origem`` and
    ``grupo_mescla`` (see :func:`with_lineage`), one per schema class.
    Ignored names (data dictionaries) are left out; filters, predicate and
    columns apply before the union so they reach each scan.

    Groups fed by the same set of sources share one schema, so they are
    written together by one job, ``partitionBy(grupo_mescla)``: one folder
    per group, as many jobs as distinct source sets (not one per group).
    The only data brought to the driver is the distinct (source, group)
    list, whose size is the number of files; a caller that already knows it
    (one ``(origin, group)`` list per source) passes ``file_groups`` and no
    scan is spent on it.  ``merge_single=False`` keeps the v1.0 rule: when
    there is a single file in all, nothing is written and its tagged rows are
    the result; otherwise every group is merged.
    """
    if not sources:
        raise ValueError("no sources to merge")
    prepared = []
    for src in sources:
        kept = src.filter(~ignored_origin()) if ORIGIN in src.columns else src
        prepared.append(select_for_merge(apply_where(apply_filters(kept, filters), where), columns))

    # Without an origin column (metadata columns not kept) files are counted by group.
    file_lists = [
        (s.select(ORIGIN, GROUP) if ORIGIN in s.columns else s.select(F.col(GROUP).alias(ORIGIN), GROUP)).distinct()
        for s in sources
    ]
    files = relaxed_union(file_lists).withColumn("ignorado", ignored_origin())
    members: dict[str, set[int]] = {}
    n_files: dict[str, int] = {}
    if file_groups is None:
        # One row per (source, group) with its file count: small, whatever
        # the number of files.
        tagged = [fl.withColumn("__src", F.lit(i)) for i, fl in enumerate(file_lists)]
        summary = (
            relaxed_union(tagged)
            .filter(~ignored_origin())
            .groupBy("__src", GROUP)
            .agg(F.count_distinct(ORIGIN).alias("__files"))
            .collect()
        )
        for r in summary:
            members.setdefault(r[GROUP], set()).add(r["__src"])
            n_files[r[GROUP]] = n_files.get(r[GROUP], 0) + r["__files"]
    else:
        for idx, pairs in enumerate(file_groups):  # one pair a file, whatever its name
            for _origin, g in pairs:
                members.setdefault(g, set()).add(idx)
                n_files[g] = n_files.get(g, 0) + 1
    if not members:
        raise ValueError("no file could be merged: every source is empty or ignored")

    if not merge_single and sum(n_files.values()) == 1:
        return MergeResult(files=files, unified=relaxed_union(prepared))
    buckets: dict[frozenset[int], list[str]] = {}
    for g in sorted(members):
        buckets.setdefault(frozenset(members[g]), []).append(g)

    result = MergeResult(files=files)
    written = []
    root = out_dir.rstrip("/")
    for i, (srcs, groups) in enumerate(sorted(buckets.items(), key=lambda kv: kv[1][0])):
        parts = [prepared[j].filter(F.col(GROUP).isin(*groups)) for j in sorted(srcs)]
        path = f"{root}/mescla_{i}"
        merged = relaxed_union(parts)
        # Rows of a group stand together, a hot group is split over tasks: few files a group, no task x group files.
        merged.hint("rebalance", GROUP).write.mode("overwrite").partitionBy(GROUP).parquet(path)
        result.tables.append(path)
        for g in groups:
            result.outputs[g] = f"{path}/{GROUP}={_escape(g)}"
        # Read back with the written schema: partition values stay text
        # (no type inference turning a group such as ``043`` into 43).
        written.append(spark.read.schema(merged.schema).parquet(path))
    result.unified = relaxed_union(written) if written else None
    return result


def _escape(value: str) -> str:
    """Hive partition-path escaping of a value (as Spark writes it)."""
    special = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(0x20)}
    return "".join(f"%{ord(ch):02X}" if ch in special else ch for ch in value)
