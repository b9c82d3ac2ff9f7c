"""Spreadsheets (``.xlsx``, ``.ods``, ``.xls``): first sheet as rows of text cells.

No spreadsheet library is installed.  The first two formats are zip files of
XML, the last is binary (``xls``).  Each workbook is opened by path inside a task (one workbook per
task: a workbook cannot be split) and its sheet XML is streamed with
``iterparse``, so memory stays bounded by the batch size, not the file.  The output is one
row per sheet row, ``(path, row_idx, cells array<string>, erro)``, and one row with only
path and erro for a workbook that cannot be read; the header row
is promoted to column names per header class by :func:`promote_header`,
with JVM-side projections.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.sources import xls

CELLS_SCHEMA = "path string, row_idx int, cells array<string>, erro string"
#: Helper columns of ``promote_header``; a header may use any other name.
PATH, ROW = "__caminho", "__linha"

_NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_NS_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_NS_TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
_NS_OFFICE = "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"
_NS_TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


#: Built-in number formats that show dates or times.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_TIME_OF_DAY = {18, 19, 20, 21, 45, 46, 47}


def _date_styles(zf: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Cell styles (by number) whose number format shows a date."""
    if "xl/styles.xml" not in names:
        return set()
    root = ET.fromstring(zf.read("xl/styles.xml"))
    own = {}
    for f in root.iter(f"{_NS_MAIN}numFmt"):
        shown = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode") or "")
        own[int(f.get("numFmtId"))] = bool(re.search(r"[yd]", shown, re.IGNORECASE))
    xfs = root.find(f"{_NS_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", "0")) for x in xfs] if xfs is not None else []
    return {i for i, n in enumerate(ids) if own.get(n, n in DAY_FORMATS)}


DAY_FORMATS = _DATE_FORMATS - _TIME_OF_DAY


def iso_date(serial: str | float, epoch: dt.datetime) -> str:
    """A day count as ``yyyy-mm-dd``, with the time of day where there is one."""
    when = epoch + dt.timedelta(seconds=round(float(serial) * 86_400))
    return when.date().isoformat() if when.time() == dt.time(0) else when.isoformat(sep=" ")


def _iter_xlsx(zf: zipfile.ZipFile) -> Iterator[list[str | None]]:
    names = set(zf.namelist())
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        with zf.open("xl/sharedStrings.xml") as fh:
            for _, el in ET.iterparse(fh):
                if el.tag == f"{_NS_MAIN}si":
                    shared.append("".join(t.text or "" for t in el.iter(f"{_NS_MAIN}t")))
                    el.clear()
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    first = next(wb.iter(f"{_NS_MAIN}sheet"))
    dates = _date_styles(zf, names)
    from_1904 = any(p.get("date1904") in ("1", "true") for p in wb.iter(f"{_NS_MAIN}workbookPr"))
    epoch = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
    rid = first.get(f"{_NS_REL}id")
    target = "worksheets/sheet1.xml"
    if "xl/_rels/workbook.xml.rels" in names:
        rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
        for rel in rels.iter(f"{_NS_PKG_REL}Relationship"):
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                break
    path = target if target.startswith("xl/") else f"xl/{target}"
    n_rows = 0
    with zf.open(path) as fh:
        for _, row in ET.iterparse(fh):
            if row.tag != f"{_NS_MAIN}row":
                continue
            r_idx = int(row.get("r", n_rows + 1)) - 1
            while n_rows < r_idx:  # rows absent from the XML are empty
                yield []
                n_rows += 1
            cells: list[str | None] = []
            for c in row.iter(f"{_NS_MAIN}c"):
                idx = _col_index(c.get("r")) if c.get("r") else len(cells)
                while len(cells) < idx:
                    cells.append(None)
                kind = c.get("t")
                v = c.find(f"{_NS_MAIN}v")
                if kind == "s" and v is not None:
                    value = shared[int(v.text)]
                elif kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_NS_MAIN}t"))
                elif kind == "b" and v is not None:
                    value = "true" if v.text == "1" else "false"
                else:
                    value = v.text if v is not None else None
                    if value and kind in (None, "n") and int(c.get("s", "-1")) in dates:
                        value = iso_date(value, epoch)
                cells.append(value)
            row.clear()
            yield cells
            n_rows += 1


def _ods_cell(c) -> str | None:
    vtype = c.get(f"{_NS_OFFICE}value-type")
    if vtype in ("float", "percentage", "currency"):
        return c.get(f"{_NS_OFFICE}value")
    if vtype == "date":
        return c.get(f"{_NS_OFFICE}date-value")
    if vtype == "boolean":
        return c.get(f"{_NS_OFFICE}boolean-value")
    paras = ["".join(_ods_text(p)) for p in c.findall(f"{_NS_TEXT}p")]  # a comment's paragraphs lie deeper
    return "\n".join(paras) if paras else None


def _ods_text(p) -> Iterator[str]:
    """Text of a paragraph; runs of blanks, tabs and line breaks are elements of their own."""
    yield p.text or ""
    for el in p:
        if el.tag == f"{_NS_TEXT}s":
            yield " " * int(el.get(f"{_NS_TEXT}c", "1"))
        elif el.tag == f"{_NS_TEXT}tab":
            yield "\t"
        elif el.tag == f"{_NS_TEXT}line-break":
            yield "\n"
        elif not el.tag.startswith(_NS_OFFICE):  # annotations are not part of the value
            yield from _ods_text(el)
        yield el.tail or ""


def _iter_ods(zf: zipfile.ZipFile) -> Iterator[list[str | None]]:
    """First table only; repeated cells and rows are expanded as they are
    read, blanks at the end of a row or of the table have no rows."""
    pending_empty = 0
    depth = 0
    with zf.open("content.xml") as fh:
        for event, el in ET.iterparse(fh, events=("start", "end")):
            if el.tag == f"{_NS_TABLE}table":
                if event == "start":
                    depth += 1
                    continue
                return  # end of the first table
            if event != "end" or el.tag != f"{_NS_TABLE}table-row" or depth == 0:
                continue
            cells: list[str | None] = []
            blank = 0
            for c in el:
                if c.tag not in (f"{_NS_TABLE}table-cell", f"{_NS_TABLE}covered-table-cell"):
                    continue
                rep, value = int(c.get(f"{_NS_TABLE}number-columns-repeated", "1")), _ods_cell(c)
                if value is None:
                    blank += rep  # the tail of a row is often one cell repeated to the sheet's edge
                    continue
                cells.extend([None] * blank + [value] * rep)
                blank = 0
            rep_rows = int(el.get(f"{_NS_TABLE}number-rows-repeated", "1"))
            el.clear()
            if not cells:
                pending_empty += rep_rows
                continue
            for _ in range(pending_empty):
                yield []
            pending_empty = 0
            for _ in range(rep_rows):
                yield cells


def _zipped(reader: Callable[[zipfile.ZipFile], Iterator[list[str | None]]]) -> Callable[[BinaryIO], Iterator[list[str | None]]]:
    def run(raw: BinaryIO) -> Iterator[list[str | None]]:
        with zipfile.ZipFile(raw) as zf:
            yield from reader(zf)

    return run


_READERS = {".xlsx": _zipped(_iter_xlsx), ".ods": _zipped(_iter_ods), ".xls": xls.rows}
#: Suffixes of workbooks that are read.
WORKBOOKS = tuple(_READERS)


def read_xlsx(data: bytes) -> list[list[str | None]]:
    """Rows of the first worksheet of an in-memory workbook."""
    with zipfile.ZipFile(io.BytesIO(data)) as zf:
        return list(_iter_xlsx(zf))


def read_ods(data: bytes) -> list[list[str | None]]:
    """Rows of the first table of an in-memory ODS document."""
    with zipfile.ZipFile(io.BytesIO(data)) as zf:
        return list(_iter_ods(zf))


def _suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    dot = name.rfind(".")
    return name[dot:].lower() if 0 < dot < len(name) - 1 else ""


BATCH_ROWS = 10_000


def _sheet_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from fiscalflow.sources.archives import open_input

    def frame(paths, idxs, cells, error=None):
        return pd.DataFrame({"path": paths, "row_idx": pd.Series(idxs, dtype="Int32"), "cells": cells, "erro": error})

    for pdf in batches:
        for path in pdf["path"]:
            paths, idxs, cells = [], [], []
            try:
                with open_input(path) as raw:
                    for i, row in enumerate(_READERS[_suffix(path)](raw)):
                        paths.append(path)
                        idxs.append(i)
                        cells.append(row)
                        if len(paths) >= BATCH_ROWS:  # bounded memory per task
                            yield frame(paths, idxs, cells)
                            paths, idxs, cells = [], [], []
            except Exception as e:  # noqa: BLE001 - one bad workbook must not stop the others
                yield frame([path], [None], [None], f"{type(e).__name__}: {e}")
            if paths:
                yield frame(paths, idxs, cells)


def one_file_per_task(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """Spread a path list so each task gets about one file: an explicit
    partition count (AQE does not coalesce it) with range partitioning
    (balanced, unlike hashing a few keys)."""
    paths = files.select("path")
    n = n_files if n_files is not None else paths.count()  # a listing: metadata only
    return paths.repartitionByRange(max(1, n), "path")


def spreadsheet_rows(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """``files`` has a ``path`` column (a ``binaryFile`` listing with only
    ``path`` selected reads no bytes).  Each workbook is opened by path in a
    task and its first sheet streamed out in batches of ``BATCH_ROWS``."""
    return one_file_per_task(files, n_files).mapInPandas(_sheet_batches, CELLS_SCHEMA)


def header_names(header: list[str | None]) -> list[str]:
    """Column names from a header row: blanks named by position, repeats
    (case aside) suffixed so every name is unique."""
    names, taken = [], set()
    for i, h in enumerate(header):
        base = name = (h or "").strip() or f"coluna_{i + 1}"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def promote_header(rows: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """Split cell rows into one DataFrame per distinct header row.

    Only the distinct headers (one per schema class) reach the driver.  The
    rows of each class are selected by a join with the (path, header) table,
    which has one row per file.
    """
    rows = rows.where("erro IS NULL")
    headers = rows.filter(F.col("row_idx") == 0).select("path", F.col("cells").alias("__header"))
    classes = [r["__header"] for r in headers.select("__header").distinct().collect()]
    out = []
    body = rows.filter(F.col("row_idx") > 0)
    for h in classes:
        names = header_names(list(h))
        header = F.array(*[F.lit(x).cast("string") for x in h]).cast("array<string>")
        members = headers.filter(F.col("__header").eqNullSafe(header))
        df = body.join(members.select("path"), "path", "inner").select(
            F.col("path").alias(PATH),
            F.col("row_idx").alias(ROW),
            *[F.try_element_at(F.col("cells"), F.lit(i + 1)).alias(n) for i, n in enumerate(names)],
        )
        out.append((names, df))
    return out
