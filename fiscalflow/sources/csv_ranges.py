"""CSV files by ranges: many tasks read one file, line breaks between quotes included.

Spark's text scan cuts files into ranges (splits) and deals out lines.  What a
line is depends on what stands before it: within quotes a line break is text.
Each range therefore goes through a two-state automaton for both states it may
begin in, and returns, for each, the state it ends in, the records that begin
in it and what its records look like (``summaries``).  Functions of two states
compose, so a walk over a file's ranges in order gives the state and the
record number that each range begins with (``starts``); a range is then cut
into records on its own (``records``).  Only records that lie across ranges
are put together from fragments, by a join on (file, record).

A quote opens a value only where the value begins, a doubled quote within
quotes is a quote, and what follows a closing quote up to the separator
belongs to the value: the rules of Spark's own reader, which parses the
records that are found here.  Blank lines between records are no records;
record 0 is the header.

The ranges of two scans must be the same, so the least number of splits is
fixed for the session where it is not set; a range that was not seen before is
an error, never a wrong row.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.sources.csv_options import reader_options, restore_empties
from fiscalflow.sources.files import REJECTED, literal_path
from fiscalflow.sources.sheets import PATH, ROW, header_names

#: Ranges whose starts are sent to the tasks at a time (about 60 bytes each: 25 TB of text at 128 MB a range).
RANGES_AT_ONCE = 200_000
BOM = b"\xef\xbb\xbf"
_BLANK = bytes(range(33))
_BATCH = 5_000


class Quotes:
    """The automaton of one separator: whether a line that begins between records, or within quotes, ends between records."""

    def __init__(self, sep: str) -> None:
        s = re.escape(sep.encode())
        quoted = rb'"(?:[^"]|"")*+"'
        value = rb"(?:%s[^%s]*+|(?!\")[^%s]*+)" % (quoted, s, s)
        more = rb"(?:%s%s)*+" % (s, value)
        self.sep = sep.encode()
        self.from_outside = re.compile(value + more).fullmatch
        self.from_inside = re.compile(rb'(?:[^"]|"")*+"[^%s]*+%s' % (s, more)).fullmatch
        self._closing = re.compile(rb'(?:[^"]|"")*+"')
        self._quoted = re.compile(rb"(^|%s)%s" % (s, quoted))

    def after(self, line: bytes, inside: bool) -> bool:
        """Whether the end of the line stands within quotes."""
        if b'"' not in line:
            return inside
        return (self.from_inside if inside else self.from_outside)(line) is None

    def fields(self, line: bytes) -> int:
        """Values of a line that begins and ends between records."""
        return (self._quoted.sub(rb"\1", line) if b'"' in line else line).count(self.sep) + 1


def physical_lines(value: bytes) -> list[bytes]:
    """A line of Spark's scan with its line feed, cut at carriage returns that stand alone."""
    core = value[:-1] if value.endswith(b"\r") else value
    if b"\r" not in core:
        return [value + b"\n"]
    first, _, rest = value.partition(b"\r")
    out = [first + b"\r"]
    while b"\r" in (rest[:-1] if rest.endswith(b"\r") else rest):
        first, _, rest = rest.partition(b"\r")
        out.append(first + b"\r")
    return [*out, rest + b"\n"]


@dataclass
class Shape:
    """What one separator's records look like in a range, for one state at its beginning."""

    inside: bool
    records: int = 0
    broken: bool = False
    fields: Counter = field(default_factory=Counter)

    def take(self, line: bytes, quotes: Quotes, width: int | None) -> None:
        """``width``: values of the line, where it has no quote."""
        blank = width == 1 and not line.strip(_BLANK)
        before = self.inside
        self.inside = before if width is not None else quotes.after(line, before)
        if not before and not blank:
            self.records += 1
            if not self.inside:
                self.fields[width if width is not None else quotes.fields(line)] += 1
        self.broken |= self.inside


@dataclass
class Range:
    """The summary of one range."""

    quotes: list[Quotes]
    utf8: bool = True
    first: bytes | None = None

    def __post_init__(self) -> None:
        self.shapes = [(Shape(False), Shape(True)) for _ in self.quotes]

    def take(self, value: bytes) -> None:
        if self.utf8 and not value.isascii():
            try:  # a character never lies across a line feed
                value.decode("utf-8")
            except UnicodeDecodeError:
                self.utf8 = False
        for line in physical_lines(value):
            if self.first is None and line.strip(_BLANK):
                self.first = line.rstrip(b"\r\n")
            plain = b'"' not in line
            for quotes, (outside, inside) in zip(self.quotes, self.shapes, strict=True):
                width = line.count(quotes.sep) + 1 if plain else None
                outside.take(line, quotes, width)
                if not plain or not inside.inside:
                    inside.take(line, quotes, width)
                else:
                    inside.broken = True

    def row(self, file: int, block: int) -> dict:
        row = {"file": file, "block": block, "utf8": self.utf8, "first": self.first}
        for k, pair in enumerate(self.shapes):
            for state, shape in enumerate(pair):
                row[f"s{k}{state}"] = {"inside": shape.inside, "records": shape.records, "broken": shape.broken, "fields": [{"n": n, "records": c} for n, c in sorted(shape.fields.items())]}
        return row


def _summary_schema(n: int) -> str:
    shape = "struct<inside: boolean, records: bigint, broken: boolean, fields: array<struct<n: bigint, records: bigint>>>"
    return "file bigint, block bigint, utf8 boolean, first binary" + "".join(f", s{k}{state} {shape}" for k in range(n) for state in (0, 1))


def fix_splits(spark: SparkSession) -> None:
    """Make the ranges of a file list depend on the files alone, not on the executors there just now."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))


def scan_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, value): lines as bytes, in order within a range; ``file`` is a hash of the path, ``block`` where the range begins."""
    fix_splits(spark)
    text = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def file_numbers(spark: SparkSession, paths: Sequence[str]) -> dict[int, str]:
    """The path, as given, of each ``file`` of ``scan_lines``; one entry a path of the reader call."""
    from fiscalflow.sources.paths import norm_path

    given = {norm_path(p): p for p in paths}
    found = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select(F.xxhash64("_metadata.file_path").alias("file"), "path").collect()
    out = {r.file: given.get(norm_path(r.path), r.path) for r in found}
    if len(out) < len({r.path for r in found}):
        raise ValueError("two paths have the same hash; read them in two calls")
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(file, block, lines) for runs of rows of one range; a range may come in several runs."""
    for b in batches:
        files, blocks = b["file"].to_numpy(), b["block"].to_numpy()
        values = b["value"].to_pylist()
        cuts = [0, *((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])).nonzero()[0] + 1, len(values)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield int(files[lo]), int(blocks[lo]), values[lo:hi]


def _without_bom(block: int, values: list[bytes]) -> list[bytes]:
    return [values[0][3:], *values[1:]] if block == 0 and values[0].startswith(BOM) else values


def summaries(lines: DataFrame, seps: Sequence[str]) -> DataFrame:
    """A row for each range (``_summary_schema``)."""
    schema = _summary_schema(len(seps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = [Quotes(s) for s in seps]
        open_range, key = None, None
        out = []
        for file, block, values in _runs(batches):
            if (file, block) != key:
                if open_range is not None:
                    out.append(open_range.row(*key))
                open_range, key = Range(quotes), (file, block)
                values = _without_bom(block, values)
            for value in values:
                open_range.take(value)
        if open_range is not None:
            out.append(open_range.row(*key))
        shape = pa.struct([("inside", pa.bool_()), ("records", pa.int64()), ("broken", pa.bool_()), ("fields", pa.list_(pa.struct([("n", pa.int64()), ("records", pa.int64())])))])
        kind = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("utf8", pa.bool_()), ("first", pa.binary()), *((f"s{k}{state}", shape) for k in range(len(seps)) for state in (0, 1))])
        yield pa.RecordBatch.from_pylist(out, kind)

    return lines.mapInArrow(run, schema)


def walk(rows: Sequence[dict], sep: int) -> tuple[list[tuple[bool, int]], Counter, bool]:
    """Of one file's summaries in order: (state, record number) at the start of each range, records by number of values, whether a line break stands within quotes."""
    inside, records, broken, fields, out = False, 0, False, Counter(), []
    for r in rows:
        out.append((inside, records))
        shape = r[f"s{sep}{int(inside)}"]
        records += shape["records"]
        broken |= shape["broken"]
        for f in shape["fields"]:
            fields[f["n"]] += f["records"]
        inside = shape["inside"]
    return out, fields, broken


def starts(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, inside, record): the state and the record number that each range begins with."""

    def of_file(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        found, _, _ = walk(rows, 0)
        return pa.table({"file": [r["file"] for r in rows], "block": [r["block"] for r in rows], "inside": [s for s, _ in found], "record": [n for _, n in found]})

    return summaries(lines, [sep]).groupBy("file").applyInArrow(of_file, "file long, block long, inside boolean, record long")


def csv_names(header: str, sep: str) -> list[str]:
    """Column names from a CSV header line, by the rule that workbooks follow."""
    return header_names(next(csv.reader([header], delimiter=sep), []))


_RECORDS = "path string, record long, piece long, raw binary"


def _cut(sent, sep: str, fragments: bool):
    """Cut each range into records: whole ones, or the fragments of those that lie across ranges (``piece``: the range)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, begin = sent.value
        quotes, key, path = Quotes(sep), None, ""
        inside, record, pieces, head = False, 0, [], False
        found: list[tuple[int, bytes]] = []

        def out(rows: list[tuple[int, bytes]], piece: int | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.repeat(path, len(rows)), pa.array([r for r, _ in rows], pa.int64()), pa.array([piece] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["path", "record", "piece", "raw"])

        def end_of_range() -> Iterator[pa.RecordBatch]:
            nonlocal found, pieces
            if found:
                yield out(found, None)
                found = []
            if pieces and fragments:  # the record goes on in the next range
                yield out([(record, b"".join(pieces))], key[1])
            pieces = []

        for file, block, values in _runs(batches):
            if (file, block) != key:
                yield from end_of_range()
                key, path = (file, block), names[file]
                if key not in begin:
                    raise RuntimeError(f"{path}: the scan was cut at {block}, which was not so before; set spark.sql.files.minPartitionNum")
                inside, record = begin[key]
                record, head = record - 1, inside
                values = _without_bom(block, values)
            for value in values:
                for line in physical_lines(value):
                    if not inside:
                        if not line.strip(_BLANK):
                            continue
                        record += 1
                    inside = quotes.after(line, inside)
                    pieces.append(line)
                    if inside:
                        continue
                    raw, pieces = b"".join(pieces), []
                    if head:
                        if fragments:
                            yield out([(record, raw)], block)
                        head = False
                    elif not fragments:
                        found.append((record, raw))
            if len(found) >= _BATCH:
                yield out(found, None)
                found = []
        if key is not None:
            yield from end_of_range()

    return run


def records(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """(path, record, raw): the records of CSV files, numbered from 0 (the header) in each file, as bytes with their line ends."""
    paths = list(paths)
    lines = scan_lines(spark, paths)
    names = file_numbers(spark, paths)
    begin = {(r.file, r.block): (r.inside, r.record) for r in starts(lines, sep).collect()}  # a row a range
    if len(begin) > RANGES_AT_ONCE and len(paths) > 1:
        half = len(paths) // 2
        return records(spark, paths[:half], sep).unionByName(records(spark, paths[half:], sep))
    sent = spark.sparkContext.broadcast((names, begin))
    whole = lines.mapInArrow(_cut(sent, sep, False), _RECORDS).drop("piece")
    if not any(inside for inside, _ in begin.values()):
        return whole
    across = lines.mapInArrow(_cut(sent, sep, True), _RECORDS).groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("piece", "raw"))).alias("r"))
    return whole.unionByName(across.select("path", "record", F.aggregate("r", F.lit(b""), lambda a, x: F.concat(a, x["raw"])).alias("raw")))


def decoded(raw: Column, encoding: str) -> Column:
    """A record's text without its line end."""
    text = raw.cast("string") if encoding.upper() == "UTF-8" else F.decode(raw, encoding)
    return F.regexp_replace(text, r"[\r\n]+\z", "")


#: Helper column of ``read_csv_by_ranges``: the whole record.
RECORD = "__registro"


def read_csv_by_ranges(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], *, sep: str, encoding: str = "UTF-8", record: bool = False) -> DataFrame:
    """The rows of CSV files as text columns ``names``, with ``PATH``, ``ROW`` (record number), ``REJECTED`` (the
    record, where it has too many or too few values) and, if asked for, ``RECORD``."""
    found = records(spark, [paths] if isinstance(paths, str) else paths, sep).where("record > 0")
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, REJECTED])
    options = reader_options(sep, "UTF-8", False, True) | {"columnNameOfCorruptRecord": REJECTED}
    parsed = found.select(F.col("path").alias(PATH), F.col("record").alias(ROW), decoded(F.col("raw"), encoding).alias(RECORD))
    parsed = parsed.select("*", F.from_csv(RECORD, ddl, options).alias("__r"))
    return restore_empties(parsed.select(PATH, ROW, *([RECORD] if record else []), *[F.col("__r")[n].alias(n) for n in [*names, REJECTED]]))


def read_typed_by_ranges(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *, sep: str, encoding: str = "UTF-8") -> DataFrame:
    """The rows of CSV files with a header as columns of ``schema``, values by place; a value that its type cannot hold is null."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    found = records(spark, [paths] if isinstance(paths, str) else paths, sep).where("record > 0")
    parsed = found.select(F.from_csv(decoded(F.col("raw"), encoding), nullable.toDDL(), reader_options(sep, "UTF-8", False, True)).alias("__r"))
    return restore_empties(parsed.select(*[F.col("__r")[f.name].alias(f.name) for f in nullable.fields]))
