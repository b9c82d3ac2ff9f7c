"""CSV dialect detection: encoding, separator and header line per file.

Spark's text scan deals out each file by ranges; a task summarises its ranges
for all separators and for both states a range may begin in (see
``csv_ranges``), and one row a range is put together by file: the encoding is
UTF-8 only if every line decodes; line breaks between quotes call for reading
by records; the separator is the one whose records agree best on their number
of values.  No task reads more than a range, no prefix stands for a file.

Decisions on the reference's hazards:
* a byte-order mark means UTF-8;
* latin-1 decodes anything, so it is the last resort, as in the reference;
* a file of one column has no separator and gets the reference's default.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.sources.csv_ranges import BOM, Quotes, Range, file_numbers, scan_lines, summaries, walk

# Fixed values of the reference's detection.
DELIMITERS = ",;\t|"
FALLBACK_SEP = ";"


def local_or_fs(path: str):
    """(filesystem or None for local, path) for a Spark path (``file:/...``,
    ``s3a://...``, ``hdfs://...``), usable inside a task."""
    if path.startswith("file:"):  # listing paths are not percent-encoded
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return None, local
    if "://" not in path:
        return None, path
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def consistency(fields: Counter) -> tuple[float, int]:
    """(share of a separator's records that have its most frequent number of values, that number), 0 where that is one value."""
    total = sum(fields.values())
    if not total:
        return 0.0, 1
    width, records = max(fields.items(), key=lambda f: (f[1], f[0]))
    return (records / total, width) if width > 1 else (0.0, 1)


def _agrees(first: bytes, sep: str, width: int) -> bool:
    """Whether the header line has so many values."""
    return Quotes(sep).fields(first) == width


def choose(rows: Sequence[dict]) -> tuple[str, str, str, bool, int]:
    """(Spark encoding name, separator, header line, whether line breaks stand within quotes, records) from a file's summaries in order."""
    rows = list(rows)
    walks = [walk(rows, k) for k in range(len(DELIMITERS))]
    scores = [consistency(fields) for _, fields, _ in walks]
    first = next((r["first"] for r in rows if r["first"] is not None), b"")
    best = max(range(len(DELIMITERS)), key=lambda k: (scores[k][0] > 0 and _agrees(first, DELIMITERS[k], scores[k][1]), *scores[k], -k))
    sep = DELIMITERS[best] if scores[best][0] > 0 else FALLBACK_SEP
    starts, _, broken = walks[DELIMITERS.index(sep)]
    last = rows[-1][f"s{DELIMITERS.index(sep)}{int(starts[-1][0])}"]
    encoding = "UTF-8" if all(r["utf8"] for r in rows) else "ISO-8859-1"
    return encoding, sep, first.decode(encoding), broken, starts[-1][1] + last["records"]


def sniff(sample: bytes) -> tuple[str, str, str]:
    """(Spark encoding name, separator, header line) of a text taken as one range; a character cut off at its end is passed over."""
    try:
        sample.decode("utf-8")
    except UnicodeDecodeError as e:
        if e.reason == "unexpected end of data" and e.start >= len(sample) - 3:
            sample = sample[: e.start]
    seen = Range([Quotes(d) for d in DELIMITERS])
    for line in (sample[3:] if sample.startswith(BOM) else sample).split(b"\n"):
        seen.take(line)
    return choose([seen.row(0, 0)])[:3]


def detect_dialects(files: DataFrame) -> DataFrame:
    """``files`` has a ``path`` column (e.g. a ``binaryFile`` listing with
    only ``path`` selected, which reads no content).  A row a file."""
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").distinct().collect()]  # the reader call needs them
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    if not paths:
        return listed.selectExpr("path", "CAST(NULL AS string) AS encoding", "CAST(NULL AS string) AS sep", "CAST(NULL AS string) AS header", "CAST(NULL AS boolean) AS multilinha", "CAST(NULL AS bigint) AS registros", "CAST(NULL AS string) AS erro")
    numbers = spark.createDataFrame(list(file_numbers(spark, paths).items()), "file long, path string")

    def of_file(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        encoding, sep, header, broken, records = choose(rows)
        return pa.table({"file": [rows[0]["file"]], "encoding": [encoding], "sep": [sep], "header": [header], "multilinha": [broken], "registros": [records]})

    found = summaries(scan_lines(spark, paths), DELIMITERS).groupBy("file").applyInArrow(of_file, "file long, encoding string, sep string, header string, multilinha boolean, registros long")
    rows = listed.join(numbers, "path", "left").join(found, "file", "left")
    # A file without a line has no summary.
    return rows.select("path", F.coalesce("encoding", F.lit("UTF-8")).alias("encoding"), F.coalesce("sep", F.lit(FALLBACK_SEP)).alias("sep"), F.coalesce("header", F.lit("")).alias("header"), F.coalesce("multilinha", F.lit(False)).alias("multilinha"), F.coalesce("registros", F.lit(0)).alias("registros"), F.lit(None).cast("string").alias("erro"))
