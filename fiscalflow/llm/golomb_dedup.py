"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every task fingerprints its documents (64-bit hash of the normalised text),
   sorts the distinct fingerprints, cuts them by owner (the leading bits) and
   writes one packed row per owner: the sorted fingerprints as Golomb-Rice
   coded gaps, and beside them the ids, lengths and digests of its documents.
2. Owners read only the coded gaps, find the fingerprints that more than one
   sender has, and answer each sender with a bitmap over the list it sent.
3. Senders' rows meet their bitmaps; only documents whose bit is set, or whose
   fingerprint occurred twice in one task, are suspects.  Their texts are
   shuffled and grouped byte by byte; the rest never leave their partition.

A hot group of copies costs an owner one fingerprint a sender, and the byte
verification combines equal texts before its shuffle.

Defined results: a null text is empty, and all empty texts are copies of each
other; a null id sorts after every other id; repeated rows are copies, of
which one stays; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import anti_join, arrow_rows, materialize, released, semi_join, text_rows

#: Characters that do not count when texts are compared.
BLANKS = b" \t\n\x0b\x0c\r"
#: Fingerprints an owner handles, about; sets the number of owners (a power of two).
PER_OWNER = 2_000_000

_PACKED = "part int, owner int, at long, n long, shift int, unary binary, low binary, copies binary, ids binary, id_null binary, n_chars binary, digests binary"


def golomb_encode(sorted_values: np.ndarray) -> tuple[int, bytes, bytes]:
    """(k, unary quotients, k-bit remainders) of the gaps of ascending unsigned 64-bit values."""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    mean = int(sorted_values[-1]) // max(1, len(sorted_values)) if len(sorted_values) else 0
    k = max(0, mean.bit_length() - 1)
    quotients = gaps >> np.uint64(k) if k < 64 else np.zeros_like(gaps)
    ends = np.cumsum(quotients.astype(np.int64) + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 0
    low = gaps.astype(">u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(low, axis=1)[:, 64 - k :]
    return k, np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, low: bytes) -> np.ndarray:
    """The ascending values of ``golomb_encode``."""
    if not n:
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = np.zeros((n, 64), np.uint8)
    if k:
        bits[:, 64 - k :] = np.unpackbits(np.frombuffer(low, np.uint8))[: n * k].reshape(n, k)
    rest = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((quotients << np.uint64(k)) + rest, dtype=np.uint64)


def _pack(owner_bits: int):
    """One packed row per owner and task; a task holds 60 bytes a document, not texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, ids, sizes, digests = [], [], [], []
        for b in batches:
            ids.extend(b["doc_id"].to_pylist())
            for raw in b["text"].to_pylist():
                norm = raw.translate(None, BLANKS)
                prints.append(xxhash.xxh3_64_intdigest(norm))
                digests.append(hashlib.sha256(norm).digest())
                sizes.append(len(raw.decode("utf-8", "replace")))
        if not prints:
            return
        fp = np.array(prints, np.uint64)
        order = np.argsort(fp, kind="stable")
        fp = fp[order]
        first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
        copies = np.diff(first, append=len(fp)).astype(np.int64)
        values = fp[first]
        owners = (values >> np.uint64(64 - owner_bits)).astype(np.int64) if owner_bits else np.zeros(len(values), np.int64)
        id_null = np.array([i is None for i in ids], np.uint8)[order]
        id_all = np.array([i or 0 for i in ids], np.int64)[order]
        n_chars = np.array(sizes, np.int64)[order]
        sha = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)[order]
        part = TaskContext.get().partitionId()
        cuts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1], [True])))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            rows = slice(first[lo], first[hi] if hi < len(first) else len(fp))
            k, unary, low = golomb_encode(values[lo:hi])
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "owner": pa.array([int(owners[lo])], pa.int32()), "at": [int(first[lo])], "n": [int(hi - lo)], "shift": pa.array([k], pa.int32()),
                "unary": [unary], "low": [low], "copies": [copies[lo:hi].tobytes()], "ids": [id_all[rows].tobytes()], "id_null": [id_null[rows].tobytes()],
                "n_chars": [n_chars[rows].tobytes()], "digests": [sha[rows].tobytes()],
            })
        released()

    return run


def _answer(owner: pd.DataFrame) -> pd.DataFrame:
    """For each sender a bitmap of its fingerprints that another sender has too."""
    lists = [golomb_decode(*row) for row in zip(owner["n"], owner["shift"], owner["unary"], owner["low"], strict=True)]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return pd.DataFrame({"owner": owner["owner"], "part": owner["part"], "bitmap": bitmaps})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, at, n, copies, ids, id_null, n_chars, digests, bitmap in zip(*(b[c].to_pylist() for c in ("part", "at", "n", "copies", "ids", "id_null", "n_chars", "digests", "bitmap")), strict=True):
            copies = np.frombuffer(copies, np.int64)
            suspect = np.repeat((np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n] == 1) | (copies > 1), copies)
            digests = [digests[i : i + 32].hex() for i in range(0, len(digests), 32)]
            row_no = (part << 36) + at + np.arange(len(digests))
            yield pa.RecordBatch.from_arrays([pa.array(row_no), pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(id_null, np.uint8).astype(bool)), pa.array(np.frombuffer(n_chars, np.int64)), pa.array(digests, pa.string()), pa.array(suspect)], ["row_no", "doc_id", "n_chars", "text_sha256", "suspect"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    Of texts equal without blanks the row with the most code points stays,
    then the one with the smallest id.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = text_rows(docs, id_col, text_col)
    owner_bits = max(0, math.ceil(math.log2(max(1, docs.count() / PER_OWNER))))
    packed = materialize(rows.mapInArrow(_pack(owner_bits), _PACKED), spark, "golomb-packed")
    answers = packed.select("owner", "part", "n", "shift", "unary", "low").groupBy("owner").applyInPandas(_answer, "owner int, part int, bitmap binary")
    members = materialize(packed.drop("unary", "low", "shift").join(answers, ["owner", "part"]).mapInArrow(_unpack, "row_no long, doc_id long, n_chars long, text_sha256 string, suspect boolean"), spark, "golomb-members")

    suspects = materialize(members.where("suspect").select("doc_id").distinct(), spark, "golomb-suspects")
    norm = F.translate(F.col("text").cast("string"), BLANKS.decode(), "")
    by_bytes = semi_join(rows, suspects).select(norm.alias("norm")).groupBy("norm").agg(F.count(F.lit(1)).alias("n"))
    verified = by_bytes.groupBy(F.sha2("norm", 256).alias("sha")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_texts"))
    verified = verified.select("sha", F.when(F.col("n_texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts with one digest"))).alias("n"))
    best = members.where("suspect").groupBy(F.col("text_sha256").alias("sha")).agg(F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no"))).alias("best"))
    # A written table: a join with it can split a hot group's rows over tasks.
    groups = materialize(best.join(verified, "sha").select("sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), F.col("n").alias("group_size")), spark, "golomb-groups")
    out = members.join(groups, F.col("text_sha256") == F.col("sha"), "left")
    group_size = F.coalesce("group_size", F.lit(1)).alias("group_size")
    keep_id = F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep_id.alias("keep_id"), group_size, F.coalesce(F.col("keep_row") == F.col("row_no"), F.lit(True)).alias("kept"), "text_sha256", "n_chars")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    spark = docs.sparkSession
    found = materialize(exact_groups(docs, id_col, text_col), spark, "golomb-kept")
    if not found.groupBy("doc_id").count().where("count > 1").take(1):
        dropped = materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")), spark, "golomb-dropped")
        return anti_join(docs, dropped, id_col)
    # Rows that share an id are told apart by text and length; of rows equal in all three any one stays.
    marks = [F.col(id_col), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long"), F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), BLANKS.decode(), ""), 256)]
    kept = found.where("kept").select(F.struct("doc_id", "n_chars", "text_sha256").alias("_kept"))
    marked = docs.withColumn("_mark", F.struct(*marks))
    same = [F.col("_mark").getField(f"col{k}").eqNullSafe(F.col("_kept").getField(c)) for k, c in ((2, "n_chars"), (3, "text_sha256"))]
    same.append(F.col("_mark").getField(id_col).eqNullSafe(F.col("_kept").getField("doc_id")))
    return marked.join(kept, same, "left_semi").dropDuplicates(["_mark"]).drop("_mark")
