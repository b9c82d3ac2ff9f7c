"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band:
neither rare (misspellings, ids) nor common.  Both ends of the band are shares
of the documents, so it means the same at any size, and as a document has so
many terms only, the band has at most 2048 times a document's mean number of
distinct terms.  A document's distinct lexicon
terms are sorted; for each of several random subsets of the lexicon the terms
that fall into the subset are hashed.  Two texts agree in a subset when the
hashes are equal and not of the empty list, so a text keeps those hashes whose
terms an edit has not touched.

A fixed subset would hold none of a short text's terms or hundreds of a long
one's.  Subsets are therefore nested: at level l a subset holds 2 ** -l of the
lexicon, and a document writes the two levels that hold about one of its terms
and half as many.  Texts of like size share a level.

Document frequencies are counted over all texts.  The band's terms are sent to
the tasks as sorted 64-bit hashes, up to ``LEXICON`` of them, those of the most
documents; in a larger band the others are looked up by a join of the texts'
remaining terms, so the band is whole at any size.

Defined results: a null text is empty; a text without a lexicon term is
fingerprinted by all its terms; a text without any term has the fingerprint
``-``; such fingerprints are alike (1.0) only to their equals; equal texts
have equal fingerprints; repeated rows each have a row; rows without an id
come first in the order of documents, and rows of one id are in the order of
their texts; the only document follows itself; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, materialize, mix64, text_rows

#: A lexicon term is in at least this many documents, at least this share of them, and at most that share of them: an
#: inverse document frequency (natural logarithm) between 3.0 and 7.6 at any size of corpus.
LEAST_DOCS, LEAST_SHARE, MOST_SHARE = 2, 2.0**-11, 0.05
#: Lexicon terms that are sent to every task at most (8 bytes each); the rest of the band is joined.
LEXICON = 1 << 20
#: Random subsets of the lexicon.
SUBSETS = 32
#: Terms counted at a time in a task.
FLUSH = 1_000_000

#: Lower case for A-Z; other ASCII signs separate terms.
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@lru_cache(1)
def _seeds() -> np.ndarray:
    return mix64(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def terms(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").translate(_TO_TERMS).split())


def hashes(words: set[bytes]) -> np.ndarray:
    """Sorted hashes of distinct terms."""
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


class Lexicon:
    def __init__(self, sorted_terms: np.ndarray) -> None:
        self.terms = sorted_terms
        self.front = np.zeros(1 << 22, bool)
        self.front[(sorted_terms >> np.uint64(42)).astype(np.int64)] = True

    def known(self, h: np.ndarray) -> np.ndarray:
        h = h[self.front[(h >> np.uint64(42)).astype(np.int64)]]
        if not len(h):
            return h
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return h[self.terms[at] == h]

    def fingerprint(self, text: str, rest: np.ndarray | None = None) -> str:
        """``level:hashes:hashes`` (16 bits a subset, 0000 for an empty list), after ``*`` when no term is in the lexicon.

        ``rest`` are terms of the band that the lexicon does not hold.
        """
        every = hashes(terms(text))
        if not len(every):
            return "-"
        inside = self.known(every)
        if rest is not None and len(rest):
            inside = np.concatenate([inside, every[np.isin(every, rest)]])
        mark, used = ("", inside) if len(inside) else ("*", every)
        level = round(float(np.log2(len(used))))
        return f"{mark}{level}:" + ":".join(_subset_hashes(used, k) for k in (level, level + 1))


def _subset_hashes(used: np.ndarray, level: int) -> str:
    drawn = mix64(used[None, :] ^ _seeds()[:, None])
    member = drawn >> np.uint64(64 - level) == 0 if level else np.ones(drawn.shape, bool)
    # The hash of a list of sorted distinct terms: a sum of one mixed value a term, mixed again.
    total = np.where(member, mix64(used * np.uint64(0xD6E8FEB86659FD93))[None, :], np.uint64(0)).sum(1, dtype=np.uint64)
    code = np.where(member.any(1), (mix64(total) >> np.uint64(48)) | np.uint64(1), np.uint64(0))
    return code.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of subsets, of those not empty in both, whose hashes agree; on the common level, the finer of two."""
    if a == b:
        return 1.0
    if a == "-" or b == "-" or (a[0] == "*") != (b[0] == "*"):
        return 0.0
    (i, *x), (j, *y) = a.lstrip("*").split(":"), b.lstrip("*").split(":")
    common = [(x[k - int(i)], y[k - int(j)]) for k in range(max(int(i), int(j)), min(int(i), int(j)) + 2)]
    best = 0.0
    for p, q in common:
        u, v = np.frombuffer(bytes.fromhex(p), ">u2"), np.frombuffer(bytes.fromhex(q), ">u2")
        some = (u != 0) | (v != 0)
        best = max(best, float(((u == v) & some).sum() / max(1, some.sum())))
    return best


def fit_band(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCS, share: float = MOST_SHARE, least_share: float = LEAST_SHARE) -> tuple[DataFrame, DataFrame]:
    """Written tables (term, n) of the terms in the band and of those above it; frequencies are summed over all texts."""
    spark = docs.sparkSession
    arrow_rows(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["term", "n"])

        for b in batches:
            for raw in b["text"].to_pylist():
                held.append(hashes(terms(raw.decode("utf-8", "replace"))))
                size += len(held[-1])
            if size > FLUSH:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    total = docs.count()
    counts = text_rows(docs, id_col, text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    some = materialize(counts.where(F.col("n") >= least), spark, "imatch-terms")
    least_docs = max(float(least), least_share * total)
    most = max(least_docs, share * total)
    return some.where((F.col("n") >= least_docs) & (F.col("n") <= most)), some.where(F.col("n") > most)


def collected(terms_: DataFrame) -> np.ndarray:
    return np.sort(terms_.select("term").toArrow()["term"].to_numpy().view(np.uint64))


def fit_lexicon(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCS, share: float = MOST_SHARE) -> np.ndarray:
    """Sorted hashes of all terms in a band of up to ``LEXICON``."""
    band, _ = fit_band(docs, id_col, text_col, least, share)
    if (n := band.count()) > LEXICON:
        raise ValueError(f"the band has {n} terms, more than {LEXICON} to be sent to every task")
    return collected(band)


def split_band(band: DataFrame) -> tuple[np.ndarray, DataFrame | None]:
    """The ``LEXICON`` terms of the most documents as sorted hashes, and the table of the others, if any."""
    if band.count() <= LEXICON:
        return collected(band), None
    top = band.orderBy(F.desc("n"), "term").limit(LEXICON).toArrow()
    term, n = top["term"].to_numpy(), top["n"].to_numpy()
    least = int(n.min())
    last = int(term[n == least].max())
    return np.sort(term.view(np.uint64)), band.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("term") > last))).select("term")


def with_rest(pairs: DataFrame, lexicon: np.ndarray, above: np.ndarray, rest: DataFrame) -> DataFrame:
    """The rows of ``with_next`` with the terms of either text, or of the edited one, that are in ``rest`` (column ``rest``)."""
    pairs = materialize(pairs.withColumn("row", F.monotonically_increasing_id()), pairs.sparkSession, "imatch-pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Lexicon(np.union1d(lexicon, above))
        for b in batches:
            asked = []
            for raw, follow in zip(b["text"].to_pylist(), b["next"].to_pylist(), strict=True):
                text, after = raw.decode("utf-8", "replace"), follow.decode("utf-8", "replace")
                every = hashes(terms(text) | terms(after) | terms(edited(text, after)))
                asked.append(np.setdiff1d(every, book.known(every), assume_unique=True))
            rows = np.repeat(b["row"].to_numpy(), [len(x) for x in asked])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(np.concatenate([np.empty(0, np.uint64), *asked]).view(np.int64))], ["row", "term"])

    found = pairs.mapInArrow(run, "row long, term long").join(rest, "term", "left_semi").groupBy("row").agg(F.collect_list("term").alias("rest"))
    return pairs.join(found, "row", "left").select("doc_id", "text", "next", "rest")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next) in ascending order of ids; the last row is followed by the first.

    Rows are dealt by ranges of ids; each range gets a copy of the first row
    of the next range that has one, so no row is gathered anywhere.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted({int(x) for x in rows.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)}) if parts > 1 else []
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    # The number of bounds up to the id: a walk over one literal array, a bound a shuffle partition.
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(bounds, lambda x: x <= F.col("doc_id"))))
    dealt = rows.select(part.alias("part"), F.lit(False).alias("copy"), "doc_id", "text")
    order = F.struct(F.col("doc_id").isNotNull().alias("has_id"), F.col("doc_id"), F.col("text"))
    firsts = materialize(dealt.groupBy("part").agg(F.min(order).alias("first")), spark, "imatch-firsts")
    by_part = Window.orderBy("part")  # one row a range
    before = firsts.select(F.coalesce(F.lag("part").over(by_part), F.max("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("part"), F.lit(True).alias("copy"), F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"))
    ordered = dealt.union(before).repartition(parts, "part").sortWithinPartitions("part", "copy", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for b in batches:
            ids, texts, follow = [], [], []
            for part_, copy, doc, text in zip(*(b[c].to_pylist() for c in ("part", "copy", "doc_id", "text")), strict=True):
                if last is not None and last[0] == part_:
                    ids.append(last[1])
                    texts.append(last[2])
                    follow.append(text)
                last = None if copy else (part_, doc, text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(follow, pa.binary())], ["doc_id", "text", "next"])

    return ordered.mapInArrow(run, "doc_id long, text binary, next binary")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, lexicon: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; one narrow pass."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Lexicon(lexicon)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([book.fingerprint(t.decode("utf-8", "replace")) for t in b["text"].to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def edit_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    band, above = fit_band(docs)
    lexicon, rest = split_band(band)
    pairs = with_next(docs)
    pairs = pairs.withColumn("rest", F.lit(None).cast("array<bigint>")) if rest is None else with_rest(pairs, lexicon, collected(above), rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Lexicon(lexicon)
        known: dict[bytes, str] = {}
        for b in batches:
            out: list[tuple] = []
            for doc, raw, follow, more in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "next", "rest")), strict=True):
                more = None if more is None else np.array(more, np.int64).view(np.uint64)
                text, after = raw.decode("utf-8", "replace"), follow.decode("utf-8", "replace")
                own = known[raw] if raw in known else book.fingerprint(text, more)
                behind = own if raw == follow else book.fingerprint(after, more)
                known = {follow: behind}
                changed = edited(text, after)
                print_ = book.fingerprint(changed, more)
                out.append((doc, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), own, print_, likeness(own, print_), likeness(own, behind)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            cols = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return pairs.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
