"""Language identification by rank-order n-gram profiles.

Training counts the character 1- to 3-grams of labelled texts per language and
keeps the most frequent ones, ranked, as the language's profile.  A document's
own most frequent n-grams are ranked the same way; the out-of-place distance to
a profile is the sum of rank differences, with the profile's length for an
n-gram the profile lacks.  The language with the least distance wins; on a tie
the first by name.

Defined results: a null, empty or letterless text (or a run without any
labelled row) gives ``und`` with score 0; repeated rows are each predicted; a
null label is never learned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, held_out, released, text_rows

#: n-grams kept per profile and per document.
PROFILE = 400
#: Rows learned from per language, at most about this many (a fit on a bounded sample; rows are picked by a hash of the id).
SAMPLE_PER_LANG = 2000
#: Codes gathered in a task before they are counted and sent on.
FLUSH = 4_000_000
#: Stands for any run of non-letters in an n-gram code; 21 bits a character.
GAP, BITS = 1, 21


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_codes(text: str) -> np.ndarray:
    """Codes of the 1- to 3-grams of the lower-cased words of a text; a run of other characters is one gap."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[a]
    if not is_letter.any():
        return np.empty(0, np.int64)
    a = np.concatenate(([GAP], np.where(is_letter, a, GAP), [GAP])).astype(np.int64)
    a = a[np.concatenate(([True], (a[1:] != GAP) | (a[:-1] != GAP)))]
    three = (a[:-2] << 2 * BITS) | (a[1:-1] << BITS) | a[2:]
    return np.concatenate((a[a != GAP], (a[:-1] << BITS) | a[1:], three[a[1:-1] != GAP]))


def _count(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(first, append=len(codes))


def top_ngrams(codes: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes, most frequent first, ties by code."""
    values, counts = _count(codes)
    return values[np.argsort(-counts, kind="stable")[:k]]


def _emit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes, counts = _count(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts.astype(np.int64))], ["lang", "code", "n"])

    for b in batches:
        for raw, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist(), strict=True):
            codes = ngram_codes(raw.decode("utf-8", "replace"))
            if len(codes):
                held.setdefault(lang, []).append(codes)
                size += len(codes)
        if size > FLUSH:
            yield from flush()
            held, size = {}, 0
    yield from flush()


def fit_profiles(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_per_lang: int = SAMPLE_PER_LANG, size: int = PROFILE) -> dict[str, list[int]]:
    """Ranked n-gram codes per language, from a bounded sample of the labelled rows.

    The result is languages x ``size`` numbers, whatever the input's size.
    """
    spark = labelled.sparkSession
    arrow_rows(spark)
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return {}
    # As an Arrow table: rows of Python objects would start Python workers of another kind, beside those of the tasks.
    share = spark.createDataFrame(pa.table({"_lang": pa.array(per_lang, pa.string()), "_share": pa.array([min(1.0, sample_per_lang / n) for n in per_lang.values()], pa.float64())}))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(F.broadcast(share), F.col("lang") == F.col("_lang")).where(spot < F.col("_share")).select("text", "lang")
    counts = sample.mapInArrow(_emit_counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "rank", "code").collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return profiles


class Ranker:
    """Out-of-place distances of texts to fixed profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE) -> None:
        self.langs, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)  # the last column stands for an unknown n-gram
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def distances(self, text: str) -> np.ndarray | None:
        """A distance of 0 to 1 for each language; None for a text without letters."""
        codes = ngram_codes(text)
        if not len(codes) or not self.langs:
            return None
        top = top_ngrams(codes, self.size)
        at = np.searchsorted(self.codes, top)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != top)] = len(self.codes)
        ranks = self.ranks[:, at]
        return np.where(ranks < 0, self.size, np.minimum(self.size, np.abs(ranks - np.arange(len(top))))).sum(1) / (self.size * len(top))

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, and its share of closeness against the second nearest."""
        d = self.distances(text)
        if d is None:
            return "und", 0.0
        near = np.argsort(d, kind="stable")
        best, second = 1 - d[near[0]], 1 - d[near[1]] if len(d) > 1 else 0.0
        return self.langs[near[0]], float(best / (best + second)) if best > 0 else 0.0


def predict_languages(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; one narrow pass, no shuffle."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, size)
        for b in batches:
            found = [ranker.predict(raw.decode("utf-8", "replace")) for raw in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def drop_rejected(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """The rows whose text some learned language fits, with all their columns; without profiles, all rows with a letter."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, size)
        for b in batches:
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            keep = [ranker.predict(t)[0] != "und" if profiles else len(ngram_codes(t)) > 0 for t in texts]
            yield b.filter(pa.array(keep, pa.bool_()))
        released()

    return docs.mapInArrow(run, docs.schema)


def learn_and_predict(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows that are not held out, predict every row."""
    profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    return predict_languages(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
