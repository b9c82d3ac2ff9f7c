"""Corpus preparation: five stages over ``documents``, each written as Parquet and read again.

1. language ID: documents that no learned language fits (no letters) go;
2. exact dedup: of texts equal without blanks one stays;
3. near-duplicate join: of each group linked by 5-word shingles at a Jaccard
   similarity of 0.8 or more one stays;
4. mixing: documents are drawn at the rates that bring the sources to flatter
   weights;
5. BPE: ids of every document left, their text decoded again, and digests of both.

Each stage works on all rows that the one before it kept.  No stage has an SQL
form (models, hashing and a tokenizer), so ``ORACLE_SQL`` is None and every
stage is tested against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.llm import bpe, golomb_dedup, jaccard_join, langid, mixing
from fiscalflow.llm.common import documents, held_out, materialize
from fiscalflow.llm.queries import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = langid.fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    return langid.drop_rejected(docs, profiles)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return golomb_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(docs, vocabulary(), content=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return docs
