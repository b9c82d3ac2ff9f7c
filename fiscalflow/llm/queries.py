"""Registered queries of this subpackage: name -> (query, DuckDB SQL or None).

Each query applies its operator, with production parameters, to whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fiscalflow.llm import bpe, dac_tokens, golomb_dedup, hard_negatives, imatch, jaccard_join, langid, maglev, mixing, packing, ranked_search, secrets_scan, toxicity
from fiscalflow.llm.common import documents


def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_predict(documents(spark, sf_dir))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The public tokenizer file; the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_dac_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac_tokens.write_and_read(documents(spark, sf_dir), vocabulary())


def op3_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(documents(spark, sf_dir), vocabulary())


def op4_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.learn_and_score(documents(spark, sf_dir), labels)


def op5_adaptive_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS s
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""


def op6_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(documents(spark, sf_dir))


def op7_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "source", "mix.*")


def op8_imatch_lexicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edit_report(documents(spark, sf_dir))


def op9_maglev_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = {f"shard-{k:03d}": 1 for k in range(maglev.SHARDS)}
    return maglev.shard_documents(documents(spark, sf_dir).select("doc_id", "text"), shards, "shard-000")


def op10_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb_dedup.exact_groups(documents(spark, sf_dir)).drop("n_chars")


OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS c, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY t ORDER BY c DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY c DESC, doc_id) AS kept,
  sha256(t) AS text_sha256
FROM n
"""


def op11_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
d AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM d),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
  SELECT item_id, doc_id,
    sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN d USING (doc_id), t GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10
"""


def op12_rotated_code_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT * FROM n WHERE rank <= 5
"""


def op13_bulk_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_rank_order_language": (op1_rank_order_language, None),
    "op2_dac_token_files": (op2_dac_token_files, None),
    "op3_backtracking_bpe": (op3_backtracking_bpe, None),
    "op4_noisy_channel_toxicity": (op4_noisy_channel_toxicity, None),
    "op5_adaptive_jaccard_join": (op5_adaptive_jaccard_join, OP5_SQL),
    "op6_markov_secret_scan": (op6_markov_secret_scan, None),
    "op7_soft_membership_mixing": (op7_soft_membership_mixing, None),
    "op8_imatch_lexicons": (op8_imatch_lexicons, None),
    "op9_maglev_shards": (op9_maglev_shards, None),
    "op10_golomb_exact_dedup": (op10_golomb_exact_dedup, OP10_SQL),
    "op11_k2_treap_search": (op11_k2_treap_search, OP11_SQL),
    "op12_rotated_code_negatives": (op12_rotated_code_negatives, OP12_SQL),
    "op13_bulk_best_fit": (op13_bulk_best_fit, None),
}
