"""Secret scan: three fixed patterns, and character Markov models for the rest.

Built-in expressions only.  One pass over the texts finds the matches of each
pattern and the lengths of the pieces between them; running sums of those
lengths give code-point spans.  Long tokens that no pattern covers are scored
by the log-likelihood ratio of two first-order character models: random
strings against ordinary identifiers.  Both are trained from labelled samples
of the corpus itself: the values that the patterns found are secrets, long
tokens of two documents or more that are spelt as words are (small letters,
with a capital before them or all capitals, joined by signs or humps) are
ordinary, as they stand and in capitals.  Every long token with a letter is scored, whether it has digits or
not; one of digits and signs alone is a number.

Defined results: a null text is empty; a text without a finding has zero
counts, empty spans and the digest of the empty string; repeated rows are each
scanned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, materialize

# The patterns of the base findings.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Least length of an assigned value, of a token that is scored and of an ordinary sample.
VALUE, TOKEN, SAMPLE = 8, 16, 12
LONG_TOKEN = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{%d,}+(?![\p{L}\p{N}])" % SAMPLE
#: How ordinary names are spelt; one or two small letters between capitals are no hump.
SPELT = r"^(?:[A-Z]?[a-z]{3,}+|[A-Z]{3,}+)(?:[+/_=-]+(?:[A-Za-z][a-z]*+|[A-Z]++)|[A-Z][a-z]{2,}+)*+$"
#: Characters of the models; place 0 is a token's start.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_K = len(ALPHABET) + 1
#: Part of each model that is uniform over the alphabet: strings of unseen kinds stay possible.
RANDOM_UNIFORM, ORDINARY_UNIFORM = 0.5, 0.02
#: Added to each count of a pair of characters.
SMOOTHING = 0.05
#: Log-likelihood ratio, in all and per character, from which on a token is a secret.
LEAST_RATIO, LEAST_PER_CHARACTER = 12.0, 0.6
KINDS = ("assign", "access", "hex", "markov")


def _matches(text: Column, pattern: str, group: int, possible: Column) -> Column:
    return F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(F.array().cast("array<string>"))


def _gaps(text: Column, pattern: str, matches: Column) -> Column:
    """Code points before each match since the one before it."""
    return F.when(F.size(matches) > 0, F.transform(F.split(text, pattern, -1), F.length)).otherwise(F.array().cast("array<int>"))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row with a key of its own, and the pattern matches and long tokens with their spans."""
    spark = docs.sparkSession
    arrow_rows(spark)
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A pattern is tried only where a character that it cannot do without occurs.
    assigns = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    found = rows.select(
        "*",
        _matches(text, ASSIGN, 0, assigns).alias("m0"),
        _matches(text, ACCESS, 0, F.contains(text, F.lit("AKIA"))).alias("m1"),
        _matches(text, HEX, 0, F.lit(True)).alias("m2"),
        _matches(text, LONG_TOKEN, 0, F.lit(True)).alias("m3"),
    )
    patterns = (ASSIGN, ACCESS, HEX, LONG_TOKEN)
    scanned = found.select(
        "row", "doc_id", *(f"m{k}" for k in range(4)), *(_gaps(text, p, F.col(f"m{k}")).alias(f"g{k}") for k, p in enumerate(patterns)),
        F.when(F.size("m0") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>")).alias("v0"),
    )
    scanned = materialize(scanned, spark, "secrets-scan")
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"m{k}").alias("m"), F.col(f"g{k}").alias("g"), F.col("v0" if k == 0 else f"m{k}").alias("v")) for k in range(4)))
    each = scanned.select("row", F.inline(kinds)).where(F.size("m") > 0)
    each = each.select("row", "kind", "g", "v", F.posexplode("m").alias("i", "match"))
    each = each.select("row", "kind", "i", "match", F.element_at("g", F.col("i") + 1).alias("gap"), F.element_at("v", F.col("i") + 1).alias("value"))
    end = F.sum(F.col("gap") + F.length("match")).over(Window.partitionBy("row", "kind").orderBy("i"))
    spans = each.select("row", "kind", "value", (end - F.length("match")).alias("start"), end.alias("end")).where((F.col("kind") > 0) | (F.length("value") >= VALUE))
    # A long token that touches a base finding is part of it.
    base = F.col("kind") < 3
    by_start = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    spans = spans.select("*", reach.alias("reach"), ahead.alias("ahead"))
    alone = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True)))
    spans = materialize(spans.where(base | alone).drop("reach", "ahead"), spark, "secrets-spans")
    return scanned.select("row", "doc_id"), spans


def labelled_samples(spans: DataFrame) -> DataFrame:
    """(sample, secret): values of base findings, and ordinary long tokens in both cases."""
    value = F.col("value")
    # Random strings spelt like words are met once; each word counts once, however often it is met.
    ordinary = spans.where((F.col("kind") == 3) & value.rlike(SPELT)).groupBy("value").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a < b").select("value")  # combined before its shuffle
    return (
        spans.where(F.col("kind") < 3).select(value.alias("sample"), F.lit(True).alias("secret"))
        .union(ordinary.select(value, F.lit(False)))
        .union(ordinary.select(F.upper(value), F.lit(False)))
    )


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all character pairs, from (sample, secret) rows; at most 2 x 68 x 68 counts come back."""
    marked = samples.select("secret", F.concat(F.lit(" "), "sample").alias("s")).where(F.length("s") > 1)
    pairs = marked.select("secret", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr("s", i, F.lit(2)))).alias("pair"))
    rows = pairs.groupBy("secret", "pair").agg(F.count(F.lit(1)).alias("n")).collect()
    place = {c: i for i, c in enumerate(ALPHABET, 1)}
    counts = {True: [[0.0] * _K for _ in range(_K)], False: [[0.0] * _K for _ in range(_K)]}
    for r in rows:
        a, b = place.get(r["pair"][0], 0), place.get(r["pair"][1], 0)
        counts[r["secret"]][a][b] += r["n"]
    out = []
    for a in range(_K):
        random, ordinary = counts[True][a], counts[False][a]
        for b in range(_K):
            p, q = ((x[b] + SMOOTHING) / (sum(x) + SMOOTHING * _K) for x in (random, ordinary))
            out.append(math.log((1 - RANDOM_UNIFORM) * p + RANDOM_UNIFORM / _K) - math.log((1 - ORDINARY_UNIFORM) * q + ORDINARY_UNIFORM / _K))
    return out


def ratio(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token under a table of ``train``."""
    places = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    padded = F.concat(F.lit(" "), value)
    at = lambda i: F.instr(F.lit(ALPHABET), F.substr(padded, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), F.lit(0.0), lambda total, i: total + F.element_at(places, at(i) * _K + at(i + 1) + 1))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    rows, spans = findings(docs, id_col, text_col)
    table = train(labelled_samples(spans))
    value = F.col("value")
    tokens = spans.where((F.col("kind") == 3) & (F.length(value) >= TOKEN) & value.rlike("[A-Za-z]"))
    scored = tokens.withColumn("ratio", ratio(value, table)).where((F.col("ratio") >= LEAST_RATIO) & (F.col("ratio") >= LEAST_PER_CHARACTER * F.length(value)))
    found = spans.where("kind < 3").union(scored.drop("ratio"))
    named = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    label = F.concat_ws(":", named, F.col("start").cast("string"), F.col("end").cast("string"))
    listed = found.groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(4)),
        F.array_sort(F.collect_list(F.struct("start", "kind", label.alias("label")))).alias("all"),
    )
    joined = rows.join(listed, "row", "left")
    text_of = lambda items: F.concat_ws(",", F.transform(items, lambda x: x["label"]))
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,label:string>>"))
    return joined.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(text_of(F.filter(every, lambda x: x["kind"] < 3)), 256).alias("base_sha256"), text_of(every).alias("spans"),
        F.coalesce("n_markov", F.lit(0)).cast("long").alias("n_markov"),
    )
