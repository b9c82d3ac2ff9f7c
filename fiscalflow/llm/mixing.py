"""Mixing of domains to target weights by soft membership.

1. A multinomial word model of each domain is counted on a bounded sample of a
   labelled table (text, domain).  A document's posterior over domains joins
   the evidence of its words, tempered to that of ``EVIDENCE`` words so that
   long texts are not overconfident, with its own domain tag where it has one,
   which is taken for right with probability ``TAG_TRUST``.  The ``DOMAINS`` most
   frequent domains have word models; any further one has the words of all and
   is known by its tag, so a posterior holds the first ones and its own.
2. Document rates r >= 0 are fitted by projected gradient steps (with momentum)
   on the squared distance between the expected share of tokens of each domain
   and its target, weighted up for small domains, plus a small pull towards 1.
   Steps end when every domain is close to its target, as a part of the target
   too; a warning names the domains that are not.  A step needs one number a
   domain from all documents: each task recomputes the rates of its documents
   from the list of past steps and returns its part of the sums.  No rate is
   kept between steps and none passes through the driver.
3. Copies of a document: the whole part of its rate, and one more with the
   probability of the rest, by a hash of its id.

By default targets are the domains' shares to the power ``FLATTEN``, and the
total is ``TOTAL``: as many tokens are drawn as there are, whatever the rarest
domain.  Large domains are thinned and rare ones repeated, one of share s at
about the rate s ** (FLATTEN - 1) / sum(shares ** FLATTEN).

Defined results: a null text is empty and has no tokens, so its rate moves no
total; a row without a tag is judged by its words alone; without any labelled
row, or without tokens, every rate is 1; repeated rows have equal posteriors,
rates and copies; a positive target of a domain without a labelled row is an
error; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import arrow_rows, discard, materialize, released

#: Labelled rows learned from per domain, about, picked by a hash of the id; domains with a word model at most.
SAMPLE_PER_DOMAIN, DOMAINS = 500, 256
#: Hashed words of the model; words that a text's evidence is tempered to; trust in a tag.
WORDS, EVIDENCE, TAG_TRUST = 1 << 14, 20.0, 0.9
FLATTEN = 0.7
#: Posteriors in an Arrow batch of a step (at most 257 numbers each).
STEP_ROWS = 2048
#: Tokens to draw, as a part of those there are, where the caller says nothing.
TOTAL = 1.0
#: Steps at most; the largest difference from a target share at which they stop; pull of rates towards 1.
STEPS, CLOSE, PULL = 40, 1e-4, 1e-3
#: A target counts as met within this part of it; steps at most while one is not, without a pull after ``STEPS``; the pull at most as a part of the largest share.
NEAR, MORE_STEPS, PULL_SHARE = 0.02, 100, 1 / 250


#: A-Z in lower case; blanks (ASCII) as spaces.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[9:14] = 32


def text_codes(texts: pa.Array) -> list[np.ndarray]:
    """The hashed words of each of an array of texts (bytes); each word is hashed once for all of them."""
    texts = texts.cast(pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    if offsets[0] == offsets[-1]:
        return [np.empty(0, np.int64)] * len(texts)
    raw = _PLAIN[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    blank = raw == 32
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = blank[:-1] & ~blank[1:]
    cut[offsets] = True
    # Words with the blanks after them; a text that starts with blanks has them before its first word.
    at = np.flatnonzero(cut)
    coded = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype("<i4")), pa.py_buffer(raw)]).dictionary_encode()
    words = pc.ascii_rtrim(coded.dictionary, characters=" ").cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    codes = (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(WORDS)).astype(np.int64)[coded.indices.to_numpy()]
    first = np.searchsorted(at, offsets).tolist()
    head = np.append(blank, False)[offsets].tolist()
    return [codes[i + b : j] if i < j else codes[:0] for i, j, b in zip(first[:-1], first[1:], head, strict=False)]


def word_codes(raw: bytes) -> np.ndarray:
    return text_codes(pa.array([raw], pa.binary()))[0]


@dataclass
class Classifier:
    """Log-probabilities of hashed words by domain, and the domains' shares of labelled rows.

    ``logp`` has a column for each of the first domains, and one of all words for the others.
    """

    domains: list[str]
    logp: np.ndarray
    prior: np.ndarray

    @property
    def size(self) -> int:
        """Domains with a word model."""
        return self.logp.shape[1] - 1

    def own(self, tag: str | None) -> int:
        """The place of a tag among the domains without a word model, or -1."""
        return max(-1, self._place.get(tag, -1) - self.size)

    def posterior(self, raw: bytes, tag: str | None) -> tuple[int, np.ndarray]:
        """(words, posterior): of the domains with a word model, then, where there are others, of the text's own one."""
        return self.judge(word_codes(raw), tag)

    def judge(self, codes: np.ndarray, tag: str | None) -> tuple[int, np.ndarray]:
        """``posterior`` of a text's hashed words."""
        size, k = self.size, len(self.domains)
        at = self._place.get(tag, -1)
        score = np.full(size + 1, -np.inf)
        score[:size] = np.log(self.prior[:size])
        if at >= 0 and k > 1:
            score += np.log((1 - TAG_TRUST) / (1 - self.prior[at]))
            score[min(at, size)] = np.log(TAG_TRUST)
        if len(codes):
            score = score + self.logp[codes].mean(0) * min(EVIDENCE, len(codes))
        p = np.exp(score - score.max())
        return len(codes), (p / p.sum()).astype(np.float32)[: size + (k > size)]

    def __post_init__(self) -> None:
        self._place = {d: i for i, d in enumerate(self.domains)}


def fit_classifier(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source", per_domain: int = SAMPLE_PER_DOMAIN) -> Classifier | None:
    """A classifier from a bounded sample of a labelled table; None without a labelled row."""
    spark = labelled.sparkSession
    arrow_rows(spark)
    rows = labelled.where(F.col(domain_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), F.col(domain_col).cast("string").alias("domain"))
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    by_size = sorted(sizes, key=lambda d: (-sizes[d], d))
    first = sorted(by_size[:DOMAINS])
    domains = first + sorted(by_size[DOMAINS:])
    # As an Arrow table: rows of Python objects would start Python workers of another kind, beside those of the tasks.
    share = spark.createDataFrame(pa.table({"_domain": pa.array(first, pa.string()), "_k": pa.array(range(len(first)), pa.int32()), "_share": pa.array([min(1.0, per_domain / sizes[d]) for d in first], pa.float64())}))
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(F.broadcast(share), F.col("domain") == F.col("_domain")).where(spot < F.col("_share")).select("text", F.col("_k").alias("k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for codes, k in zip(text_codes(b["text"]), b["k"].to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.bincount(codes, minlength=WORDS)
        for k, counts in total.items():
            on = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(on), k, np.int32)), pa.array(on.astype(np.int32)), pa.array(counts[on].astype(np.int64))], ["k", "word", "n"])

    found = sample.mapInArrow(run, "k int, word int, n long").groupBy("k", "word").agg(F.sum("n").alias("n")).toArrow()  # at most domains x WORDS numbers
    counts = np.zeros((WORDS, len(first) + 1))
    counts[found["word"].to_numpy(), found["k"].to_numpy()] = found["n"].to_numpy()
    # Half a count a word, dealt as the words of all: a domain of few words is like all, not unlike every text.
    every = counts.sum(1) + 1 / WORDS
    counts += (every / every.sum() * WORDS / 2)[:, None]
    prior = np.array([sizes[d] for d in domains], float)
    return Classifier(domains, np.log(counts / counts.sum(0)).astype(np.float32), prior / prior.sum())


@dataclass
class Fit:
    """The steps that give every document its rate, and the places of domains whose targets they do not meet."""

    target: np.ndarray
    step: float
    pull: float = PULL
    residuals: np.ndarray | None = None  # domains x steps
    missed: tuple[int, ...] = ()

    def rates(self, posteriors: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rates after all steps, and the point from which the next step goes on.

        With ``own`` the last column of the posteriors is that of the domain at this place behind the others; -1: none.
        """
        n = len(posteriors)
        rate, look = np.ones(n), np.ones(n)
        if self.residuals is not None:
            p = posteriors.astype(np.float64)
            size = p.shape[1] - (own is not None)
            slopes = p[:, :size] @ self.residuals[:size]
            if own is not None:
                some = np.flatnonzero(own >= 0)
                slopes[some] += p[some, size:] * self.residuals[size + own[some]]
            for t in range(slopes.shape[1]):
                before = rate
                rate = np.maximum(0.0, look - self.step * (slopes[:, t] + self.pull * (t < STEPS) * (look - 1)))
                look = rate + t / (t + 3) * (rate - before)
        return rate, look


def fit_rates(posteriors: DataFrame, size: int, target: np.ndarray | None = None, total: float | None = None, others: int = 0) -> Fit:
    """Fit rates to target weights; ``posteriors`` is a written table (n_tokens, posterior as 32-bit floats).

    ``total`` is the wanted number of tokens as a part of those there are, by default ``TOTAL``.
    ``others`` is the number of domains behind the first ``size``: then a posterior has one more
    number, that of the domain whose place among them is in the column ``own`` (-1: none).
    """
    domains, width = size + others, size + (others > 0)
    arrow_rows(posteriors.sparkSession, STEP_ROWS)

    def sums(fit: Fit) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(domains + 1)
            for b in batches:
                n = b["n_tokens"].to_numpy().astype(np.float64)
                p = np.frombuffer(b"".join(b["posterior"].to_pylist()), np.float32).reshape(-1, width)
                own = b["own"].to_numpy() if others else None
                weight = n * fit.rates(p, own)[1]
                held[:size] += weight @ p[:, :size]
                if others:
                    some = np.flatnonzero(own >= 0)
                    np.add.at(held, size + own[some], weight[some] * p[some, size])
                held[domains] += n.sum()
            on = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(held[on])], ["k", "x"])
            released()

        out = np.zeros(domains + 1)
        for r in posteriors.mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
            out[r["k"]] = r["x"]
        return out

    first = sums(Fit(np.zeros(domains), 0.0))
    tokens = first[domains]
    if not tokens:
        return Fit(np.zeros(domains), 0.0)
    share = first[:domains] / tokens
    if target is None:
        target = share**FLATTEN
    target = target / target.sum()
    if total is None:
        total = TOTAL
    # Expected shares are linear in the rates; the largest share, and any other times its weight, bounds the curvature.
    most = float(share.max())
    weight = np.where(share > 0, 2.0 ** np.floor(np.log2(most / np.where(share > 0, share, most))), 1.0)
    fit = Fit(target * total, 1.0 / (most + PULL), min(PULL, PULL_SHARE * most))
    near = NEAR * np.where(fit.target > 0, fit.target, share)
    now = share
    for t in range(MORE_STEPS + 1):
        residual = np.round(now - fit.target, 15)
        far = np.abs(residual)
        if (far <= (near if t >= STEPS else np.minimum(CLOSE, near))).all():
            break
        if t == MORE_STEPS:
            fit.missed = tuple(map(int, np.flatnonzero(far > near)))
            break
        column = (weight * residual)[:, None]
        fit.residuals = column if fit.residuals is None else np.hstack([fit.residuals, column])
        now = sums(fit)[:domains] / tokens
    return fit


def mix(docs: DataFrame, targets: dict[str, float] | None = None, labelled: DataFrame | None = None, total: float | None = None, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source") -> DataFrame:
    """The rows with n_tokens, domain, domain_share, rate and copies (as the struct column ``mix``).

    ``targets`` are weights by domain name (missing domains: 0); ``labelled``
    is a table with the same columns to learn from, by default the rows.
    Warns of domains whose targets the rates do not meet within ``NEAR``.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    docs = docs.select(*(c for c in docs.columns if c.lower() != "mix"))
    model = fit_classifier(docs if labelled is None else labelled, id_col, text_col, domain_col)
    if model is None:
        words = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")).cast("long")
        return docs.withColumn("mix", F.struct(words.alias("n_tokens"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("domain_share"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies")))
    size, others = model.size, len(model.domains) - model.size

    @F.arrow_udf("n_tokens long, posterior binary, own int")
    def judged(texts: pa.Array, tags: pa.Array) -> pa.Array:
        of = tags.to_pylist()
        found = [model.judge(codes, tag) for codes, tag in zip(text_codes(texts), of, strict=True)]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1].tobytes() for x in found], pa.binary()), pa.array(map(model.own, of), pa.int32())], ["n_tokens", "posterior", "own"])

    # Written with the rows, so that no text is judged twice.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = materialize(docs.withColumn("mix", judged(text, F.col(domain_col).cast("string"))), spark, "mix-posteriors")
    unknown = sorted(d for d, w in (targets or {}).items() if w > 0 and d not in model.domains)
    if unknown:
        raise ValueError(f"no labelled row of the target domains {unknown}")
    wanted = None if targets is None else np.array([max(0.0, targets.get(d, 0.0)) for d in model.domains])
    if wanted is not None and not wanted.sum():
        raise ValueError("no learned domain has a positive target")
    # A table of their own: a step has as many tasks as it, not the texts, asks for.
    posteriors = materialize(rows.select("mix.n_tokens", "mix.posterior", "mix.own"), spark, "mix-steps")
    fit = fit_rates(posteriors, size, wanted, total, others)
    arrow_rows(spark)
    discard(posteriors)
    if fit.missed:
        warnings.warn(f"mixing: after {fit.residuals.shape[1]} steps {len(fit.missed)} of {len(model.domains)} domains are further than {NEAR:.0%} from their targets: {[model.domains[k] for k in fit.missed[:20]]}", stacklevel=2)

    @F.arrow_udf("n_tokens long, domain string, domain_share double, rate double, copies int")
    def rated(judged: pa.Array, ids: pa.Array) -> pa.Array:
        n_tokens, posterior, own = judged.flatten()
        p = np.frombuffer(b"".join(posterior.to_pylist()), np.float32).reshape(-1, size + (others > 0))
        own = own.to_numpy(zero_copy_only=False)
        rates = fit.rates(p, own if others else None)[0]
        spot = np.array([xxhash.xxh64_intdigest(str(i), seed=7) / 2**64 for i in ids.to_pylist()])
        best = p.argmax(1) if len(p) else np.empty(0, np.int64)
        return pa.StructArray.from_arrays(
            [n_tokens, pa.array([model.domains[k + max(0, o) if k == size else k] for k, o in zip(best, own, strict=True)], pa.string()), pa.array(p.max(1).astype(np.float64) if len(p) else [], pa.float64()), pa.array(rates, pa.float64()), pa.array(np.floor(rates + spot).astype(np.int32), pa.int32())],
            ["n_tokens", "domain", "domain_share", "rate", "copies"],
        )

    # Not deterministic to the planner: a filter on its result must not call it once more.
    return rows.withColumn("mix", rated.asNondeterministic()("mix", id_col))


def draw(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` as often as their copies say, without the ``mix`` column."""
    return mixed.where("mix.copies > 0").withColumn("mix", F.explode(F.sequence(F.lit(1), F.col("mix.copies")))).drop("mix")
