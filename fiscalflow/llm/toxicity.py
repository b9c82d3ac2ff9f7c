"""Toxicity scores of deobfuscated text.

1. A character trigram language model is counted over all texts.
2. Words written with look-alike signs, fillers between letters, letters set
   apart or stretched are lattices: each sign may stand for one of several
   letters or for nothing.  Viterbi decoding under the language model finds the
   likeliest word; it joins the text it came from.
3. A logistic model scores the restored text by character 3- to 5-grams within
   words and longer word beginnings, each by whether it occurs once, twice or
   three times at least.  It is fitted on a bounded sample of labelled rows, weighted back to
   the labels' true shares; words that carry its evidence then get a share of
   the language model that decodes the texts to be scored.

Defined results: null and empty texts get the score of no evidence; a null
label, or one other than 0 or 1, is not learned from; without labels of both
kinds every score is 0; repeated rows are scored alike; a label repeated for
one id counts each time; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import arrow_rows, held_out, materialize, mix64, text_rows

#: Labelled rows learned from per label, about, picked by a hash of the id.
SAMPLE_PER_LABEL = 8000
#: n-grams in the model at most; least documents of label 1 and least G2 statistic of one.
FEATURES, LEAST_DOCS, LEAST_G2 = 4096, 3, 12.0
#: From this score on a text is predicted toxic.
THRESHOLD = 0.3
#: An n-gram's occurrences are told apart up to this number.
LEVELS = 3
#: Share of the language model for words that carry evidence, and the number of such words at most.
LEXICON_SHARE, LEXICON_WORDS = 0.1, 5000
#: Longest written form that is taken for one obfuscated word.
LONGEST = 24
#: Codes gathered in a task before they are counted.
FLUSH = 4_000_000

# Letters that a sign is commonly written for, with their shares.
LOOKS_LIKE = {
    "0": {"o": 1.0},
    "1": {"i": 0.6, "l": 0.4},
    "2": {"z": 1.0},
    "3": {"e": 1.0},
    "4": {"a": 1.0},
    "5": {"s": 1.0},
    "6": {"g": 0.6, "b": 0.4},
    "7": {"t": 1.0},
    "8": {"b": 1.0},
    "9": {"g": 1.0},
    "@": {"a": 1.0},
    "$": {"s": 1.0},
    "!": {"i": 0.7, "l": 0.3},
    "|": {"i": 0.5, "l": 0.5},
    "+": {"t": 1.0},
    "(": {"c": 1.0},
    "€": {"e": 1.0},
    "£": {"l": 1.0},
}
#: Signs written between letters, and signs written over letters.
FILLERS, MASKS = "._-~^'`/\\=:;,", "*#%&?"
_EDGES = ".,;:!?\"'()[]{}<>%&*#|-_~`/\\=+"
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the language model: 0 a gap, then letters; the last stands for any other letter.
_SYMBOL = {c: i for i, c in enumerate(_LETTERS + "".join(chr(i) for i in range(0xDF, 0x100) if chr(i).isalpha()), 1)}
_OTHER, _K = len(_SYMBOL) + 1, 64


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x80, 0x30000):
        if chr(i).isalpha():
            table[i] = _OTHER
    for c, i in _SYMBOL.items():
        table[ord(c)] = i
    return table


_TABLE: list[np.ndarray] = []


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def symbols(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_symbol_table())
    return _TABLE[0][_code_points(text)].astype(np.int64)


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams; every text stands between gaps."""
    s = symbols("  " + "  ".join(texts) + "  ")
    return np.bincount((s[:-2] * _K + s[1:-1]) * _K + s[2:], minlength=_K**3)


@dataclass
class CharModel:
    """log P(third symbol | first two), interpolated over three orders."""

    logp: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray) -> CharModel:
        tri = counts.reshape(_K, _K, _K).astype(np.float64)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni.sum() + _K)
        p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
        p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
        return cls(np.log(p3).astype(np.float32))

    def mixed(self, words: list[str], share: float) -> CharModel:
        """This model with a share for a list of words."""
        if not words:
            return self
        own = CharModel.fit(trigram_counts(words) * 50)
        return CharModel(np.logaddexp(self.logp + math.log(1 - share), own.logp + math.log(share)).astype(np.float32))


Lattice = list[list[tuple[str, float]]]


def lattice(written: str) -> Lattice:
    """For each sign (or run of one letter) what it may stand for, with log shares."""
    out: Lattice = []
    for m in re.finditer(r"(.)\1*", written, re.DOTALL):
        c, n = m[1], len(m[0])
        if c.isalpha():
            out.append([(c * n, 0.0)] if n < 3 else [(c, math.log(0.6)), (c * 2, math.log(0.4))])
        elif c in LOOKS_LIKE:
            read = [(x, math.log(p)) for x, p in LOOKS_LIKE[c].items()]
            out += [read] * min(n, 2)
        elif c in MASKS:
            out += [[("", math.log(0.3)), *((x, math.log(0.7 / 26)) for x in _LETTERS)]] * min(n, 3)
        elif c == " ":
            out.append([("", math.log(0.95)), (" ", math.log(0.05))])
        else:
            out.append([("", 0.0)])
    return out


def viterbi(options: Lattice, model: CharModel) -> str:
    """The likeliest reading of a lattice."""
    logp = model.logp
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for choice in [*options, [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, read) in states.items():
            for text, cost in choice:
                x, y, total = a, b, score + cost
                for c in text:
                    z = 0 if c == " " else _SYMBOL.get(c, _OTHER)
                    total += float(logp[x, y, z])
                    x, y = y, z
                if (x, y) not in after or total > after[x, y][0]:
                    after[x, y] = (total, read + text)
        states = after
    return max(states.values())[1].strip()


class Restorer:
    """Readings of the obfuscated words of texts; remembers a bounded number of written forms."""

    def __init__(self, model: CharModel, remember: int = 200_000) -> None:
        self.model, self.known, self.remember = model, {}, remember

    def read(self, written: str) -> str:
        if (found := self.known.get(written)) is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            found = self.known[written] = viterbi(lattice(written), self.model)
        return found

    def readings(self, text: str) -> list[str]:
        """Restored forms of what looks obfuscated in a lower-case text, in no fixed place."""
        tokens = text.split()
        out = []
        for token in set(tokens):
            if token.isalpha():
                continue
            core = token.strip(_EDGES)
            if core.isalpha() or len(core) < 2:
                if not (token[0] in "!|+" and core.isalpha() and token[1:2].isalpha()):
                    continue
                core = token.rstrip(_EDGES)
            if core.endswith(("$$$", "@@@")):
                core = core.rstrip("$@")
            if 3 <= len(core) <= LONGEST and sum(map(str.isalpha, core)) >= 2 and not core.isalpha():
                out.append(self.read(core))
        if _STRETCHED.search(text):
            for token in set(tokens):
                core = token.strip(_EDGES)
                if core.isalpha() and len(core) <= 2 * LONGEST and _STRETCHED.search(core):
                    out.append(self.read(core))
        singles = [i for i, t in enumerate(tokens) if len(t) == 1]
        start = 0
        for k in range(1, len(singles) + 1):
            if k == len(singles) or singles[k] != singles[k - 1] + 1:
                if k - start >= 4:
                    out.append(self.read(" ".join(tokens[singles[start] : singles[k - 1] + 1])))
                start = k
        return out

    def restore(self, text: str) -> str:
        """The text in lower case, followed by the readings of its obfuscated words."""
        low = text.lower()
        return " ".join([low, *sorted(self.readings(low))])


def ngram_hashes(text: str) -> np.ndarray:
    """Hashes of the 3- to 5-grams of a text, gaps only at their ends, and of the word beginnings of 5 to 7 letters."""
    points = _code_points(text)
    s = np.where(_letters(points), points, 1).astype(np.uint64)
    s = np.concatenate(([np.uint64(1)], s, [np.uint64(1)]))
    s = s[np.concatenate(([True], (s[1:] != 1) | (s[:-1] != 1)))]
    gap = s == 1
    out = []
    code, broken = s[:-1] * np.uint64(0x100000001B3) + s[1:], np.zeros(max(0, len(s) - 1), bool)
    for n in range(3, 9):
        if len(s) < n:
            break
        code = code[:-1] * np.uint64(0x100000001B3) + s[n - 1 :]
        broken = broken[:-1] | gap[n - 2 : len(s) - 1]
        on = ~broken if n < 6 else gap[: len(broken)] & ~broken & ~gap[n - 1 :]
        out.append(mix64(code[on] + np.uint64(n)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _letters(points: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_symbol_table())
    return _TABLE[0][points] > 0


@dataclass
class Model:
    """Weights of an n-gram's first, second and third occurrence, by ascending hash."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float
    chars: CharModel

    def __post_init__(self) -> None:
        self.front = np.zeros(1 << 20, bool)
        self.front[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def found(self, restored: str) -> np.ndarray:
        """Places in the flattened weights of what occurs in a restored text."""
        h = ngram_hashes(restored)
        h = h[self.front[(h >> np.uint64(44)).astype(np.int64)]]
        if not len(h):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        places, counts = np.unique(at[self.hashes[at] == h], return_counts=True)
        return np.concatenate([places[counts > k] * LEVELS + k for k in range(LEVELS)])

    def score(self, restored: str) -> float:
        z = self.intercept + float(self.weights[self.found(restored)].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def count_characters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Symbol trigrams of all texts, counted in tasks and summed; at most 64 ** 3 numbers come back."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_K**3, np.int64)
        for b in batches:
            total += trigram_counts([t.decode("utf-8", "replace") for t in b["text"].to_pylist()])
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int64)), pa.array(total[on])], ["code", "n"])

    rows = text_rows(docs, id_col, text_col).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_K**3, np.int64)
    counts[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _logistic(rows: list[tuple[int, float, np.ndarray]], size: int, l2: float = 0.05, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on sparse 0/1 rows, by accelerated gradient steps."""
    y, w = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    w = w * len(w) / w.sum()
    col = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(col, weights=w[row], minlength=size)) / 4 * max(1, np.bincount(row, minlength=1).mean()) + l2)
    beta, bias = np.zeros(size), math.log((w @ y + 0.5) / (w @ (1 - y) + 0.5))
    prev, look, look_b, prev_b = beta.copy(), beta.copy(), bias, bias
    for k in range(steps):
        z = np.bincount(row, weights=look[col], minlength=len(rows)) + look_b
        g = w * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        beta = look - 0.5 * scale**2 * (np.bincount(col, weights=g[row], minlength=size) + l2 * look)
        bias = look_b - 2.0 * g.sum() / len(rows)
        look, look_b = beta + k / (k + 3) * (beta - prev), bias + k / (k + 3) * (bias - prev_b)
        prev, prev_b = beta, bias
    return beta, bias


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """A model from a bounded sample of the labelled rows; None without rows of both labels."""
    spark = docs.sparkSession
    arrow_rows(spark)
    chars = CharModel.fit(count_characters(docs, id_col, text_col))
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id IS NOT NULL AND label IN (0, 1)")
    n = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    share = {k: min(1.0, per_label / v) for k, v in n.items()}
    spot = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = marks.where(spot < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    rows = text_rows(docs, id_col, text_col)
    sample = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("text", "label")  # bounded: two samples of ids

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Restorer(chars)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([reader.restore(t.decode("utf-8", "replace")) for t in b["text"].to_pylist()], pa.string()), b["label"]], ["text", "label"])

    sample = materialize(sample.mapInArrow(restored, "text string, label int"), spark, "toxic-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (label, level), parts in held.items():
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                none = np.zeros(len(values), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.full(len(values), level, np.int32)), pa.array(counts if label else none), pa.array(none if label else counts)], ["h", "level", "toxic", "clean"])

        for b in batches:
            for text, label in zip(b["text"].to_pylist(), b["label"].to_pylist(), strict=True):
                values, counts = np.unique(ngram_hashes(text), return_counts=True)
                for level in range(LEVELS):
                    held.setdefault((label, level), []).append(values[counts > level])
                size += len(values)
            if size > FLUSH:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    of = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(of) < 2:
        return None
    counts = sample.mapInArrow(counted, "h long, level int, toxic long, clean long").groupBy("h", "level").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") >= LEAST_DOCS)
    rate = (F.col("t") + F.col("c")) / float(of[0] + of[1])
    g2 = 2 * (F.col("t") * F.log(F.col("t") / (rate * of[1])) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (rate * of[0]))).otherwise(0.0))
    best = counts.where(F.col("t") > rate * of[1]).select("h", "level", g2.alias("g2")).where(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "h", "level").limit(FEATURES).toArrow()
    hashes = np.unique(best["h"].to_numpy().view(np.uint64))
    chosen = np.zeros(len(hashes) * LEVELS, bool)
    chosen[np.searchsorted(hashes, best["h"].to_numpy().view(np.uint64)) * LEVELS + best["level"].to_numpy()] = True
    model = Model(hashes, np.zeros(len(chosen)), 0.0, chars)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["label"], pa.array([(x := model.found(t))[chosen[x]].astype(np.int32).tobytes() for t in b["text"].to_pylist()], pa.binary())], ["label", "found"])

    table = sample.mapInArrow(matrix, "label int, found binary").toArrow()
    data = [(y, n[y] / of[y], np.frombuffer(x, np.int32).astype(np.int64)) for y, x in zip(table["label"].to_pylist(), table["found"].to_pylist(), strict=True)]
    data.sort(key=lambda r: (r[0], r[2].tobytes()))
    weights, intercept = _logistic(data, len(chosen))
    model = Model(hashes, weights, intercept, chars)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, float] = {}
        seen: set[str] = set()
        for b in batches:
            for text in b["text"].to_pylist():
                for word in set(re.findall(r"[^\W\d_]+", text)) - seen:
                    if 3 <= len(word) <= LONGEST and (gain := float(model.weights[model.found(word)].sum())) > 1:
                        found[word] = gain
                    seen.add(word)
                if len(seen) > FLUSH // 4:
                    seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.float64())], ["word", "gain"])

    words = sample.where("label = 1").mapInArrow(evidence, "word string, gain double").groupBy("word").agg(F.max("gain").alias("gain")).orderBy(F.desc("gain"), "word").limit(LEXICON_WORDS)
    lexicon = [r["word"] for r in words.collect()]
    return Model(hashes, weights, intercept, chars.mixed(sorted(lexicon), LEXICON_SHARE))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; one narrow pass."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Restorer(model.chars) if model else None
        for b in batches:
            found = [model.score(reader.restore(t.decode("utf-8", "replace"))) if model else 0.0 for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def learn_and_score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Learn from the labels that are not held out, score every row."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    found = score(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
