"""Hard negatives of labelled vectors, found through rotated one-bit codes.

A vector of integer components is coded by ``CODES`` sign patterns: it is
rotated by a fixed random rotation, the signs of its components are the code,
and its alignment (inner product with the code's unit vector) is stored; what
the code does not explain, the residual, is coded again by the next rotation.
The norm of the last residual is stored, too.

An anchor's rotated components are cut to 8 bit planes, so that its inner
product with a code is eight popcounts.  The sum over codes of alignment times
that product estimates the score.  Two bounds, neither of them a probability,
make it an interval that holds the true score: the planes' rounding error
(summed over components), and Cauchy-Schwarz between the residual and the part
of the anchor that is orthogonal to the last code.  Pairs whose interval
cannot reach the results are left out; all others are scored in integers.

Two passes over all rows for a chunk of anchors: the first finds the best rows
of the anchor's own label (positives), the second the best rows of other
labels within ``LEAST`` to ``MOST`` percent of each positive's score.  A task
keeps the best few of each anchor over all its blocks, so it returns a number
of rows that does not follow its input.  Anchors are sent to the tasks in
chunks of at most ``ANCHORS``, each by itself.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; neither do vectors so long (a norm over
2^31) that scores might not fit 64 bits.  Of rows that share an id the one with the least label
and vector takes part.  A shorter vector ends in zeros.  Equal scores stand by
id.  An anchor with fewer partners has fewer rows; an empty table gives none.
Columns besides the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, materialize, scratch_path

#: Codes of a vector, one after the other; bit planes of an anchor's components.
CODES, PLANES = 4, 8
#: Rows of a block, anchors in a chunk (64 components: 1 MB), anchors compared with a block at a time.
BLOCK, ANCHORS, TOGETHER = 2048, 2048, 32
#: Positives an anchor; negatives for each of them; their scores in percent of the positive's.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 5, 80, 100
#: Every vector whose id is divisible by this is an anchor; labels of ids divisible by RELABEL move on by one of LABELS.
STEP, RELABEL, LABELS = 100, 7, 10
SCALE = 256
#: Share of two norms by which an interval is widened for rounding in doubles.
SLACK = 1e-9
_SEED = 20_240_607

_BLOCK = "ids binary, labels binary, vectors binary, codes binary, aligned binary, residual binary, norms binary"
_FOUND = "anchor_id long, slot int, vec_id long, score long"


def rotations(dim: int, codes: int = CODES) -> np.ndarray:
    """One fixed random rotation a code."""
    draws = np.random.Generator(np.random.PCG64(_SEED)).standard_normal((codes, dim, dim))
    return np.stack([np.linalg.qr(m)[0] for m in draws]) if dim else np.zeros((codes, 0, 0))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    width = max(1, -(-bits.shape[-1] // 64)) * 64
    padded = np.zeros((*bits.shape[:-1], width), np.uint8)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1).view(np.uint64)


def encode(vectors: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: row x code x word, alignments: row x code, norm of what is left)."""
    rest = vectors.astype(np.float64)
    root = np.sqrt(max(1, vectors.shape[1]))
    codes, aligned = [], []
    for turn in turns:
        turned = rest @ turn.T
        bits = turned > 0
        signs = np.where(bits, 1.0, -1.0)
        along = (turned * signs).sum(1) / root
        codes.append(_words(bits.astype(np.uint8)))
        aligned.append(along)
        rest = rest - (along[:, None] / root) * (signs @ turn)
    return np.stack(codes, 1), np.stack(aligned, 1), np.sqrt((rest**2).sum(1))


class Anchors:
    """A chunk of anchors with their bit planes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors.astype(np.int64)
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        dim = vectors.shape[1]
        self.root = np.sqrt(max(1, dim))
        self.planes, self.low, self.step, self.sums, self.error = [], [], [], [], []
        for turn in rotations(dim):
            turned = self.vectors.astype(np.float64) @ turn.T
            low = turned.min(1, initial=np.inf) if dim else np.zeros(len(ids))
            step = np.maximum((turned.max(1, initial=-np.inf) - low) / (2**PLANES - 1), 1e-12) if dim else np.ones(len(ids))
            whole = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
            cut = low[:, None] + step[:, None] * whole
            self.planes.append(np.stack([_words(((whole >> k) & 1).astype(np.uint8)) for k in range(PLANES)], 1))
            self.low.append(low)
            self.step.append(step)
            self.sums.append(cut.sum(1))
            self.error.append(np.abs(turned - cut).sum(1))

    def interval(self, part: slice, codes: np.ndarray, aligned: np.ndarray, residual: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) score of each anchor of a part with each row of a block."""
        estimate = spread = along = off = np.float64(0)
        for k in range(codes.shape[1]):
            code = codes[:, k][None]
            ones = np.bitwise_count(codes[:, k]).sum(1, dtype=np.int64)[None]
            inside = sum((np.bitwise_count(self.planes[k][part, j][:, None] & code).sum(2, dtype=np.int64) << j) for j in range(PLANES))
            picked = self.low[k][part][:, None] * ones + self.step[k][part][:, None] * inside
            along = (2 * picked - self.sums[k][part][:, None]) / self.root
            off = (self.error[k][part] / self.root)[:, None]
            estimate = estimate + along * aligned[:, k]
            spread = spread + off * aligned[:, k]
        own = self.norms[part][:, None]
        across = np.sqrt(np.maximum(own**2 - np.maximum(np.abs(along) - off, 0) ** 2, 0))
        half = spread + across * residual + SLACK * own * norms + 1e-6
        return estimate - half, estimate + half


def _blocks(dim: int):
    """Packed blocks of (id, label, vector) rows, with codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = rotations(dim)
        for b in batches:
            sizes = np.diff(b["v"].offsets.to_numpy())
            x = np.zeros((len(b), dim))
            x[np.arange(dim) < sizes[:, None]] = b["v"].flatten().to_numpy(zero_copy_only=False)
            x = np.floor(SCALE * x)
            on = (x**2).sum(1) <= 2.0**62
            x = x[on].astype("<i4")
            if not len(x):
                continue
            codes, aligned, residual = encode(x, turns)
            cols = (b["id"].to_numpy(zero_copy_only=False)[on].astype("<i8"), b["label"].to_numpy(zero_copy_only=False)[on].astype("<i8"), x, codes, aligned, residual, np.sqrt((x.astype(np.float64) ** 2).sum(1)))
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], [c.split()[0] for c in _BLOCK.split(", ")])

    return run


def _opened(row: dict, dim: int) -> tuple[np.ndarray, ...]:
    ids = np.frombuffer(row["ids"], "<i8")
    n = len(ids)
    return (
        ids, np.frombuffer(row["labels"], "<i8"), np.frombuffer(row["vectors"], "<i4").reshape(n, dim), np.frombuffer(row["codes"], np.uint64).reshape(n, CODES, -1),
        np.frombuffer(row["aligned"], "<f8").reshape(n, CODES), np.frombuffer(row["residual"], "<f8"), np.frombuffer(row["norms"], "<f8"),
    )


def _scores(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of places."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 65_536):
        at = slice(lo, lo + 65_536)
        out[at] = np.einsum("ij,ij->i", anchors[a[at]], rows[b[at]].astype(np.int64))
    return out


class _Best:
    """The best few (score, id) of each slot that a task has met."""

    def __init__(self, slots: int, keep: int) -> None:
        self.keep = keep
        self.slot, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = np.concatenate((self.slot, slot)), np.concatenate((self.score, score)), np.concatenate((self.ids, ids))
        by = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[by], score[by], ids[by]
        start = np.concatenate(([True], slot[1:] != slot[:-1])) if len(slot) else np.empty(0, bool)
        first = np.flatnonzero(start)
        place = np.arange(len(slot)) - np.repeat(first, np.diff(first, append=len(slot)))
        on = place < self.keep
        full = place == self.keep - 1
        self.floor[slot[full]] = score[full]
        self.slot, self.score, self.ids = slot[on], score[on], ids[on]


def _positives(sent, dim: int):
    """The best rows of each anchor's own label, of a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Anchors = Anchors(*sent.value[:3])
        best = _Best(len(q.ids), POSITIVES)
        for b in batches:
            for row in b.to_pylist():
                ids, labels, vectors, codes, aligned, residual, norms = _opened(row, dim)
                for lo in range(0, len(q.ids), TOGETHER):
                    part = slice(lo, lo + TOGETHER)
                    least, most = q.interval(part, codes, aligned, residual, norms)
                    allowed = (q.labels[part][:, None] == labels) & (q.ids[part][:, None] != ids)
                    floor = best.floor[part].astype(np.float64)
                    if len(ids) >= POSITIVES:  # so many rows are surely at least as good as this
                        sure = -np.partition(-np.where(allowed, least, -np.inf), POSITIVES - 1, axis=1)[:, POSITIVES - 1]
                        floor = np.maximum(floor, sure)
                    a, r = np.nonzero(allowed & (most >= floor[:, None]))
                    best.add(a + lo, _scores(q.vectors, vectors, a + lo, r), ids[r])
        yield _found(q, best, 1)

    return run


def _negatives(sent, dim: int):
    """For each anchor and positive the best rows of other labels in the window of scores, of a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Anchors(*sent.value[:3])
        wanted: np.ndarray = sent.value[3]  # anchor x positive: its score
        there: np.ndarray = sent.value[4]
        best = _Best(wanted.size, NEGATIVES)
        for b in batches:
            for row in b.to_pylist():
                ids, labels, vectors, codes, aligned, residual, norms = _opened(row, dim)
                for lo in range(0, len(q.ids), TOGETHER):
                    part = slice(lo, lo + TOGETHER)
                    least, most = q.interval(part, codes, aligned, residual, norms)
                    possible = np.zeros(least.shape, bool)
                    floors = best.floor.reshape(wanted.shape)[part].astype(np.float64)
                    for j in range(POSITIVES):
                        high = wanted[part, j].astype(np.float64)
                        low = np.maximum(LEAST * high / 100, floors[:, j])
                        possible |= there[part, j][:, None] & (most >= low[:, None] - 1) & (MOST * high[:, None] >= 100 * (least - 1))
                    a, r = np.nonzero(possible & (q.labels[part][:, None] != labels))
                    a += lo
                    score = _scores(q.vectors, vectors, a, r)
                    for j in range(POSITIVES):
                        p, n = _window(wanted[a, j], score)
                        on = there[a, j] & p & n
                        best.add(a[on] * POSITIVES + j, score[on], ids[r[on]])
        yield _found(q, best, POSITIVES)

    return run


def _window(positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(LEAST positive <= 100 negative, 100 negative <= MOST positive), without products beyond 64 bits."""
    whole, part = np.divmod(positive, 100)
    return whole * LEAST + -(-part * LEAST // 100) <= negative, negative <= whole * MOST + part * MOST // 100


def _found(q: Anchors, best: _Best, slots: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q.ids[best.slot // slots]), pa.array((best.slot % slots).astype(np.int32)), pa.array(best.ids), pa.array(best.score)], ["anchor_id", "slot", "vec_id", "score"])


def _first(rows: DataFrame, keep: int) -> DataFrame:
    by = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep)


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, v) of the rows that take part, labels moved on; one row an id."""
    key, v = F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label_col).cast("long")
    label = F.when(key % RELABEL == 0, (label + 1) % LABELS).otherwise(label)
    found = rows.where(key.isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & finite).select(key.alias("id"), label.alias("label"), v.alias("v"))
    if found.groupBy("id").count().where("count > 1").take(1):
        found = found.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    return found


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor``: which ids are anchors (column ``id``)."""
    spark = rows.sparkSession
    arrow_rows(spark, BLOCK)
    anchor = F.col("id") % STEP == 0 if anchor is None else anchor
    ready = usable(rows, id_col, vector_col, label_col)
    dim = int(ready.agg(F.max(F.size("v"))).first()[0] or 0)
    blocks = materialize(ready.mapInArrow(_blocks(dim), _BLOCK), spark, "negatives-blocks")
    chosen = ready.where(anchor)
    chunks = max(1, -(-chosen.count() // ANCHORS))
    asked = materialize(chosen.repartition(chunks).mapInArrow(_blocks(dim), _BLOCK), spark, "negatives-anchors")
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    arrow_rows(spark, 16)  # blocks, not rows, from here on
    for chunk in asked.select("ids", "labels", "vectors").toLocalIterator():  # at most BLOCK anchors at a time
        ids = np.frombuffer(chunk["ids"], "<i8")
        for lo in range(0, len(ids), ANCHORS):
            part = slice(lo, lo + ANCHORS)
            _mine_chunk(blocks, ids[part], np.frombuffer(chunk["labels"], "<i8")[part], np.frombuffer(chunk["vectors"], "<i4").reshape(len(ids), dim)[part], out)
    return spark.read.schema(schema).parquet(out)


def _mine_chunk(blocks: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, out: str) -> None:
    """Add the rows of one chunk of anchors to the result."""
    spark, dim = blocks.sparkSession, vectors.shape[1]
    sent = spark.sparkContext.broadcast((ids, labels, vectors))
    positives = materialize(_first(blocks.mapInArrow(_positives(sent, dim), _FOUND), POSITIVES), spark, "negatives-positives")
    best = positives.select("anchor_id", "rank", "score").toPandas()  # POSITIVES rows an anchor of the chunk
    order = np.argsort(ids)
    at = order[np.searchsorted(ids[order], best["anchor_id"].to_numpy(np.int64))]
    wanted, there = np.zeros((len(ids), POSITIVES), np.int64), np.zeros((len(ids), POSITIVES), bool)
    wanted[at, best["rank"].to_numpy() - 1] = best["score"]
    there[at, best["rank"].to_numpy() - 1] = True
    sent.unpersist()
    sent = spark.sparkContext.broadcast((ids, labels, vectors, wanted, there))
    negatives = _first(blocks.mapInArrow(_negatives(sent, dim), _FOUND), NEGATIVES)
    of = positives.select(F.col("anchor_id").alias("_a"), (F.col("rank") - 1).alias("_slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = negatives.join(of, (F.col("anchor_id") == F.col("_a")) & (F.col("slot") == F.col("_slot")))
    joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    sent.unpersist()
