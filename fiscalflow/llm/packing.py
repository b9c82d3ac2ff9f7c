"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Documents are encoded, end with ``END`` and are cut, if longer than a
sequence, into whole sequences and a shorter last piece.  Pieces that fill a
sequence are done.  The others are matched with the gaps of open sequences
round by round; all of a round is one sort and narrow joins:

1. sort: unplaced pieces and gaps stand together in one order, by size from
   large to small, gaps before pieces of their size, range-partitioned, so a
   length that a third of all pieces have spreads over many partitions.  A gap
   at least twice as long as the longest piece offers several slots.
2. sweep: each partition walks its part once; a piece takes the smallest slot
   passed that no other took, its successor.  What finds no partner in the
   partition keeps its rank among the partition's leftovers.
3. conflicts: pieces left over take slots left over by partitions before
   theirs, nearest first, by rank.  The driver needs the two counts of each
   partition to say which ranks meet; rows meet by a join on that number.
4. gaps: each sequence's gap is cut by what it got; then the next round.

When a round matches nothing, as many sequences are opened as the tokens left
need at least.  A sequence's pieces stand in the order of their rounds.

Defined results: a null or empty text is one piece that holds the end id
alone; repeated rows and rows without an id are packed each; ties go by the
row's place; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, discard, materialize, released, text_rows
from fiscalflow.llm.id_heap import IdHeap

#: Tokens of a sequence; the id that ends a document.
SEQUENCE, END = 4096, 1
#: Distinct words that a worker remembers at most (about 250 bytes each).
CACHE = 400_000
#: Bytes of text encoded at a time, documents in an Arrow batch, rows in a partition of the sort, about.
SLICE, BATCH, PER_PART = 2 << 20, 512, 250_000

#: Letters and digits that stay letters and digits in lower case, and signs but for the apostrophe: texts are cut between them.
LETTERS, SIGNS = "A-Za-z0-9À-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
_SWEPT = "kind int, part int, place long, key long, size int, seq long, slot int"
#: Kinds of swept rows: a match, a piece left over, a slot left over.
MATCH, PIECE, SLOT = 0, 1, 2


class Encoder:
    """The tokenizers library, asked once for each distinct word.

    The vocabulary drops white space, reads A-Z as a-z and never joins letters
    across white space or letters with signs (but for an apostrophe), so texts
    of Latin letters are cut there and their ids are those of the parts, one after the other.
    Combining marks may change the letter before them, and a special token is
    one word of letters and signs: texts with either are cut at spaces only.

    New plain words are asked for in one text: each ends with its one token
    that ends a word.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        vocab = self.library.get_vocab()
        self.ends = np.zeros(1 + max(vocab.values()), bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.special = "|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())
        self.heap = IdHeap(self._ask, CACHE)

    def _ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many of each)."""
        plain = [w for w in words if w.isascii() and w.isalpha()]
        rest = [w for w in words if not (w.isascii() and w.isalpha())] if len(plain) < len(words) else []
        ids = np.array(self.library.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(plain):
            plain, rest, ids, stops = [], words, ids[:0], stops[:0]
        one_by_one = [e.ids for e in self.library.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = np.concatenate((np.diff(stops, prepend=0), np.fromiter(map(len, one_by_one), np.int64, len(rest))))
        words[:] = plain + rest
        return np.concatenate((ids, np.fromiter((i for x in one_by_one for i in x), "<u4"))), sizes

    def _parted(self, texts: pa.Array) -> pa.Array:
        """Texts with a space wherever they may be cut."""
        odd = pc.match_substring_regex(texts, rf"\p{{M}}|{self.special}")
        cut = pc.replace_substring_regex(pc.ascii_lower(texts), rf"([{LETTERS}])([{SIGNS}])", r"\1 \2")
        cut = pc.replace_substring_regex(cut, rf"([{SIGNS}])([{LETTERS}])", r"\1 \2")
        return pc.replace_substring(pc.if_else(odd, texts, cut), "\n", " ")

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, where each text's ids end) of slices of an array of texts."""
        sizes = pc.binary_length(texts).to_numpy()
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=0)) if len(texts) else np.empty(0, np.int64)
        for lo, hi in zip([0, *cuts[cuts > 0].tolist()], [*cuts[cuts > 0].tolist(), len(texts)], strict=True):
            lists = pc.split_pattern(self._parted(texts.slice(lo, hi - lo)), " ")
            ids, n = self.heap.gather(lists.flatten())
            ends = np.concatenate(([0], np.cumsum(n)))
            offsets = lists.offsets.to_numpy()
            yield ids, ends[offsets[1:] - offsets[0]]


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _put_away() -> None:
    """Forget the words of encoding: the rounds run in the same workers, hundreds of short tasks during which the executor's heap grows."""
    if _encoder.cache_info().currsize:
        _encoder.cache_clear()
        gc.collect()  # an encoder and its heap know each other
        released()


def encoded_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, doc_id, piece, start, length, ids_crc32 [, ids]) of every row, written; ``key`` tells pieces apart."""
    spark = docs.sparkSession
    arrow_rows(spark, BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.array([END], "<u4").tobytes()
        for b in batches:
            texts, doc_ids, at = b["text"].cast(pa.string()), b["doc_id"].to_pylist(), 0
            for ids, ends in encoder.encode(texts):
                found, begin = [], 0
                for stop in ends.tolist():
                    raw = ids[begin:stop].tobytes() + end
                    found += [(doc_ids[at], k, k * SEQUENCE, raw[4 * k * SEQUENCE : 4 * (k + 1) * SEQUENCE]) for k in range(-(-len(raw) // (4 * SEQUENCE)))]
                    begin, at = stop, at + 1
                doc, piece, start, raws = zip(*found, strict=True)
                cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(r) // 4 for r in raws], pa.int32()), pa.array([zlib.crc32(r) for r in raws], pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(r, "<i4") for r in raws], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in schema.split(", ")])
        released()

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    found = text_rows(docs, id_col, text_col).mapInArrow(run, schema)
    return materialize(found.select(F.monotonically_increasing_id().alias("key"), "*"), spark, "packing-pieces")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match pieces with the nearest free slots passed, in order of size; number the leftovers."""
    _put_away()
    part = TaskContext.get().partitionId()
    slots: list[tuple[int, int]] = []
    waiting = 0

    def rows(kind, place, key, size, seq, slot) -> pa.RecordBatch:
        n = len(size)
        return pa.RecordBatch.from_arrays([
            pa.array(kind, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(place, pa.int64()), pa.array(key, pa.int64()), pa.array(size, pa.int32()), pa.array(seq, pa.int64()), pa.array(slot, pa.int32()),
        ], [c.split()[0] for c in _SWEPT.split(", ")])

    for b in batches:
        out: list[tuple] = []
        for is_piece, size, name, slot in zip(*(b[c].to_pylist() for c in ("is_piece", "size", "name", "slot")), strict=True):
            if not is_piece:
                slots.append((name, slot))
            elif slots:
                out.append((MATCH, None, name, size, *slots.pop()))
            else:
                out.append((PIECE, waiting, name, size, None, None))
                waiting += 1
        if out:
            yield rows(*zip(*out, strict=True))
    for lo in range(0, len(slots), 100_000):
        some = slots[lo : lo + 100_000]
        yield rows([SLOT] * len(some), list(range(lo, lo + len(some))), [None] * len(some), [0] * len(some), [s for s, _ in some], [k for _, k in some])


def meetings(left: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which leftovers meet: (piece's part, first place, slot's part, last place, how many), from (pieces, slots) left over by each part.

    Pieces of a part take the slots of parts before it, the nearest first.
    """
    free: list[list[int]] = []
    out = []
    for part in sorted(left):
        pieces, slots = left[part]
        done = 0
        while done < pieces and free:
            of, n = free[-1]
            take = min(pieces - done, n)
            out.append((part, done, of, n - 1, take))
            done += take
            if take == n:
                free.pop()
            else:
                free[-1][1] = n - take
        if slots:
            free.append([part, slots])
    return out


def _numbered(met: list[tuple[int, int, int, int, int]], pieces: bool):
    """Give each leftover row the number of its match, or null."""
    by_part: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for part, lo, of, hi, n in met:
        if pieces:
            by_part.setdefault(part, []).append((lo, lo + n, first - lo))
        else:
            by_part.setdefault(of, []).append((hi - n + 1, hi + 1, first + hi))
        first += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _put_away()
        for b in batches:
            parts, places = b["part"].to_numpy(), b["place"].to_numpy()
            number = np.full(len(b), -1, np.int64)
            for part in np.unique(parts).tolist():
                for lo, hi, base in by_part.get(part, ()):
                    on = (parts == part) & (lo <= places) & (places < hi)
                    number[on] = base + places[on] if pieces else base - places[on]
            yield pa.RecordBatch.from_arrays([pa.array(number), b["key"], b["size"], b["seq"], b["slot"]], ["number", "key", "size", "seq", "slot"])

    return run


_NUMBERED = "number long, key long, size int, seq long, slot int"


def place(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """(key, sequence_id, offset) of written pieces (key, length): none longer than a sequence."""
    spark = pieces.sparkSession
    arrow_rows(spark, 10_000)
    whole = pieces.where(F.col("length") == sequence).select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.where(F.col("length") < sequence).select("key", F.col("length").alias("size"))
    gaps = spark.createDataFrame([], "seq long, gap int")
    placed: list[DataFrame] = []
    opened, spent = 0, None
    matched = 0
    for turn in range(1 << 30):
        n, tokens, longest, least = todo.agg(F.count(F.lit(1)), F.sum("size"), F.max("size"), F.min("size")).first()
        if not n:
            break
        if not matched:  # nothing fits: as many new sequences as the tokens left need at least
            new = -(-tokens // sequence)
            gaps = gaps.unionByName(spark.range(opened, opened + new).select(F.col("id").alias("seq"), F.lit(sequence).alias("gap")))
            opened += new
        gaps = gaps.where(F.col("gap") >= least)
        n_gaps = gaps.count()
        most = F.least(F.greatest(F.lit(1), F.floor(F.col("gap") / longest).cast("int")), F.lit(2 * n // max(1, n_gaps) + 1).cast("int"))
        slots = gaps.select("seq", "gap", most.alias("_n")).select("seq", "gap", "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("slot"))
        slots = slots.select(F.lit(False).alias("is_piece"), F.when(F.col("slot") < F.col("_n") - 1, F.lit(longest)).otherwise(F.col("gap") - (F.col("_n") - 1) * longest).cast("int").alias("size"), F.col("seq").alias("name"), "slot")
        units = slots.unionByName(todo.select(F.lit(True).alias("is_piece"), "size", F.col("key").alias("name"), F.lit(None).cast("int").alias("slot")))
        order = [F.desc("size"), "is_piece", F.xxhash64("name"), "name", "slot"]
        parts = max(1, -(-(n + n_gaps) // PER_PART))
        swept = materialize(units.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT), spark, "packing-swept")
        counts = swept.groupBy("part").agg(*(F.count_if(F.col("kind") == k) for k in (MATCH, PIECE, SLOT))).collect()  # a row a partition
        met = meetings({r[0]: (r[2], r[3]) for r in counts})
        pieces_left = swept.where(F.col("kind") == PIECE).mapInArrow(_numbered(met, True), _NUMBERED)
        fits = swept.where(F.col("kind") == MATCH).select("key", "size", "seq", "slot")
        if met:
            slots_left = swept.where(F.col("kind") == SLOT).mapInArrow(_numbered(met, False), _NUMBERED).where("number >= 0")
            late = pieces_left.where("number >= 0").select("number", "key", "size").join(slots_left.select("number", "seq", "slot"), "number")
            fits = fits.unionByName(materialize(late.drop("number"), spark, "packing-late"))
        matched = sum(r[1] for r in counts) + sum(m[-1] for m in met)
        placed.append(fits.withColumn("turn", F.lit(turn)))
        todo = pieces_left.where("number < 0").select("key", "size")
        got = fits.groupBy("seq").agg(F.sum("size").cast("int").alias("got"))
        left = gaps.join(got, "seq", "left").select("seq", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")).where("gap > 0")
        gaps = materialize(left, spark, "packing-gaps")
        if spent is not None:
            discard(spent)
        spent = gaps
    if not placed:
        return whole
    by = Window.partitionBy("seq").orderBy("turn", "slot", "key")
    done = reduce(DataFrame.unionByName, placed).select("key", F.col("seq").alias("sequence_id"), (F.sum("size").over(by) - F.col("size")).cast("long").alias("offset"))
    return whole.unionByName(done)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row."""
    pieces = encoded_pieces(docs, tokenizer, id_col, text_col)
    return pieces.join(place(pieces), "key").select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces with ids and their places; at most a sequence's tokens meet in a group."""
    rows = pieces.join(placed, "key").groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("r"))
    return rows.select("sequence_id", F.flatten(F.transform("r", lambda x: x["ids"])).alias("ids"))
