"""Token ids in directly addressable codes.

An id is cut into chunks of ``WIDTH`` bits, lowest first.  Level 0 holds the
first chunk of every id; a continuation bitmap says which ids go on, and level
1 holds the next chunk of those alone, and so on.  A rank directory (set bits
before each run of ``RUN`` bitmap bits) finds an id's chunk on the next level,
so any token is read in a few steps without decoding what stands before it.

The file format is a Parquet table of blocks in ascending document order: per
block the document ids, the token offset of each document, and per level the
chunks, the bitmap and the directory.  Blocks are written by Spark's commit
protocol to any store that Spark writes to; a block's place among all tokens
follows from the counts of the blocks before it, so nothing is renumbered.

Defined results: null and empty texts hold the end id alone; documents with a
null id come first; repeated rows are written each; rows with one id are in
the order of their texts; an empty table gives an empty file and result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import BROADCAST_ROWS, arrow_rows, scratch_path, text_rows
from fiscalflow.llm.id_heap import IdHeap

#: Bits of a chunk (a power of two up to 32, so that chunks are whole numbers of a NumPy type).
WIDTH = 8
#: Bitmap bits for one entry of the rank directory.
RUN = 512
#: Distinct pieces of text that a worker remembers at most (about 150 bytes each).
CACHE = 600_000
#: Documents in an Arrow batch, bytes of text in a block, and of a row group of the file, about.
BATCH, SLICE, ROW_GROUP = 512, 2 << 20, 16 << 20
#: Ends each document.
END = 2
#: What a space is written as in a byte-level vocabulary.
SPACE = "\u0120"

_BLOCK = "part int, block int, before long, n_docs int, n_tokens long, ids binary, id_null binary, offsets binary, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"


class Dac:
    """One block of ids in directly addressable codes."""

    def __init__(self, n: int, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], width: int = WIDTH) -> None:
        self.n, self.width = n, width
        self.raw = chunks, bitmaps, ranks
        self.chunks = [np.frombuffer(c, f"<u{width // 8}") for c in chunks]
        self.bitmaps = [np.frombuffer(b, np.uint8) for b in bitmaps]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def encode(cls, ids: np.ndarray, width: int = WIDTH) -> Dac:
        chunks, bitmaps, ranks = [], [], []
        rest = ids.astype(np.uint64 if width > 16 else np.uint32, copy=False)
        while True:
            chunks.append(rest.astype(f"<u{width // 8}").tobytes())  # the lowest bits
            rest = rest >> rest.dtype.type(width)
            more = rest > 0
            if not more.any():
                return cls(len(ids), chunks, bitmaps, ranks, width)
            before = np.concatenate(([0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RUN)))))[:-1]
            bitmaps.append(np.packbits(more).tobytes())
            ranks.append(before.astype("<u4").tobytes())
            rest = rest[more]

    def token(self, i: int) -> int:
        """The id at place i: a bit test and a rank a level."""
        value = int(self.chunks[0][i])
        for level, (bitmap, ranks) in enumerate(zip(self.bitmaps, self.ranks, strict=True), 1):
            if not bitmap[i >> 3] >> (7 - (i & 7)) & 1:
                break
            run = i // RUN
            bits = np.unpackbits(bitmap[run * RUN // 8 : (i >> 3) + 1])[: i - run * RUN]
            i = int(ranks[run]) + int(bits.sum())
            value |= int(self.chunks[level][i]) << (level * self.width)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, as many steps as levels; the rest of the block is not touched."""
        out = self.chunks[0][start:stop].astype(np.uint32)
        at, lo, hi = np.arange(stop - start), start, stop
        for level, (bitmap, ranks) in enumerate(zip(self.bitmaps, self.ranks, strict=True), 1):
            if lo >= hi:
                break
            run = lo // RUN
            bits = np.unpackbits(bitmap[run * RUN // 8 : (hi + 7) >> 3])
            skip = lo - run * RUN
            on = bits[skip : skip + hi - lo] == 1
            lo = int(ranks[run]) + int(bits[:skip].sum())
            at = at[on]
            hi = lo + len(at)
            out[at] |= self.chunks[level][lo:hi].astype(np.uint32) << np.uint32(level * self.width)
        return out


#: What a byte is where texts are cut: a letter or number, a sign, the first byte of another character that is no blank; 0: a blank, or unknown.
LETTER, SIGN, OTHER = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(128) if chr(c).isalnum()]] = LETTER
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = SIGN
_KIND[[c for c in range(0xC3, 0xF5) if c not in (0xE1, 0xE2, 0xE3)]] = OTHER  # blanks beyond ASCII start with C2, E1, E2 or E3


class CachedTokenizer:
    """The tokenizers library, asked once for each distinct piece of text.

    A new word of the vocabulary's pattern always starts at a space before a
    non-blank, and at a sign after a letter or number; texts are cut there
    (where the bytes alone tell), so the ids of a text are those of its pieces,
    one after the other.  New pieces that start with their only space are asked
    for in one text: each starts with a token that starts with a space, and
    holds no other one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        vocab = self.library.get_vocab()
        self.starts = np.zeros(1 + max(vocab.values()), bool)
        self.starts[[i for token, i in vocab.items() if token[0] == SPACE]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.heap = IdHeap(self._learn, CACHE)

    def _ask(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many of each); plain ones come first."""
        plain = [p for p in pieces if p[0] == " " and p.rfind(" ") == 0 and not p[1:2].isspace()]
        ids = np.array(self._ask(["".join(plain)])[0] if plain else [], "<u4")
        at = np.flatnonzero(self.starts[ids])
        if len(at) != len(plain):
            plain, ids, at = [], ids[:0], at[:0]
        taken = set(plain)
        rest = [p for p in pieces if p not in taken] if len(plain) < len(pieces) else []
        pieces[:] = plain + rest
        found = self._ask(rest)
        sizes = np.concatenate((np.diff(at, append=len(ids)), np.fromiter(map(len, found), np.int64, len(found))))
        return np.concatenate((ids, np.fromiter((i for x in found for i in x), "<u4"))), sizes

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(pieces of all of an array of texts, one text after the other; the place of each text's first, and of the end)."""
        offsets = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        if data is None or offsets[0] == offsets[-1]:
            return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
        data = data.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        raw = np.frombuffer(data, np.uint8)
        kind = _KIND[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = (kind[:-1] == LETTER) & (kind[1:] == SIGN)
        for token in self.special:  # its string is no word: such a text is cut at spaces alone
            for i in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)).tolist():
                cut[offsets[i] : offsets[i + 1]] = False
        cut[:-2] |= (raw[:-1] == 32) & (kind[1:] > 0)
        cut[offsets] = True
        at = np.flatnonzero(cut)
        return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype("<i4")), data]), np.searchsorted(at, offsets)

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all of an array of texts, one after the other; the place of each text's first, and of the end)."""
        pieces, first = self.pieces(texts)
        ids, n = self.heap.gather(pieces)
        return ids, np.concatenate(([0], np.cumsum(n)))[first]

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each of an array of texts."""
        ids, cuts = self.encode_flat(texts)
        return [ids[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


@lru_cache(2)
def _tokenizer(path: str) -> CachedTokenizer:
    return CachedTokenizer(path)


def write_tokens(docs: DataFrame, tokenizer: str, out: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Encode every row and write the blocks to ``out``, in ascending document order."""
    arrow_rows(docs.sparkSession, BATCH)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.binary_length(b["text"]).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=0)).tolist()
            cuts = [0, *(c for c in cuts if c), len(b)]
            yield from (b.slice(lo, hi - lo) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if hi > lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _tokenizer(tokenizer), TaskContext.get().partitionId()
        before = 0
        for block, b in enumerate(slices(batches)):
            found, cuts = encoder.encode_flat(b["text"].cast(pa.string()))
            offsets = (cuts + np.arange(len(cuts))).astype("<i8")
            dac = Dac.encode(np.insert(found, cuts[1:], np.uint32(end)))
            doc_ids = b["doc_id"].to_pylist()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "before": [before], "n_docs": pa.array([len(b)], pa.int32()), "n_tokens": [int(offsets[-1])],
                "ids": [np.array([i or 0 for i in doc_ids], "<i8").tobytes()], "id_null": [bytes(i is None for i in doc_ids)], "offsets": [offsets.tobytes()],
                "chunks": pa.array([dac.raw[0]], pa.list_(pa.binary())), "bitmaps": pa.array([dac.raw[1]], pa.list_(pa.binary())), "ranks": pa.array([dac.raw[2]], pa.list_(pa.binary())),
            })
            before += int(offsets[-1])

    ordered = text_rows(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # Uncompressed, so that a token is where its codes say.
    ordered.mapInArrow(run, _BLOCK).write.options(**{"compression": "uncompressed", "parquet.block.size": str(ROW_GROUP)}).parquet(out)


def placed_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a written file, each with ``start``, the tokens before it.

    A block knows the tokens before it in its part; the parts' totals, one row
    a part, are summed in one task and joined, broadcast up to a checked size,
    so that blocks do not move.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = totals.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_start"))
    if totals.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    return blocks.join(starts, F.col("part") == F.col("_part")).withColumn("start", F.col("_start") + F.col("before")).drop("_part", "_start", "before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a written file; ids as little-endian 32-bit integers."""
    arrow_rows(spark, 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                dac = Dac(row["n_tokens"], row["chunks"], row["bitmaps"], row["ranks"])
                offsets = np.frombuffer(row["offsets"], "<i8")
                block = dac.tokens(0, row["n_tokens"]).astype("<u4", copy=False)
                ids = [block[x:y].tobytes() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                null = np.frombuffer(row["id_null"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["ids"], "<i8"), mask=null), pa.array(offsets[:-1] + row["start"]), pa.array(np.diff(offsets)), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return placed_blocks(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_at(blocks: DataFrame, place: Column | int) -> DataFrame:
    """(place, token) for the places asked for (one column or number), read from placed blocks without decoding them."""
    at = F.lit(place) if isinstance(place, int) else place
    hit = blocks.where((F.col("start") <= at) & (at < F.col("start") + F.col("n_tokens"))).withColumn("_at", at.cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            found = [Dac(r["n_tokens"], r["chunks"], r["bitmaps"], r["ranks"]).token(r["_at"] - r["start"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["_at"] for r in rows], pa.int64()), pa.array(found, pa.int64())], ["place", "token"])

    return hit.mapInArrow(run, "place long, token long")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, from the files read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "dac-tokens")
    write_tokens(docs, tokenizer, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["start"], b["n_tokens"], pa.array([zlib.crc32(x) for x in b["ids"].to_pylist()], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_documents(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
