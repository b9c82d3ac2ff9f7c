"""Ranked lexical search over K2-treaps of the term-document grid.

Index.  Documents are cut into blocks of bounded size; a block is a grid with
a row for each term, a column for each document and, where the term occurs,
the impact of the term in the document.  The grid is stored as a K2-treap: a
quadtree whose cells hold their greatest impact with its place, that entry
being taken out of the cells below, so the tree has one node an entry.  A node
is four bits (which quadrants go on), the difference of its impact to its
parent's, and its place within the cell; nodes stand level by level, so a
child's number is a rank in the bits and no pointer is stored.  Rows are in
order of document frequency, so that cells hold terms of like density.

Search.  An item's terms are rows.  A state is a range of columns with, for
each row, the cell that the row's path has reached; its bound is the sum of
weight times the cells' maxima.  States are taken best first: where a cell's
own entry lies in the row, its document is looked up in all rows and scored
exactly; then the state is split into two ranges, one level down.  All
documents not yet scored have their entries below, so a state whose bound is
under the item's worst kept score ends there.  The items of a group go in
step, a bounded number of states each at a time, so that the arithmetic runs
over arrays.

An impact depends on a document and two totals only; weights are applied in
the search, so the index needs no join with term counts.  Document
frequencies of the items' terms are summed over the blocks' own term tables.

Items are sent to the tasks in chunks of at most ``ITEM_TERMS`` terms (an item
of more terms is a chunk by itself); a task returns at most k rows an item
whatever its input.

Defined results: a null text has no term; repeated rows are documents of
their own; a document without an id has a null id and comes last among equal
scores, an item without an id is left out, and of items that share an id each
is ranked by itself if their texts differ; no documents or no common terms
give no rows; columns besides the id and text are not read.  Terms are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.llm.common import arrow_rows, materialize, scratch_path, text_rows

#: Results an item.
K = 10
#: Documents and terms (with repeats) of a block, at most, but for a longer document.
BLOCK_DOCS, BLOCK_TERMS = 8192, 1_500_000
#: Distinct terms of a chunk of items, and of a group that goes in step.
ITEM_TERMS, GROUP_TERMS = 100_000, 1500
#: States of an item taken at a time.
STATES = 48

#: Bytes of a term are digits, letters and all beyond ASCII; A-Z are read as a-z.
_SIGNS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_TERM = bytes.maketrans(_SIGNS + bytes(range(0x41, 0x5B)), b" " * len(_SIGNS) + bytes(range(0x61, 0x7B)))

_BLOCK = "total long, bits int, doc_ids binary, doc_null binary, terms binary, df binary, levels binary, children binary, impacts binary, rows binary, cols binary"
_NULL_ID = np.iinfo(np.int64).max


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def weight(total: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * total + 2) / (2 * np.asarray(df, np.float64) + 1))).astype(np.int64)


def impact(tf: np.ndarray, n: np.ndarray, total: int, length: int) -> np.ndarray:
    """A term's part of a score but for its weight; n: the document's terms."""
    m = 10 + (90 * n.astype(np.int64) * total) // length
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 8 * m)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers, each followed by a free bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    x = x & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def _kind(bits: int) -> str:
    """The type that holds a place in a cell of 2^bits rows."""
    return "<u1" if bits <= 8 else "<u2" if bits <= 16 else "<u4"


def _wide(raw: bytes, sizes: list[int], bits: int) -> np.ndarray:
    """Places of all levels, each stored in its own type."""
    out, at, kinds = [], 0, [np.dtype(_kind(bits - level)) for level in range(len(sizes))]
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, size, at).astype(np.int64))
        at += size * kind.itemsize
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Treap:
    """A K2-treap over a square grid of 2^bits rows and columns."""

    def __init__(self, bits: int, levels: bytes, children: bytes, impacts: bytes, rows: bytes, cols: bytes) -> None:
        """The arrays as stored; ranks, parents' sums and absolute places are made once."""
        self.bits = bits
        sizes = np.frombuffer(levels, "<i8").tolist()
        self.on = np.unpackbits(np.frombuffer(children, np.uint8), count=4 * sum(sizes))
        self.rank = np.cumsum(self.on, dtype=np.int32)  # a set bit's child is the node of this number
        self.impact = np.frombuffer(impacts, "<u4").astype(np.int64)
        self.row, self.col = _wide(rows, sizes, bits), _wide(cols, sizes, bits)
        first = 0
        for level, size in enumerate(sizes[:-1]):
            # Nodes of the next level, in order, with their parent and quadrant.
            at = np.flatnonzero(self.on[4 * first : 4 * (first + size)]) + 4 * first
            child, parent, quadrant = self.rank[at], at >> 2, at & 3
            self.impact[child] = self.impact[parent] - self.impact[child]
            if level == 0:
                corner_row, corner_col = np.zeros(size, np.int64), np.zeros(size, np.int64)
            shift = bits - level - 1
            next_row = corner_row[parent - first] | ((quadrant >> 1) << shift)
            next_col = corner_col[parent - first] | ((quadrant & 1) << shift)
            self.row[child] += next_row
            self.col[child] += next_col
            corner_row, corner_col, first = next_row, next_col, first + size

    @staticmethod
    def build(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, bits: int) -> tuple[bytes, ...]:
        """(nodes a level, children bits, impacts as differences, rows and columns within their cells) of distinct entries, as stored."""
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        by = np.argsort(code)
        code, value = code[by], values[by].astype(np.int64)
        sizes, bitmaps, impacts, places = [], [], [], []
        above_cell = above_value = None
        for level in range(bits + 1):
            if not len(code):
                break
            shift = np.uint64(2 * (bits - level))
            cell = code >> shift
            start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            most = np.maximum.reduceat(value, start)
            hits = np.flatnonzero(value == np.repeat(most, np.diff(start, append=len(cell))))
            segment = np.searchsorted(start, hits, "right")
            top = hits[np.concatenate(([True], segment[1:] != segment[:-1]))]
            cells = cell[start]
            if above_cell is not None:
                parent = np.searchsorted(above_cell, cells >> np.uint64(2))
                on = np.zeros(4 * len(above_cell), np.uint8)
                on[4 * parent + (cells & np.uint64(3)).astype(np.int64)] = 1
                bitmaps.append(on)
                impacts.append(above_value[parent] - most)
            else:
                impacts.append(most)
            sizes.append(len(cells))
            places.append(code[top] & ((np.uint64(1) << shift) - np.uint64(1)))
            above_cell, above_value = cells, most
            keep = np.ones(len(code), bool)
            keep[top] = False
            code, value = code[keep], value[keep]
        if sizes:
            bitmaps.append(np.zeros(4 * sizes[-1], np.uint8))
        narrow = lambda high: b"".join(_gather(x >> np.uint64(high)).astype(_kind(bits - level)).tobytes() for level, x in enumerate(places))
        return np.array(sizes, "<i8").tobytes(), b"".join([np.packbits(np.concatenate(bitmaps)).tobytes()] if bitmaps else []), b"".join(x.astype("<u4").tobytes() for x in impacts), narrow(1), narrow(0)

    def lookup(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Impacts at places of the grid, 0 where there is no entry."""
        out = np.zeros(len(rows), np.int64)
        if not len(self.impact):
            return out
        at, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for level in range(self.bits + 1):
            own = (self.row[node] == rows) & (self.col[node] == cols)
            out[at[own]] = self.impact[node[own]]
            shift = self.bits - level - 1
            if shift < 0:
                break
            bit = 4 * node + (((rows >> shift) & 1) << 1) + ((cols >> shift) & 1)
            on = (self.on[bit] == 1) & ~own
            at, rows, cols, node = at[on], rows[on], cols[on], self.rank[bit[on]].astype(np.int64)
            if not len(at):
                break
        return out


class Kept:
    """The best k (score, doc_id) of each item of a chunk, over all blocks of a task."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.item, self.score, self.doc, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.floor, self.last = np.zeros(items, np.int64), np.full(items, _NULL_ID)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score, doc, null = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc), (self.null, null)))
        by = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[by], score[by], doc[by], null[by]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else np.empty(0, np.int64)
        place = np.arange(len(item)) - np.repeat(first, np.diff(first, append=len(item)))
        full = place == self.k - 1
        self.floor[item[full]], self.last[item[full]] = score[full], np.where(null[full], _NULL_ID, doc[full])
        on = place < self.k
        self.item, self.score, self.doc, self.null = item[on], score[on], doc[on], null[on]


class Entries:
    """Pairs (term, node) of all states, in arrays that grow by doubling."""

    def __init__(self, term: np.ndarray, node: np.ndarray) -> None:
        self.n, self.pairs = len(term), np.stack([term, node]).astype(np.int32)

    def add(self, term: np.ndarray, node: np.ndarray) -> int:
        base, self.n = self.n, self.n + len(term)
        if self.n > self.pairs.shape[1]:
            grown = np.empty((2, 2 * self.n), np.int32)
            grown[:, :base] = self.pairs[:, :base]
            self.pairs = grown
        self.pairs[0, base : self.n], self.pairs[1, base : self.n] = term, node
        return base

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pairs[0, places].astype(np.int64), self.pairs[1, places].astype(np.int64)


def _search_group(treap: Treap, docs: np.ndarray, null: np.ndarray, items: np.ndarray, term_ptr: np.ndarray, rows: np.ndarray, weights: np.ndarray, kept: Kept) -> None:
    """Best-first descent of a group of items in one block.

    ``rows`` and ``weights`` are the items' terms, item by item from
    ``term_ptr``; ``docs`` (ids of the columns) ascend, rows without an id last.
    """
    n_docs, bits = len(docs), treap.bits
    ids = np.where(null, _NULL_ID, docs)
    # States: item (place in the group), level, first column, bound, and their cells: entries from ``start`` on.
    item = np.arange(len(items))
    level, lo = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    entries_of = Entries(np.arange(len(rows)), np.zeros(len(rows), np.int64))
    start, size = term_ptr[:-1].copy(), np.diff(term_ptr)
    bound = np.add.reduceat(np.concatenate((weights * treap.impact[0], [0])), start) * (size > 0)
    done = np.zeros(len(items) * n_docs, bool)
    while len(item):
        floor, last = kept.floor[items[item]], kept.last[items[item]]
        alive = (bound > 0) & ((bound > floor) | ((bound == floor) & (ids[lo] <= last)))
        item, level, lo, bound, start, size = (x[alive] for x in (item, level, lo, bound, start, size))
        if not len(item):
            break
        by = np.lexsort((lo, -bound, item))
        first = np.flatnonzero(np.concatenate(([True], item[by][1:] != item[by][:-1])))
        runs = np.diff(first, append=len(by))
        place = np.arange(len(by)) - np.repeat(first, runs)
        taken = by[place < np.repeat(np.maximum(STATES, runs // 4), runs)]
        rest = np.ones(len(item), bool)
        rest[taken] = False
        # Cells of the states taken.
        t_item, t_level, t_lo, t_size = item[taken], level[taken], lo[taken], size[taken]
        ends = np.cumsum(t_size)
        entries = np.arange(ends[-1]) + np.repeat(start[taken] - ends + t_size, t_size)
        of, (term, node) = np.repeat(np.arange(len(taken)), t_size), entries_of.at(entries)
        # Documents whose entry stands in one of these cells itself.
        own = treap.row[node] == rows[term]
        found = np.unique(t_item[of[own]] * n_docs + treap.col[node[own]])
        found = found[~done[found]]
        if len(found):
            done[found] = True
            which, col = found // n_docs, found % n_docs
            many = np.diff(term_ptr)[which]
            stop = np.cumsum(many)
            pair = np.arange(stop[-1]) + np.repeat(term_ptr[which] - stop + many, many)
            values = weights[pair] * treap.lookup(rows[pair], np.repeat(col, many))
            score = np.add.reduceat(values, stop - many)
            on = score > 0
            kept.add(items[which[on]], score[on], docs[col[on]], null[col[on]])
        # Both halves of each state, one level down.
        shift = bits - t_level[of] - 1
        down = shift >= 0
        of, term, node, shift = of[down], term[down], node[down], shift[down]
        quadrant = 4 * node + (((rows[term] >> shift) & 1) << 1)
        halves = []
        for half in (0, 1):
            on = treap.on[quadrant + half] == 1
            child = treap.rank[quadrant[on] + half].astype(np.int64)
            halves.append((2 * of[on] + half, term[on], child, weights[term[on]] * treap.impact[child]))
        state, term, node, part = (np.concatenate(x) for x in zip(*halves, strict=True))
        by = np.argsort(state, kind="stable")
        state, term, node, part = state[by], term[by], node[by], part[by]
        begin = np.flatnonzero(np.concatenate(([True], state[1:] != state[:-1]))) if len(state) else np.empty(0, np.int64)
        new = state[begin] if len(state) else np.empty(0, np.int64)
        sums = np.add.reduceat(part, begin) if len(state) else np.empty(0, np.int64)
        parent = new >> 1
        n_lo = t_lo[parent] | ((new & 1) << np.maximum(bits - t_level[parent] - 1, 0))
        base = entries_of.add(term, node)
        item = np.concatenate((item[rest], t_item[parent]))
        level = np.concatenate((level[rest], t_level[parent] + 1))
        lo = np.concatenate((lo[rest], n_lo))
        bound = np.concatenate((bound[rest], sums))
        start = np.concatenate((start[rest], base + begin))
        size = np.concatenate((size[rest], np.diff(begin, append=len(state))))
        if entries_of.n > 1_000_000 and size.sum() * 2 < entries_of.n:  # most belong to states that are done with
            ends = np.cumsum(size)
            held = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)
            entries_of, start = Entries(*entries_of.at(held)), ends - size


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = length = 0
    for b in batches:
        for raw in b["text"].to_pylist():
            n = len(terms_of(raw))
            total += n > 0
            length += n
    yield pa.RecordBatch.from_pydict({"total": [total], "length": [length]})


def _index(total: int, length: int):
    """Blocks of the documents of a task."""

    def packed(texts: list[bytes], ids: list[int | None]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        lists = pc.split_pattern(pa.array([texts[i] for i in order], pa.large_binary()), b" ")
        coded = pc.dictionary_encode(lists.flatten())
        names = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(order)), np.diff(lists.offsets.to_numpy()))
        blank = names.index(b"") if b"" in names else -1
        doc, code = doc[code != blank], code[code != blank]
        n = np.bincount(doc, minlength=len(order))
        entry, tf = np.unique(doc * len(names) + code, return_counts=True)
        doc, code = entry // len(names), entry % len(names)
        hashes = np.fromiter(map(term_hash, names), np.uint64, len(names))
        df = np.bincount(code, minlength=len(names))
        rank = np.lexsort((hashes, -df))
        rank = rank[df[rank] > 0]
        row = np.empty(len(names), np.int64)
        row[rank] = np.arange(len(rank))
        bits = max(1, int(max(len(rank), len(order)) - 1).bit_length())
        sizes, children, impacts, rows, cols = Treap.build(row[code], doc, impact(tf, n[doc], total, length), bits)
        return pa.RecordBatch.from_pydict({
            "total": [total], "bits": pa.array([bits], pa.int32()), "doc_ids": [np.array([ids[i] or 0 for i in order], "<i8").tobytes()], "doc_null": [bytes(ids[i] is None for i in order)],
            "terms": [hashes[rank].tobytes()], "df": [df[rank].astype("<u4").tobytes()], "levels": [sizes], "children": [children], "impacts": [impacts], "rows": [rows], "cols": [cols],
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        ids: list[int | None] = []
        held = 0
        for b in batches:
            for doc, raw in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                raw = raw.translate(_TERM)
                n = raw.count(b" ") + 1
                if texts and (len(texts) >= BLOCK_DOCS or held + n > BLOCK_TERMS):
                    yield packed(texts, ids)
                    texts, ids, held = [], [], 0
                texts.append(raw)
                ids.append(doc)
                held += n
        if texts:
            yield packed(texts, ids)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the blocks of all rows as a table in the shared folder and return it."""
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = text_rows(docs, id_col, text_col)
    found = rows.mapInArrow(_totals, "total long, length long").agg(F.sum("total"), F.sum("length")).first()
    total, length = int(found[0] or 0), int(found[1] or 0)
    return materialize(rows.mapInArrow(_index(total, max(1, length)), _BLOCK), spark, "search-blocks")


def _chunks(items: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Distinct items as (item_id, term hashes), in chunks of bounded size, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [np.unique(np.fromiter(map(term_hash, set(terms_of(t))), np.uint64)).tobytes() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(terms, pa.binary())], ["item_id", "terms"])

    chunk: list[tuple[int, np.ndarray]] = []
    held = 0
    packed = items.mapInArrow(run, "item_id long, terms binary").where("item_id IS NOT NULL").distinct()
    for r in materialize(packed, items.sparkSession, "search-items").toLocalIterator():
        terms = np.frombuffer(r["terms"], np.uint64)
        if chunk and held + len(terms) > ITEM_TERMS:
            yield chunk
            chunk, held = [], 0
        chunk.append((r["item_id"], terms))
        held += len(terms)
    if chunk:
        yield chunk


def _frequencies(sent):
    """(term, documents of a task's blocks that hold it) of the chunk's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unique(np.concatenate([t for _, t in sent.value]))
        sums = np.zeros(len(wanted), np.int64)
        for b in batches:
            for terms, df in zip(b["terms"].to_pylist(), b["df"].to_pylist(), strict=True):
                terms, df = np.frombuffer(terms, np.uint64), np.frombuffer(df, "<u4")
                on = np.isin(terms, wanted)
                sums[np.searchsorted(wanted, terms[on])] += df[on]
        on = sums > 0
        yield pa.RecordBatch.from_arrays([pa.array(wanted[on].view(np.int64)), pa.array(sums[on])], ["term", "df"])

    return run


def _best(sent, k: int):
    """The best k documents of each item among a task's blocks; ``item`` is the place in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, terms, dfs = sent.value
        by = np.argsort(terms)
        terms, dfs = terms[by], dfs[by]
        owner = np.repeat(np.arange(len(chunk)), [len(t) for _, t in chunk])
        asked = np.concatenate([t for _, t in chunk])
        kept = Kept(len(chunk), k)
        for b in batches:
            for r in b.to_pylist():
                here = np.frombuffer(r["terms"], np.uint64)
                by = np.argsort(here)
                at = np.minimum(np.searchsorted(here, asked, sorter=by), len(here) - 1)
                there = here[by[at]] == asked if len(here) else np.zeros(len(asked), bool)
                if not there.any():
                    continue
                treap = Treap(*(r[c] for c in ("bits", "levels", "children", "impacts", "rows", "cols")))
                docs, null = np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["doc_null"], np.uint8).astype(bool)
                rows, own = by[at[there]], owner[there]
                weights = weight(r["total"], dfs[np.searchsorted(terms, asked[there])])
                counts = np.bincount(own, minlength=len(chunk))
                present = np.flatnonzero(counts)
                cuts = np.concatenate(([0], np.cumsum(counts[present])))
                i = 0
                while i < len(present):
                    j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + GROUP_TERMS, "right")) - 1)
                    part = slice(cuts[i], cuts[j])
                    _search_group(treap, docs, null, present[i:j], cuts[i : j + 1] - cuts[i], rows[part], weights[part], kept)
                    i = j
        items = np.array([i for i, _ in chunk], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(kept.item), pa.array(items[kept.item]), pa.array(kept.doc, mask=kept.null), pa.array(kept.score)], ["item", "item_id", "doc_id", "score"])

    return run


_RANKED = "item_id long, rank int, doc_id long, score long"


def search(blocks: DataFrame, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, from the blocks of ``build_index``."""
    spark = blocks.sparkSession
    arrow_rows(spark)
    out = scratch_path(spark, "search-ranked")
    spark.createDataFrame([], _RANKED).write.parquet(out)
    for chunk in _chunks(text_rows(items, id_col, text_col)):
        arrow_rows(spark, 4)  # a block is a large row
        sent = spark.sparkContext.broadcast(chunk)
        counted = blocks.select("terms", "df").mapInArrow(_frequencies(sent), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        terms = counted.toPandas()  # at most the chunk's terms
        sent.unpersist()
        sent = spark.sparkContext.broadcast((chunk, terms["term"].to_numpy(np.int64).view(np.uint64), terms["df"].to_numpy(np.int64)))
        by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = blocks.mapInArrow(_best(sent, k), "item long, item_id long, doc_id long, score long")
        found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(out)
        sent.unpersist()
    return spark.read.schema(_RANKED).parquet(out)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Index all documents, then rank them for each item."""
    return search(build_index(docs), items, k)
