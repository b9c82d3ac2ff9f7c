"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word 5-grams (64-bit hashes).  Sets are
ordered from rare to frequent grams.  If two sets of sizes n and m have a
Jaccard similarity of t or more, they share at least ``need(n)`` grams, so
their prefixes of length n - need(n) + l share at least l grams, for any l.
A longer prefix (a greater l) costs more postings and asks for more shared
grams before a pair is verified; each document takes the l of least estimated
cost, from the frequencies of the grams at its front.  Most pairs share a gram
by chance; parities of grams by hash bucket (about n bits a set) tell how many
grams a pair differs by at least, and only pairs that may be similar by them go
on.  Shared prefix postings are counted by pair; a pair that does not share l of
them in the lists it was met in is tested by its two prefixes alone, and only
pairs that share l grams fetch both sets.

Stages, all over whole texts and all documents:

1. profiles: size and signature of each set; frequent grams (those that occur
   twice or more in a task are summed over tasks).  The most frequent ones,
   at most ``HOT_GRAMS``, fix the order; any order gives the same links.
2. postings: prefix grams go to buckets by hash, packed by batch.  Grams that
   one set only has end there.  Grams known as frequent need no such test and
   pass through in salted buckets, so none is gathered in one task.  Lists are
   cut by size: sets that differ too much in size for a link share no list.
   Of a similar pair the smaller set has its first shared gram in a still
   shorter prefix; postings in it are flagged, and a pair needs the smaller
   set's flag: sets whose own part is longer than the difference allowed, such
   as short texts around one boilerplate line, have none in common.  Lists of
   the same sets are one list, named by its sets.
3. links: in each list the sets are compared with one pivot, the
   set that most lists have; verified links make components; a second round
   takes pivots at random and skips pairs within one component.
4. the rest: a pair in two components that no pivot has tested is tested in
   blocks: sets outside a list's main component are the queries, the list's
   sets stand in blocks of about ``BLOCK`` grams and at most ``BLOCK_SETS``
   sets, and a task holds one block and a batch of queries under like bounds.
   Only sets that may be similar to one of another component by their parities
   are tested with all their grams.  No list is expanded
   into all its pairs.

Links between equal sets are the classes of equal signature (128 bits).  Every
link between different sets is found or lies within a component already.

Defined results: a null or blank text has an empty set and is linked with
nothing; a text under five words is one gram; a row without an id is left out
of the links, and keeps the class of its equals; repeated rows form one class;
an empty table gives an empty result; other columns are not read.  Tables
written on the way are removed as soon as nothing reads them any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import BROADCAST_ROWS, anti_join, arrow_rows, discard, materialize, mix64, released, semi_join, text_rows
from fiscalflow.llm.components import components

#: Words in a gram; least similarity, in hundredths.
WORDS, PERCENT = 5, 80
#: Frequent grams that are sent to every task, at most (16 bytes each).
HOT_GRAMS = 1 << 18
#: Longest prefix extension, and the cost of verifying a pair against that of a posting.
MOST_MATCHES, VERIFY_COST = 8, 20.0
#: Postings in a bucket, grams in a block of sets, grams of the queries beside a block, about.
PER_BUCKET, BLOCK, QUERIES = 500_000, 1_000_000, 1_000_000
#: Sets in a block, queries beside it, at most about: 4 million comparisons of parities a task.
BLOCK_SETS = 2000
#: Hash buckets that grams are counted in; for parities as many as there are grams, at least one word of bits.
COUNTERS, WORD_BITS = 256, 64
#: Sets are first compared by the upper half of each hash; halves may agree by chance, so only a pair that shares so many
#: more than it needs is similar by them alone (nine agreements by chance do not happen), and one that shares too few is not.
CHANCE = 8
#: Grams counted, and postings packed, at a time in a task.
CHUNK = 1_000_000
#: Signatures that a task remembers, so that copies it meets are taken once (about 100 bytes each).
SEEN = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_set(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text, A-Z in lower case."""
    found = raw.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if len(h) < words:
        return mix64(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64))
    n = len(h) - words + 1
    grams = h[:n].copy()
    for k in range(1, words):
        grams = grams * _ODD + h[k : k + n]
    return np.unique(mix64(grams))


def need(n: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """Grams that a set of size n shares with any set similar to it."""
    return -(-n * percent // 100)


def need_smaller(n: int, percent: int = PERCENT) -> int:
    """Grams that a set of size n shares with any similar set that is not smaller."""
    return -(-2 * n * percent // (100 + percent))


class Order:
    """Grams from rare to frequent: by known frequency, then by hash."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> None:
        by = np.argsort(grams)
        self.grams, self.counts, self.percent = grams[by], counts[by], percent

    def arrange(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(grams in order, which of them are known as frequent, matches asked for)."""
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), bool)
        freq = np.where(known, self.counts[at], 0) if len(self.grams) else np.zeros(len(grams), np.int64)
        by = np.lexsort((grams, freq))
        freq = freq[by]
        base = len(grams) - int(need(len(grams), self.percent))
        cost = np.cumsum(freq)
        best, matches = None, 1
        for l in range(1, min(MOST_MATCHES, len(grams) - base) + 1):  # noqa: E741
            postings = float(cost[base + l - 1])
            total = postings + VERIFY_COST * postings / l
            if best is None or total < best:
                best, matches = total, l
        return grams[by], known[by], matches


def similar(a: np.ndarray, b: np.ndarray, a_matches: int, b_matches: int, percent: int = PERCENT) -> bool:
    """Multi-match test on the two ordered sets' prefixes, then the exact similarity."""
    n, m = len(a), len(b)
    if 100 * min(n, m) < percent * max(n, m):
        return False
    l = min(a_matches, b_matches)  # noqa: E741
    shared = np.intersect1d(a[: n - need(n, percent) + l], b[: m - need(m, percent) + l], assume_unique=True)
    if len(shared) < l:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (n + m - both)


def _signature(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _heads(sigs: list[bytes]) -> np.ndarray:
    """The first 64 bits of signatures, by which postings name their sets."""
    return np.frombuffer(b"".join(s[:8] for s in sigs), np.uint64)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each gram that this task has seen twice (kind 1: gram, count)."""
    seen: set[bytes] = set()
    held: list[np.ndarray] = []
    size = 0
    names = ["kind", "doc_id", "n", "sig", "head"]

    def frequent() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        on = counts > 1
        k = int(on.sum())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.array(values[on].view(np.int64)), pa.array(counts[on].astype(np.int64)), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())], names)

    for b in batches:
        sets = [gram_set(t) for t in b["text"].to_pylist()]
        sigs = [_signature(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int32)), b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()), pa.array(_heads(sigs).view(np.int64))], names)
        for s, sig in zip(sets, sigs, strict=True):
            if len(s) and sig not in seen:
                seen.add(sig)
                held.append(s)
                size += len(s)
        if size > CHUNK:
            yield frequent()
            held, size = [], 0
        if len(seen) > SEEN:
            seen.clear()
    if held:
        yield frequent()
    released()


def _postings(order: Order, buckets: int):
    """Prefix grams of each distinct set (signature's head, size and flag, upper half of the gram), packed by bucket; frequent ones in buckets of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        sigs: list[bytes] = []
        grams: list[np.ndarray] = []
        known: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        size = turn = 0

        def packed() -> Iterator[pa.RecordBatch]:
            gram, hot, n = np.concatenate(grams), np.concatenate(known), np.concatenate(sizes)
            head = np.repeat(_heads(sigs), [len(g) for g in grams])
            bucket = (gram % np.uint64(buckets)).astype(np.int64)
            # Frequent grams need no list in one place; which bucket takes them does not matter.
            bucket[hot] = buckets + (xxhash.xxh3_64_intdigest(sigs[0]) + turn) % buckets
            by = np.argsort(bucket, kind="stable")
            bucket, head, n, gram = bucket[by], head[by], n[by], (gram[by] >> np.uint64(32)).astype(np.uint32)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield pa.RecordBatch.from_pydict({"bucket": [int(bucket[lo])], "heads": [head[lo:hi].tobytes()], "sizes": [n[lo:hi].tobytes()], "grams": [gram[lo:hi].tobytes()]})

        for b in batches:
            for doc, raw in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                s = gram_set(raw)
                if doc is None or not len(s) or (sig := _signature(s)) in seen:
                    continue
                seen.add(sig)
                ordered, is_known, matches = order.arrange(s)
                length = len(s) - int(need(len(s), order.percent)) + matches
                sigs.append(sig)
                flags = np.arange(length) < len(s) - need_smaller(len(s), order.percent) + 1
                sizes.append((len(s) * 2 + flags).astype(np.uint32))
                grams.append(ordered[:length])
                known.append(is_known[:length])
                size += length
            if size > CHUNK // 4:
                yield from packed()
                sigs, grams, known, sizes = [], [], [], []
                size, turn = 0, turn + 1
            if len(seen) > SEEN:
                seen.clear()
        if sigs:
            yield from packed()
        released()

    return run


def _lists(buckets: int, percent: int):
    """Of one bucket the postings whose gram two sets of like size have; all postings of a frequent gram.

    In a bucket, a list is a run of sizes without a gap too wide for a link,
    and ``list`` is a hash of its sets, so that lists of the same sets, in one
    bucket or several, are one (``grams``: of how many grams).  A frequent
    gram's postings, which are not together, go to two size classes each, so
    that any two sets of like size share one; ``list`` is a hash of gram and class.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sig, size, gram = (np.concatenate([np.frombuffer(x, kind) for x in rows[c]]) for c, kind in (("heads", np.uint64), ("sizes", np.uint32), ("grams", np.uint32)))
        n, flag, gram = (size >> 1).astype(np.int64), size & 1 == 1, gram.astype(np.uint64)
        if int(rows["bucket"].iloc[0]) >= buckets:
            band = np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)
            sig, n, flag, gram, band = (np.concatenate((x, y)) for x, y in ((sig, sig), (n, n), (flag, flag), (gram, gram), (band, band + 1)))
            key, many = mix64(gram + band.astype(np.uint64) * _ODD), np.ones(len(n), np.int64)
        else:
            by = np.lexsort((sig, n, gram))
            by = by[np.concatenate(([True], (gram[by][1:] != gram[by][:-1]) | (sig[by][1:] != sig[by][:-1])))] if len(by) else by  # copies from several tasks
            sig, n, flag, gram = sig[by], n[by], flag[by], gram[by]
            for _ in range(2):  # dropping what has no partner may leave others alone
                new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
                # A set without its flag needs a flagged one of its size or smaller; both are in order of size.
                run_no = np.cumsum(new_gram)
                flagged = np.maximum.accumulate(np.where(flag, run_no * (1 << 32) + n, 0))
                upto = flagged[np.searchsorted(run_no * (1 << 32) + n, run_no * (1 << 32) + n, "right") - 1]
                useful = (upto >> 32 == run_no) & (100 * (upto & 0xFFFFFFFF) >= percent * n)
                start = new_gram | np.concatenate(([True], 100 * n[:-1] < percent * n[1:]))
                first = np.flatnonzero(start)
                size = np.repeat(np.diff(first, append=len(n)), np.diff(first, append=len(n)))
                keep = useful & (size > 1)
                sig, n, flag, gram = sig[keep], n[keep], flag[keep], gram[keep]
                if not len(n):
                    break
            start = np.concatenate(([True], (gram[1:] != gram[:-1]) | (100 * n[:-1] < percent * n[1:]))) if len(n) else np.empty(0, bool)
            first = np.flatnonzero(start)
            key = mix64(np.add.reduceat(mix64(sig * _ODD), first)) if len(first) else np.empty(0, np.uint64)
            key = np.repeat(key, np.diff(first, append=len(n)))
            by = np.lexsort((flag, sig, key))
            key, sig, n, flag = key[by], sig[by], n[by], flag[by]
            last = np.flatnonzero(np.concatenate(((key[1:] != key[:-1]) | (sig[1:] != sig[:-1]), [True]))) if len(key) else np.empty(0, np.int64)
            many = np.diff(last, prepend=-1)
            key, sig, n, flag = key[last], sig[last], n[last], flag[last]  # flagged in any, for that one sorts last
        return pd.DataFrame({"list": key.view(np.int64), "head": sig.view(np.int64), "n": n, "flag": flag, "grams": many})

    return run


def gram_counts(grams: np.ndarray, counters: int = COUNTERS) -> np.ndarray:
    """Grams of a set by hash bucket (a power of two); the sum of the lesser counts of two sets is at least what they share."""
    return np.bincount((grams & np.uint64(counters - 1)).astype(np.int64), minlength=counters)


def parities(grams: np.ndarray) -> np.ndarray:
    """The parities of the counts by hash bucket, as 64-bit words: one to two buckets a gram."""
    buckets = max(WORD_BITS, 1 << (len(grams) - 1).bit_length())
    return np.packbits((gram_counts(grams, buckets) & 1).astype(np.uint8), bitorder="little").view("<u8")


def folded(words: np.ndarray, to: int) -> np.ndarray:
    """Parities of half as many buckets, again and again, until ``to`` words are left; of one set or a row for each."""
    while (n := words.shape[-1]) > to:
        words = words[..., : n // 2] ^ words[..., n // 2 :]
    return words


def least_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Grams by which two sets differ at least, by their parities: a bucket whose parities differ has one in it."""
    n = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(folded(x, n) ^ folded(y, n)).sum(-1, dtype=np.int64)


def most_apart(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Grams by which similar sets of sizes n and m differ at most."""
    return n + m - 2 * -(-percent * (n + m) // (100 + percent))


def _sets(order: Order):
    """(doc, n, matches, prefix, the other grams in order) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [order.arrange(gram_set(t)) for t in b["text"].to_pylist()]
            grams, matches = [x[0] for x in found], [x[2] for x in found]
            ends = [len(g) - int(need(len(g), order.percent)) + l for g, l in zip(grams, matches, strict=True)]  # noqa: E741
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(g) for g in grams], pa.int64()), pa.array(matches, pa.int32()), pa.array([g[:k].tobytes() for g, k in zip(grams, ends, strict=True)], pa.binary()), pa.array([g[k:].tobytes() for g, k in zip(grams, ends, strict=True)], pa.binary())],
                ["doc", "n", "matches", "prefix", "rest"],
            )
        released()

    return run


def _near(percent: int):
    """Pairs (a, b, known) that may be similar by their parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            apart = np.array([least_apart(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(b["a_parities"].to_pylist(), b["b_parities"].to_pylist(), strict=True)], np.int64)
            yield b.select(["a", "b", "known"]).filter(pa.array(apart <= most_apart(b["a_n"].to_numpy(), b["b_n"].to_numpy(), percent)))

    return run


def _promising(percent: int):
    """Pairs whose prefixes share as many grams as the less extended of them asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on = []
            for x, y, n, m, i, j in zip(*(b[c].to_pylist() for c in ("a_prefix", "b_prefix", "a_n", "b_n", "a_matches", "b_matches")), strict=True):
                l = min(i, j)  # noqa: E741
                x, y = np.frombuffer(x, np.uint64)[: n - int(need(n, percent)) + l], np.frombuffer(y, np.uint64)[: m - int(need(m, percent)) + l]
                on.append(100 * min(n, m) >= percent * max(n, m) and len(np.intersect1d(x, y, assume_unique=True)) >= l)
            yield b.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    return run


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Values that two sorted arrays share, with repeats."""
    both = np.sort(np.concatenate((np.unique(x), np.unique(y))))
    n = int((both[1:] == both[:-1]).sum())
    return n + (len(x) - len(np.unique(x))) + (len(y) - len(np.unique(y)))  # at least what the whole hashes share


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, n, parities) of each document."""
    for b in batches:
        sets = [gram_set(t) for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([parities(s).tobytes() for s in sets], pa.binary())], ["doc", "n", "parities"])
    released()


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, upper halves of the hashes in order) of each document."""
    for b in batches:
        halves = [(gram_set(t) >> np.uint64(32)).astype(np.uint32).tobytes() for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(halves, pa.binary())], ["doc", "halves"])
    released()


def _judge(percent: int):
    """Pairs that may be similar by the halves of their hashes; ``sure`` if by more than chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on, sure = [], []
            for x, y in zip(b["a_halves"].to_pylist(), b["b_halves"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = _shared(x, y)
                least = -(-percent * (len(x) + len(y)) // (100 + percent))
                on.append(both >= least)
                sure.append(both >= least + CHANCE)
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(sure, pa.bool_())], ["a", "b", "sure"]).filter(pa.array(on, pa.bool_()))

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on = []
            for x, y in zip(b["a_grams"].to_pylist(), b["b_grams"].to_pylist(), strict=True):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                on.append(100 * both >= percent * ((len(x) + len(y)) // 8 - both))
            yield b.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    return run


def _possible(percent: int):
    """Of queries and a block of sets those that may be similar to one of another component, by their parities (kind 0: query, 1: set)."""

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        names = ["f", "k", "s", "doc", "comp"]
        if not len(queries) or not len(members):
            return pd.DataFrame({"kind": pd.Series(dtype="int32"), **{c: pd.Series(dtype="int64") for c in names}})
        # In order of size, so that sets of like size, and sets with as many words of parities, stand together.
        members = members.sort_values("n", ignore_index=True)
        sizes, comps = members["n"].to_numpy(), members["comp"].to_numpy()
        words = members["parities"].map(len).to_numpy() // 8
        starts = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        stacks = [(lo, hi, np.frombuffer(b"".join(members["parities"][lo:hi]), "<u8").reshape(hi - lo, -1)) for lo, hi in zip(starts, np.append(starts[1:], len(words)), strict=True)]
        asked, met = np.zeros(len(queries), bool), np.zeros(len(members), bool)
        for i, (raw, n, comp) in enumerate(zip(queries["parities"], queries["n"], queries["comp"], strict=True)):
            own = np.frombuffer(raw, "<u8")
            first, last = np.searchsorted(sizes, -(-percent * n // 100), "left"), np.searchsorted(sizes, 100 * n // percent, "right")
            for lo, hi, rows in stacks:
                lo, hi, start = max(lo, first), min(hi, last), lo
                if lo >= hi:
                    continue
                on = (least_apart(rows[lo - start : hi - start], own) <= most_apart(n, sizes[lo:hi], percent)) & (comps[lo:hi] != comp)
                asked[i] |= on.any()
                met[lo:hi] |= on
        out = pd.concat([queries.loc[asked, names].assign(kind=0), members.loc[met, names].assign(kind=1)])
        return out[["kind", *names]].astype({"kind": "int32"})

    return run


def _verify_block(percent: int):
    """Queries against one block of sets: shared grams are counted through the block's inverted lists."""

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        if len(queries) and len(members):
            sets = [np.frombuffer(g, np.uint64) for g in members["grams"]]
            sizes = np.array([len(s) for s in sets])
            grams = np.concatenate(sets)
            by = np.argsort(grams, kind="stable")
            owner, grams = np.repeat(np.arange(len(sets)), sizes)[by], grams[by]
            ids, comps = members["doc"].to_numpy(), members["comp"].to_numpy()
            for doc, comp, raw in zip(queries["doc"], queries["comp"], queries["grams"], strict=True):
                q = np.frombuffer(raw, np.uint64)
                lo, hi = np.searchsorted(grams, q, "left"), np.searchsorted(grams, q, "right")
                n = hi - lo
                ends = np.cumsum(n)
                hits = owner[np.arange(ends[-1]) + np.repeat(lo - ends + n, n)]
                both = np.bincount(hits, minlength=len(sets))
                on = (100 * both >= percent * (len(q) + sizes - both)) & (comps != comp)
                for c in np.unique(comps[on]):  # one link to each component suffices
                    a.append(doc)
                    b.append(ids[on & (comps == c)][0])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def _of_sets(rows: DataFrame, key: str, sets: DataFrame, columns: dict) -> DataFrame:
    """Written narrow rows with columns of the set that ``key`` names; the sets stay in place while the rows can be broadcast."""
    side = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
    return sets.select(F.col("doc").alias(key), *[c.alias(name) for name, c in columns.items()]).join(side, key)


def _both(pairs: DataFrame, sets: DataFrame, columns: dict) -> DataFrame:
    """Written pairs (a, b) with columns of both sets (a_name, b_name)."""
    with_b = _of_sets(pairs, "b", sets, {f"b_{k}": c for k, c in columns.items()})
    firsts = materialize(pairs.select("a").distinct(), sets.sparkSession, "join-pivots")
    return with_b.join(_of_sets(firsts, "a", sets, {f"a_{k}": c for k, c in columns.items()}), "a")


class Sets:
    """The documents' sets: ``table`` has the parities of all that are in a list; the rest is made again from the texts, for few."""

    def __init__(self, rows: DataFrame, docs: DataFrame, order: Order, repeated: bool) -> None:
        self.rows, self.order, self.repeated = rows, order, repeated
        self.table = self._made(docs, _parities, "doc long, n long, parities binary", "join-sets")

    def _made(self, docs: DataFrame, kind, schema: str, label: str) -> DataFrame:
        """What ``kind`` makes of the texts of documents in a written table, written."""
        found = semi_join(self.rows, docs).mapInArrow(kind, schema)
        return materialize(found.dropDuplicates(["doc"]) if self.repeated else found, self.rows.sparkSession, label)

    def _of(self, columns: tuple[DataFrame, ...], kind, schema: str, label: str) -> DataFrame:
        docs = reduce(DataFrame.union, columns).toDF("doc_id").distinct()
        docs = materialize(docs, self.rows.sparkSession, "join-docs")
        found = self._made(docs, kind, schema, label)
        discard(docs)
        return found

    def halves(self, *columns: DataFrame) -> DataFrame:
        """(doc, halves) of the documents in one-column tables, written."""
        return self._of(columns, _halves, "doc long, halves binary", "join-halves")

    def whole(self, *columns: DataFrame) -> DataFrame:
        """(doc, n, matches, prefix, rest) of the documents in one-column tables, written."""
        return self._of(columns, _sets(self.order), "doc long, n long, matches int, prefix binary, rest binary", "join-whole")


def _links_of(pairs: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """The similar ones of written candidate pairs (a, b, known: shared prefix postings met), written.

    Pairs that differ by too many grams by their parities end here.  Of the
    others, those that are not known to share enough are tested by their
    prefixes; then sets are compared by halves of their hashes, and where that
    is not sure, by all of them.
    """
    spark = pairs.sparkSession
    like = _both(pairs, sets.table, {"n": F.col("n"), "parities": F.col("parities")}).select("a", "b", "known", "a_n", "b_n", "a_parities", "b_parities")
    like = materialize(like.mapInArrow(_near(percent), "a long, b long, known long"), spark, "join-like")
    some = like.where(F.col("known") >= MOST_MATCHES).select("a", "b")
    few = materialize(like.where(F.col("known") < MOST_MATCHES).select("a", "b"), spark, "join-few")
    spent = [few]
    if few.take(1):
        whole = sets.whole(few.select("a"), few.select("b"))
        some = some.union(_both(few, whole, {name: F.col(name) for name in ("prefix", "n", "matches")}).mapInArrow(_promising(percent), "a long, b long"))
        spent.append(whole)
    some = materialize(some, spark, "join-promising")
    discard(*spent, like)
    halves = sets.halves(some.select("a"), some.select("b"))
    judged = _both(some, halves, {"halves": F.col("halves")}).select("a", "b", "a_halves", "b_halves").mapInArrow(_judge(percent), "a long, b long, sure boolean")
    judged = materialize(judged, spark, "join-judged")
    discard(some, halves)
    found = judged.where("sure").select("a", "b")
    near = materialize(judged.where("NOT sure").select("a", "b"), spark, "join-near")
    spent = [near]
    if near.take(1):
        whole = sets.whole(near.select("a"), near.select("b"))
        found = found.union(_both(near, whole, {"grams": F.concat("prefix", "rest")}).select("a", "b", "a_grams", "b_grams").mapInArrow(_verify(percent), "a long, b long"))
        spent.append(whole)
    found = materialize(found, spark, "join-verified")
    discard(*spent, judged)
    return found


def _labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The lists with the component of each document, a join with the narrow table of those that have links."""
    labels = materialize(components(links), lists.sparkSession, "join-labels")
    side = F.broadcast(labels) if labels.count() <= BROADCAST_ROWS else labels
    return lists.join(side, lists["doc"] == F.col("node"), "left").withColumn("comp", F.coalesce("component", "doc")).drop("node", "component")


def _rest(lists: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """Links across components that no pivot has tested, by queries against blocks; written."""
    spark = lists.sparkSession
    per_comp = lists.groupBy("list", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_lists = per_comp.groupBy("list").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps")).where("comps > 1 AND n > 2").select("list", "main")
    rest = materialize(lists.join(open_lists, "list"), spark, "join-rest")
    # Sets of one family (the best pivot they have met) share blocks, so that a list meets few blocks.
    family = rest.groupBy("doc", "comp", "n").agg(F.max("pivot")["doc"].alias("family"))
    blocks = family.groupBy("family").agg(F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).alias("blocks"))
    placed = materialize(family.join(blocks, "family").select("doc", "comp", "family", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block")), spark, "join-blocks")
    met = rest.join(placed.select("doc", "family", "block"), "doc").select("list", "family", "block").distinct()
    asked = rest.where("comp != main").select("list", F.col("doc").alias("query"), F.col("comp").alias("query_comp"), F.col("n").alias("query_n"))
    tests = materialize(asked.join(met, "list").select("query", "query_comp", "query_n", "family", "block").distinct(), spark, "join-tests")
    salts = materialize(tests.groupBy("family", "block").agg(F.greatest(F.ceil(F.sum("query_n") / QUERIES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).alias("salts")), spark, "join-salts")
    asking = tests.join(salts, ["family", "block"]).select("family", "block", F.pmod(F.xxhash64("query"), F.col("salts")).alias("salt"), "query", "query_comp")
    asking = materialize(asking, spark, "join-asking")
    standing = placed.join(salts, ["family", "block"]).select("family", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.col("doc").alias("member"), "comp")
    standing = materialize(standing, spark, "join-standing")
    keys = [F.col("family").alias("f"), F.col("block").alias("k"), F.col("salt").alias("s")]
    left = asking.select(*keys, F.col("query").alias("doc"), F.col("query_comp").alias("comp"))
    right = standing.select(*keys, F.col("member").alias("doc"), F.col("comp").alias("comp"))
    possible = materialize(_cogroup(left, right, sets.table, {"n": F.col("n"), "parities": F.col("parities")}).applyInPandas(_possible(percent), "kind int, f long, k long, s long, doc long, comp long"), spark, "join-possible")
    whole = sets.whole(possible.select("doc"))
    found = materialize(_cogroup(possible.where("kind = 0").drop("kind"), possible.where("kind = 1").drop("kind"), whole, {"grams": F.concat("prefix", "rest")}).applyInPandas(_verify_block(percent), "a long, b long"), spark, "join-blocked")
    discard(rest, placed, tests, salts, asking, standing, possible, whole)
    return found


def _cogroup(left: DataFrame, right: DataFrame, sets: DataFrame, columns: dict):
    """Two narrow tables (f, k, s, doc, comp), each with columns of its docs' sets, grouped together by f, k and s."""
    sides = []
    for rows in (left, right):
        found = _of_sets(rows, "doc", sets, columns)
        sides.append(found.select(*[F.col(c).alias(c) for c in ("f", "k", "s", "doc", "comp", *columns)]).groupBy("f", "k", "s"))
    return sides[0].cogroup(sides[1])


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = text_rows(docs, id_col, text_col)
    profile = materialize(rows.mapInArrow(_profile, "kind int, doc_id long, n long, sig binary, head long"), spark, "join-profile")
    hot = profile.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "doc_id").limit(HOT_GRAMS).toArrow()
    order = Order(hot["doc_id"].to_numpy().view(np.uint64), hot["n"].to_numpy(), percent)
    members = profile.where("kind = 0").select("doc_id", "n", "sig", "head")
    total = members.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    buckets = max(12, int(total // PER_BUCKET) + 1)
    packed = rows.mapInArrow(_postings(order, buckets), "bucket long, heads binary, sizes binary, grams binary")
    posted = packed.groupBy("bucket").applyInPandas(_lists(buckets, percent), "list long, head long, n long, flag boolean, grams long")
    firsts = members.where("n > 0 AND doc_id IS NOT NULL").groupBy("head").agg(F.min("doc_id").alias("doc"))
    posted = posted.groupBy("list", "head").agg(F.min("n").alias("n"), F.max("flag").alias("flag"), F.sum("grams").alias("grams")).join(firsts, "head")
    posted = materialize(posted.select("list", "doc", "n", "flag", "grams"), spark, "join-posted")
    often = posted.groupBy("doc").agg(F.sum("grams").alias("often"))
    ranked = posted.join(often, "doc")
    pivot = F.max(F.struct("often", "doc", "n", "flag")).alias("pivot")
    # A list without a flag holds no pair that is not in another list, too.
    pivots = ranked.groupBy("list").agg(pivot, F.count(F.lit(1)).alias("in_list"), F.max("flag").alias("any")).where("in_list > 1 AND any").drop("in_list", "any")
    lists = materialize(ranked.drop("often").join(pivots, "list"), spark, "join-lists")
    discard(posted)
    wanted = materialize(lists.select(F.col("doc").alias("doc_id")).distinct(), spark, "join-wanted")
    sets = Sets(rows, wanted, order, bool(members.groupBy("doc_id").count().where("count > 1").take(1)))

    def candidates(with_pivots: DataFrame) -> DataFrame:
        """Pairs of a pivot with the other sets of its lists that size and flags allow."""
        p, own_smaller = F.col("pivot"), F.col("n") <= F.col("pivot.n")
        like = 100 * F.least("n", "pivot.n") >= percent * F.greatest("n", "pivot.n")
        flagged = (own_smaller & F.col("flag")) | ((F.col("pivot.n") <= F.col("n")) & F.col("pivot.flag"))
        # Whether a list flags the pair or not, its grams are shared; a pair needs one list that does.
        met = with_pivots.where((p["doc"] != F.col("doc")) & like).groupBy(p["doc"].alias("a"), F.col("doc").alias("b")).agg(F.sum("grams").alias("known"), F.max(flagged).alias("flagged"))
        return materialize(met.where("flagged").drop("flagged"), spark, "join-pairs")

    first = candidates(lists)
    links = _links_of(first, sets, percent)
    again = _labelled(lists, links)
    spot = F.xxhash64(F.lit("round 2"), "doc").alias("spot")  # lists of one family mostly agree on it
    at_random = again.groupBy("list").agg(F.max(F.struct(spot, "doc", "n", "flag", "comp")).alias("pivot"), F.count(F.lit(1)).alias("in_list")).where("in_list > 2").drop("in_list")
    second = candidates(again.drop("pivot").join(at_random, "list").where(F.col("comp") != F.col("pivot.comp")))
    links = materialize(links.union(_links_of(second, sets, percent)), spark, "join-links")
    links = materialize(links.union(_rest(_labelled(lists, links), sets, percent)), spark, "join-links")
    discard(first, second, wanted, lists, sets.table)

    labels = components(links)
    classes = members.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    of_class = members.join(labels, members["doc_id"] == labels["node"]).select("sig", "component").distinct()
    joined = classes.join(of_class, "sig", "left")
    least = joined.where("component IS NOT NULL").groupBy(F.col("component").alias("of")).agg(F.min("first").alias("least"))
    joined = materialize(joined.join(least, F.col("component") == F.col("of"), "left").select(F.col("sig").alias("of_sig"), F.coalesce("least", "first").alias("found")), spark, "join-classes")
    out = members.join(joined, (members["sig"] == joined["of_sig"]) & (members["n"] > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("found")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of linked documents the one with the smallest id, with all its columns.

    Rows without an id stay; rows that share an id are one document.
    """
    spark = docs.sparkSession
    found = jaccard_components(docs, id_col, text_col)
    dropped = materialize(found.where("doc_id != component_id").select(F.col("doc_id").alias("_dropped")).distinct(), spark, "join-dropped")
    return anti_join(docs, dropped, id_col)
