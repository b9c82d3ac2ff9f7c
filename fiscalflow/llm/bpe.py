"""Byte-level BPE by a backtracking encoder, and decoding by an offset table.

An Aho-Corasick automaton of all tokens, written backwards, goes over the word
backwards once and so gives the longest token that starts at each place.  The
encoder walks the word with these matches and accepts a token only if it may stand after the last one: a pair of tokens is
compatible when the merges, taken apart again from the boundary outwards, would
never have joined across it.  On an incompatible pair it tries the next shorter
token that starts there; when none is left it takes the last token back and
marks the boundary as dead.  Each boundary dies once at most, so the work is
linear in the word, and the tokens are exactly those that the merges give.

Words are cut from texts by the tokenizer's pattern.  A space before a
non-blank always starts a new word, and so does a sign after a letter or
number, so texts are split there first and every distinct piece is encoded once per worker, in a heap of bounded size.

Defined results: null and empty texts have no ids and decode to the empty
text; a special token's string in a text becomes its id, as in the library;
ids that do not form UTF-8 decode with replacement characters; repeated rows
are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from fiscalflow.llm.common import arrow_rows, binary_column, released, text_rows
from fiscalflow.llm.id_heap import IdHeap

#: The word pattern of byte-level BPE vocabularies of this family (a fixed value, as published with them).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct pieces that a task remembers at most (about 150 bytes each); half as many words of longer pieces, a quarter as many token pairs.
CACHE = 300_000
#: Documents in an Arrow batch, bytes of text encoded at a time, about.
BATCH, SLICE = 512, 1 << 19

#: Marks a piece that has no space before it; texts that hold it are split at spaces only.
INNER = "\x01"

_BLANK_AFTER_SPACE = re.compile(r" (?=\s)")
_BEFORE_WORD = re.compile(r" (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in these vocabularies, by their published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: Packers of a few 32-bit numbers.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _pack(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()


def pieces_of(text: str) -> tuple[str, list[str]]:
    """The text up to its first word-starting space, and what follows each such space (without it)."""
    parts = _BEFORE_WORD.split(text) if _BLANK_AFTER_SPACE.search(text) else text.split(" ")
    return parts[0], parts[1:]


class Bpe:
    """Encoder and decoder of a byte-level BPE vocabulary file (JSON with ``vocab``, ``merges``, ``added_tokens``)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_alphabet()
        to_bytes = lambda s: bytes(back[c] for c in s)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        #: Tokens by rank: the 256 bytes, then the merges in order.
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(256)]
        self.bytes_of: list[bytes] = [bytes([i]) for i in range(256)]
        rank = {b: i for i, b in enumerate(self.bytes_of)}
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b = to_bytes(left), to_bytes(right)
            pair, whole = (rank[a], rank[b]), a + b
            self.joined.setdefault(pair, len(self.parts))
            if whole not in rank:
                rank[whole] = len(self.parts)
            self.parts.append(pair)
            self.bytes_of.append(whole)
        known = {to_bytes(s): i for s, i in vocab.items() if all(c in back for c in s)}
        self.id_of = [known.get(b, -1) for b in self.bytes_of]
        # A token that the merges never make of its own bytes cannot occur.
        self.rank = {b.decode("latin-1"): r for b, r in rank.items() if r < 256 or self.stay_apart(*self.parts[r], r)}
        self.matches = ahocorasick.Automaton()
        for s, r in self.rank.items():
            self.matches.add_word(s[::-1], r)
        self.matches.make_automaton()
        #: For each rank the longest shorter token that the token starts with, or -1.
        self.shorter = [-1] * len(self.parts)
        for s, r in self.rank.items():
            self.shorter[r] = next((self.rank[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.rank), -1)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_split = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        size = 1 + max([*vocab.values(), *self.special.values()])
        table = [b""] * size
        for b, i in known.items():
            table[i] = b
        for s, i in self.special.items():
            table[i] = s.encode()
        #: The decoder: token i is heap[offsets[i]:offsets[i + 1]].
        self.offsets = np.concatenate(([0], np.cumsum([len(b) for b in table]))).astype(np.int64)
        self.heap = np.frombuffer(b"".join(table), np.uint8)
        self.pair_ok: dict[tuple[int, int], bool] = {}
        self.word_ids: dict[str, bytes] = {}
        self.heap_of_pieces = IdHeap(self._ask, CACHE)
        self.decimals = [str(i) for i in range(size)]

    def compatible(self, left: int, right: int) -> bool:
        """``stay_apart``, remembered."""
        key = (left, right)
        if (ok := self.pair_ok.get(key)) is None:
            if len(self.pair_ok) >= CACHE // 4:
                self.pair_ok.clear()
            ok = self.pair_ok[key] = self.stay_apart(left, right, len(self.parts))
        return ok

    def stay_apart(self, left: int, right: int, before: int) -> bool:
        """Whether merges of a rank under ``before`` leave ``left`` and ``right`` side by side.

        Undo the later of the two last merges at the boundary, again and
        again; the pair fails if the tokens then at the boundary have a merge
        of their own that would have come before the one just undone.
        """
        while self.joined.get((left, right), before) >= before:
            if left < 256 and right < 256:
                return True
            if left > right:
                before, left = left, self.parts[left][1]
            else:
                # Equal ranks merge from the left, so the same merge across the boundary would have come first.
                before, right = right + 1, self.parts[right][0]
        return False

    def encode_word(self, word: bytes) -> list[int]:
        """Ranks of the tokens of one word."""
        s = word.decode("latin-1")
        bytes_of, pair_ok, shorter = self.bytes_of, self.pair_ok, self.shorter
        out: list[int] = []
        dead: set[int] = set()
        at, end = 0, len(s)
        longest = self.longest_matches(s)
        token = longest[0] if end else -1
        while at < end:
            stop = at + len(bytes_of[token])
            ok = stop not in dead
            if ok and out:
                last = out[-1]
                ok = pair_ok.get((last, token))
                if ok is None:
                    ok = self.compatible(last, token)
            if ok:
                out.append(token)
                at = stop
                if at < end:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= len(bytes_of[token])
        return out

    def longest_matches(self, s: str) -> list[int]:
        """The longest token that starts at each place: of the matches that end at a place of the word written backwards the first."""
        found = [-1] * len(s)
        last = len(s)
        for i, r in self.matches.iter(s[::-1]):
            if i != last:
                found[-1 - i] = r
                last = i
        return found

    def encode_piece(self, piece: str) -> bytes:
        """Ids (little-endian, 32 bits) of a text that starts and ends at word boundaries."""
        found: list[bytes] = []
        parts = self.special_split.split(piece) if self.special_split and self.special_split.search(piece) else [piece]
        for part in parts:
            if part in self.special:
                found.append(_PACK[1](self.special[part]))
                continue
            words = self.words.findall(part)
            for word in words:
                if (known := self.word_ids.get(word)) is None:
                    ranks = self.encode_word(word.encode("utf-8", "surrogatepass"))
                    known = _pack([self.id_of[r] for r in ranks])
                    if len(words) > 1:  # else the heap of pieces remembers it
                        self.word_ids[word] = known
                found.append(known)
        return found[0] if len(found) == 1 else b"".join(found)

    def _ask(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces, which follow a space unless they are marked, how many of each)."""
        if len(self.word_ids) > CACHE // 2:
            self.word_ids.clear()
        found = [self.encode_piece(p[1:] if p[:1] == INNER else " " + p) for p in pieces]
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def encode_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each of an array of texts."""
        sizes = pc.binary_length(texts).to_numpy()
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=0)).tolist()
        cuts = [0, *(c for c in cuts if c), len(texts)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield from self._encode_slice(texts.slice(lo, hi - lo))

    def _encode_slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        # Texts with blanks after a space are cut one by one: there a space may belong to the piece before it.
        special = "|".join([INNER, *map(re.escape, self.special)])
        odd = pc.match_substring_regex(texts, rf" [\s\p{{Z}}\x0b\x1c-\x1f\x85]|{special}").to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        texts = texts.take(pa.array(order))
        plain = len(texts) - int(odd.sum())
        parted = pc.replace_substring_regex(texts.slice(0, plain), r"([\p{L}\p{N}])([^\s\p{L}\p{N}\p{Z}\x0b\x1c-\x1f\x85])", rf"\1 {INNER}\2")
        lists = pc.split_pattern(parted, " ")
        if plain < len(texts):
            # A piece that begins with the mark itself would be taken for one without a space: such a text is one piece.
            own = [(t, []) if any(x[:1] == INNER for x in tails) else (head, tails) for t in texts.slice(plain).to_pylist() for head, tails in [pieces_of(t)]]
            lists = pa.concat_arrays([lists, pa.array([[head, *tails] for head, tails in own], pa.list_(pa.string()))])
        flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        is_tail = np.ones(len(flat), bool)
        is_tail[offsets[:-1]] = False
        heads = [self.encode_piece(h) if h else b"" for h in flat.take(pa.array(offsets[:-1])).to_pylist()]
        ids, n = self.heap_of_pieces.gather(flat.filter(pa.array(is_tail)))
        ends = np.concatenate(([0], np.cumsum(n)))[offsets - np.arange(len(offsets))].tolist()
        back = np.argsort(order).tolist()
        for k in back:
            yield np.frombuffer(heads[k] + ids[ends[k] : ends[k + 1]].tobytes(), "<u4")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return next(self.encode_batch(pa.array([text])))

    def forget(self) -> None:
        """Drop what a task has remembered: a worker lives on, and other operators need its memory."""
        self.heap_of_pieces, self.word_ids, self.pair_ok = IdHeap(self._ask, CACHE), {}, {}
        released()

    def decimal(self, ids: np.ndarray) -> str:
        """Ids as decimal numbers joined by commas."""
        return ",".join(map(self.decimals.__getitem__, ids.tolist()))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, gathered from the heap by the offset table."""
        ids = ids.astype(np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.heap[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> Bpe:
    """One codec per worker and vocabulary."""
    bpe = Bpe(path)
    released()
    return bpe


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit integers) of every row; one narrow pass."""
    arrow_rows(docs.sparkSession, BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], binary_column([ids.tobytes() for ids in bpe.encode_batch(b["text"].cast(pa.string()))])], ["doc_id", "ids"])
        bpe.forget()

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows of ``encode``; null ids are an empty text."""
    arrow_rows(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([bpe.decode(np.frombuffer(x or b"", "<u4")) for x in b["ids"].to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", content: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, and decoded again from the ids.

    With ``content`` also ids (little-endian unsigned 32-bit integers) and text (decoded).
    """
    arrow_rows(docs.sparkSession, BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()  # what other operators have left in this worker
        bpe = load(path)
        for b in batches:
            done, held, rows = 0, 0, []
            for ids in bpe.encode_batch(b["text"].cast(pa.string())):
                text = bpe.decode(ids)
                rows.append((len(ids), hashlib.sha256(bpe.decimal(ids).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), *([ids.tobytes(), text] if content else [])))
                held += len(text)
                if held >= SLICE or done + len(rows) == len(b):  # a few texts at a time: a batch may hold long ones
                    made = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
                    yield pa.RecordBatch.from_arrays([b["doc_id"].slice(done, len(rows)), *made], [c.split()[0] for c in schema.split(", ")])
                    done, held, rows = done + len(rows), 0, []
        bpe.forget()

    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary, text string" if content else "")
    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)
