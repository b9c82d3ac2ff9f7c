"""Packing: ids as the library gives them, sequences without gaps or overlaps, few of them, awkward rows."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscalflow.llm import packing as P
from fiscalflow.llm.common import materialize
from fiscalflow.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(rows):
    """(doc_id, piece, start, length, crc) by the library on whole texts."""
    t, out = library(), []
    for doc, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(doc, k, k * 4096, len(x), zlib.crc32(x.tobytes())) for k, x in enumerate(ids[i : i + 4096] for i in range(0, len(ids), 4096))]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def check(rows, out):
    got = [tuple(r) for r in out]
    assert sorted((r[:5] for r in got), key=key) == sorted(expected(rows), key=key)
    by = {}
    for r in got:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    return len(by)


def decreasing(sizes, cap):
    """Sequences that best-fit decreasing opens, by counts of gaps."""
    gaps, opened = [0] * (cap + 1), 0
    for s in sorted(sizes, reverse=True):
        g = next((g for g in range(s, cap) if gaps[g]), None)
        if g is None:
            g, opened = cap, opened + 1
        else:
            gaps[g] -= 1
        gaps[g - s] += 1
    return opened


def test_table(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = P.pack(docs, PATH).collect()
    used = check(rows, out)
    sizes = [r.length for r in out]
    assert used <= decreasing(sizes, 4096) + 1 and used <= 1.01 * -(-sum(sizes) // 4096) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aZéÀÿ×'\u0301İΣσ 1½²\n\t\u00a0\u3000日<|>endoftxsr.,!-\u1100\u1161", "<|endoftext|>", " 's", "'ll"]), max_size=60).map("".join), min_size=1, max_size=8))
def test_words_have_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    whole = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    found, begin = [], 0
    for ids, ends in P._encoder(PATH).encode(pa.array(texts)):
        for stop in ends.tolist():
            found.append(ids[begin:stop].tolist())
            begin = stop
        begin = 0
    assert found == whole


def test_heap_forgets_and_slices_do_not_matter(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(P, "CACHE", 10)
    monkeypatch.setattr(P, "SLICE", 40)
    texts = [" ".join(f"w{i * j % 37}" for j in range(i % 9)) for i in range(80)]
    encoder, found = P.Encoder(PATH), []
    for ids, ends in encoder.encode(pa.array(texts)):
        found += [x.tolist() for x in np.split(ids, ends)[:-1]]
    assert found == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def test_rounds_forget_the_words(spark):
    """The workers that encoded run the rounds: an encoder kept there holds memory that the executor needs."""
    import pyarrow as pa

    def kept(step):
        def run(batches):
            P._encoder(PATH)
            batches = list(batches)
            for _ in step(iter(batches)):
                pass
            yield pa.RecordBatch.from_arrays([pa.array([P._encoder.cache_info().currsize])], ["kept"])

        return run

    units = spark.createDataFrame([(True, 7, 1, None)], "is_piece boolean, size int, name long, slot int").coalesce(1)
    swept = spark.createDataFrame([(P.PIECE, 0, 0, 1, 7, None, None)], P._SWEPT).coalesce(1)
    assert [r.kept for r in units.mapInArrow(kept(P._sweep), "kept long").collect()] == [0]
    assert [r.kept for r in swept.mapInArrow(kept(P._numbered([], True)), "kept long").collect()] == [0]


@pytest.mark.parametrize("sizes", [[1500] * 900, [2049] * 50 + [2047] * 50, [4096, 4095, 1, 1], list(range(1, 400)), [7] * 5000 + [4000] * 20, [1]])
def test_places(spark, monkeypatch, sizes):
    monkeypatch.setattr(P, "PER_PART", 100)  # many partitions, so that leftovers meet across them
    pieces = materialize(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "key long, length int").repartition(3), spark, "t")
    by = {}
    for r in P.place(pieces).collect():
        by.setdefault(r.sequence_id, []).append((r.offset, sizes[r.key]))
    assert sum(map(len, by.values())) == len(sizes)
    for parts in by.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(by) <= decreasing(sizes, 4096) * 1.02 + 1


def test_leftovers_meet_nearest_first():
    assert P.meetings({0: (0, 3), 1: (1, 2), 2: (4, 0), 3: (1, 0)}) == [(1, 0, 0, 2, 1), (2, 0, 1, 1, 2), (2, 2, 0, 1, 2)]


def test_awkward_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(rows, P.pack(odd, PATH).collect())
    assert P.pack(empty, PATH).count() == 0


def test_sequences_hold_the_ids(spark, odd):
    pieces = P.encoded_pieces(odd, PATH, with_ids=True)
    placed = materialize(P.place(pieces), spark, "t")
    seqs = {r.sequence_id: r.ids for r in P.sequences(pieces, placed).collect()}
    for r in pieces.join(placed, "key").collect():
        assert list(seqs[r.sequence_id][r.offset : r.offset + r.length]) == list(r.ids)
    assert sum(map(len, seqs.values())) == pieces.groupBy().sum("length").first()[0]
