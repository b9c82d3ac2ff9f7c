import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fiscalflow.llm import dac_tokens as D
from fiscalflow.llm.id_heap import IdHeap
from fiscalflow.llm.queries import vocabulary
from fiscalflow.session import scratch_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.sampled_from([8, 16]), st.randoms())
def test_random_access_round_trip(values, width, rnd):
    ids = np.array(values, np.uint32)
    dac = D.Dac.encode(ids, width)
    assert dac.tokens(0, len(ids)).tolist() == values
    for _ in range(5):
        i, j = sorted((rnd.randint(0, len(ids)), rnd.randint(0, len(ids))))
        assert dac.tokens(i, j).tolist() == values[i:j]
        if values:
            k = rnd.randrange(len(values))
            assert dac.token(k) == values[k]


def test_small_ids_take_one_level():
    assert len(D.Dac.encode(np.arange(256)).chunks) == 1 and len(D.Dac.encode(np.arange(257)).chunks) == 2


def test_cached_pieces_are_the_librarys_ids():
    library, cached = Tokenizer.from_file(vocabulary()), D.CachedTokenizer(vocabulary())
    rng = np.random.default_rng(1)
    signs = list("ab '\n\t\x1c\u0085 é日1.,!   ") + ["<|endoftext|>"]
    for _ in range(60):
        texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(40)] + ["", " ", "  "]
        for text, raw in zip(texts, cached.encode_batch(pa.array(texts)), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_with_odd_blanks_are_cut_like_others():
    """Signs are pieces of their own there, too; a special token's string is not cut."""
    cached = D.CachedTokenizer(vocabulary())
    texts = ["", "one,  two.\n three\u00a0 four", "a<|endoftext|>b c", " \u00a0é,\u3000x", ""]
    pieces, first = cached.pieces(pa.array(["left out", *texts, "left out"]).slice(1, len(texts)))
    assert [pieces.to_pylist()[i:j] for i, j in zip(first[:-1], first[1:], strict=True)] == [
        [], ["one", ", ", " two", ".\n", " three\u00a0", " four"], ["a<|endoftext|>b", " c"], [" \u00a0é,\u3000x"], [],
    ]


def test_pieces_of_several_batches_are_asked_once():
    """A full heap forgets what was seen once, not what is in use."""
    asked = []

    def ask(pieces):
        asked.extend(pieces)
        return np.array([int(p) for p in pieces for _ in range(int(p) % 3)], "<u4"), np.array([int(p) % 3 for p in pieces])

    heap = IdHeap(ask, 40)
    for k in range(50):
        pieces = [*range(10), *range(100 + 7 * k, 107 + 7 * k)]
        ids, n = heap.gather(pa.array(map(str, pieces)))
        assert ids.tolist() == [p for p in pieces for _ in range(p % 3)] and n.tolist() == [p % 3 for p in pieces]
        assert len(heap.number) <= 40
    assert all(asked.count(str(p)) == 1 for p in range(10))
    for k in range(100):  # more pieces in use than half of what fits
        heap.gather(pa.array([str(p % 35) for p in range(k, k + 30)]))
        assert len(heap.number) <= 50


def check(rows, got):
    library, start = Tokenizer.from_file(vocabulary()), 0
    for (doc, text), r in zip(rows, got, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, D.END]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_whole_table(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    check(rows, D.write_and_read(docs, vocabulary()).orderBy("doc_id").collect())


def test_token_at_any_place(spark, small):
    path = scratch_path(spark, "test-dac")
    D.write_tokens(small, vocabulary(), path)
    everything = np.concatenate([np.frombuffer(r.ids, "<u4") for r in D.read_documents(spark, path).orderBy("start").collect()])
    blocks = D.placed_blocks(spark, path)
    for place in (0, 1, 12_345, len(everything) - 1):
        assert [tuple(r) for r in D.token_at(blocks, place).collect()] == [(place, everything[place])]
    assert D.token_at(blocks, len(everything)).count() == 0


def test_odd_rows(odd, empty):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    check(rows, D.write_and_read(odd, vocabulary()).orderBy("start").collect())
    assert D.write_and_read(empty, vocabulary()).count() == 0
