import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fiscalflow.llm import bpe
from fiscalflow.llm.queries import vocabulary

TEXTS = ["", " ", "  a", "a  b \n c\t d ", "<|endoftext|>x <|endoftext|> y", "it's I'LL", "\x1c a\x1d\x1eb \x1f", "日本語 😀😀", "a" * 300, "   \n\n  x", "a\u0085b \u0085", " x   y", "٣٤ 123"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Bpe(vocabulary())


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="ab '\n\té日1\x01<|endoftext|>.,!  ", max_size=60)))
def test_same_ids_and_text_as_the_library(library, codec, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text).tolist() == ids
    assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_listed_texts(library, codec):
    for text in TEXTS:
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_backtracking_on_a_small_vocabulary(tmp_path):
    """Longest match first would be wrong here: merges make ab, then cd, never abc."""
    import json

    letters = {chr(256 + i) if i < 33 else chr(i): i for i in range(0)}
    alphabet = {c: i for i, c in enumerate(sorted(bpe.byte_alphabet()))} | letters
    merges = [["a", "b"], ["c", "d"], ["ab", "c"], ["b", "c"], ["a", "a"], ["aa", "a"]]
    vocab = dict(alphabet)
    for x, y in merges:
        vocab.setdefault(x + y, len(vocab))
    path = tmp_path / "v.json"
    spec = {"version": "1.0", "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}, "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "vocab": vocab, "merges": merges}}
    path.write_text(json.dumps(spec))
    library, codec = Tokenizer.from_file(str(path)), bpe.Bpe(str(path))
    rng = np.random.default_rng(0)
    for _ in range(500):
        text = "".join(rng.choice(list("abcd"), rng.integers(0, 12)))
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_whole_table(library, docs):
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_and_decode(docs, vocabulary()).collect()}
    assert got == want


def test_odd_rows(odd, empty):
    path = vocabulary()
    texts = {(r.doc_id, r.text or "") for r in odd.collect()}
    encoded = bpe.encode(odd, path)
    assert encoded.count() == odd.count()
    assert {(r.doc_id, r.text) for r in bpe.decode(encoded, path).collect()} == texts
    assert all(r.n_tokens == 0 for r in bpe.encode_and_decode(odd, path).collect() if r.doc_id in (2, 3))
    assert bpe.encode_and_decode(empty, path).count() == 0


def test_work_is_linear_in_a_long_word(library, codec):
    """Matches and backtracking steps a letter stay the same from 10^4 to 10^6 letters; ids are the library's."""
    rng = np.random.default_rng(4)

    class Counted(list):
        taken = 0

        def __getitem__(self, i):
            self.taken += 1
            return super().__getitem__(i)

    per_letter = []
    for n in (10_000, 100_000, 1_000_000):
        word = bytes(rng.integers(97, 123, n, dtype=np.uint8))
        matches = sum(1 for _ in codec.matches.iter(word.decode()[::-1]))
        kept, codec.shorter = codec.shorter, Counted(codec.shorter)
        ranks = codec.encode_word(word)
        steps, codec.shorter = codec.shorter.taken, kept
        per_letter.append((matches + steps) / n)
        assert b"".join(codec.bytes_of[r] for r in ranks) == word
        if n == 10_000:
            assert [codec.id_of[r] for r in ranks] == library.encode(word.decode(), add_special_tokens=False).ids
    assert max(per_letter) < 1.1 * min(per_letter) < 8


def test_longest_matches_are_the_longest(codec):
    rng = np.random.default_rng(5)
    for _ in range(200):
        s = "".join(rng.choice(list(" theinatorsé'\n1"), rng.integers(0, 25))).encode().decode("latin-1")
        want = [max((r for r in (codec.rank.get(s[i:j]) for j in range(i + 1, len(s) + 1)) if r is not None), key=lambda r: len(codec.bytes_of[r])) for i in range(len(s))]
        assert codec.longest_matches(s) == want


def test_rows_leave_a_few_at_a_time(spark, monkeypatch):
    """Long texts and their ids are not held until the end of a batch, and rows keep their ids."""
    import pyarrow as pa

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(bpe, "text_rows", lambda *a: Rows())
    docs = spark.createDataFrame([], "doc_id long, text string")
    texts = [f"texto {i} " * 60_000 for i in range(9)]
    out = list(bpe.encode_and_decode(docs, vocabulary(), content=True)(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": [t.encode() for t in texts]})])))
    assert len(out) > 1
    assert [(i, t) for b in out for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True)] == list(enumerate(texts))


def test_a_piece_of_one_word_is_remembered_once(codec):
    """The heap of pieces has its ids; only words of longer pieces are kept beside it."""
    codec.forget()
    codec.encode("alpha beta gamma beta")
    assert len(codec.heap_of_pieces.number) == 2 and not codec.word_ids
    codec.encode("x it's\nbeta")
    assert set(codec.word_ids) == {"'s", "\n", "beta"}
    codec.forget()
