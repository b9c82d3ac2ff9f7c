import hashlib

import numpy as np

from fiscalflow.llm import imatch as I


def in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode()))


def check(rows, got):
    rows = in_order(rows)
    want = []
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        want.append((doc, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = I.edit_report(docs).collect()
    check(rows, got)
    texts, prints = dict(rows), {}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == I.likeness(r.fingerprint, r.edited_fingerprint)
    assert np.mean([r.near_edited for r in got]) > 0.45 and np.mean([r.near_next for r in got]) < 0.05
    lexicon = I.Lexicon(I.fit_lexicon(docs))
    assert all(lexicon.fingerprint(texts[r.doc_id]) == r.fingerprint for r in got[::50])


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(w for w, every in (("all", 1), ("third", 3), ("tenth", 10), ("once", 1000)) if i % every == 0)) for i in range(100)]
    got = I.fit_lexicon(spark.createDataFrame(rows, "doc_id long, text string"), least=2, share=0.5)
    assert got.tolist() == I.hashes({b"third", b"tenth"}).tolist()


def test_a_band_larger_than_the_sent_lexicon_is_whole(small, odd, monkeypatch):
    """Fingerprints do not depend on how many of the band's terms are sent to the tasks."""
    for docs, most in ((small, 20), (odd, 1)):
        want = sorted(map(str, I.edit_report(docs).collect()))
        monkeypatch.setattr(I, "LEXICON", most)
        assert I.split_band(I.fit_band(docs)[0])[1] is not None
        assert sorted(map(str, I.edit_report(docs).collect())) == want
        monkeypatch.undo()


def test_subset_hashes_against_brute_force():
    rng = np.random.default_rng(0)
    used = np.sort(rng.integers(0, 2**64, 40, dtype=np.uint64))
    seeds = I._seeds()
    for level in (0, 3, 6):
        raw = bytes.fromhex(I._subset_hashes(used, level))
        for k in range(I.SUBSETS):
            member = [t for t in used if int(I.mix64(np.array([t ^ seeds[k]]))[0]) >> (64 - level) == 0] if level else list(used)
            if not member:
                assert raw[2 * k : 2 * k + 2] == b"\0\0"
            else:
                total = sum(int(I.mix64(np.array([t * np.uint64(0xD6E8FEB86659FD93)]))[0]) for t in member) % 2**64
                assert int.from_bytes(raw[2 * k : 2 * k + 2]) == int(I.mix64(np.array([total], np.uint64))[0]) >> 48 | 1


def test_likeness_follows_shared_terms():
    words = [f"w{i}" for i in range(200)]
    book = I.Lexicon(I.hashes({w.encode() for w in words}))
    own = book.fingerprint(" ".join(words))
    near = book.fingerprint(" ".join(words[:190]))
    half = book.fingerprint(" ".join(words[:120]))
    assert I.likeness(own, own) == 1 and I.likeness(own, near) > I.likeness(own, half) >= 0
    assert I.likeness(own, near) > 0.75 and I.likeness(own, "-") == 0 and book.fingerprint(" .,!") == "-"
    assert book.fingerprint("unknown terms").startswith("*")


def test_odd_rows(spark, odd, empty):
    check([(r.doc_id, r.text) for r in odd.collect()], I.edit_report(odd).collect())
    assert I.edit_report(empty).count() == 0
    for rows in ([(7, "only one document here")], [(7, None)], [(None, "a"), (None, "b")]):
        check(rows, I.edit_report(spark.createDataFrame(rows, "doc_id long, text string")).collect())
