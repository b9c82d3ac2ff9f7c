import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from fiscalflow.llm import golomb_dedup as G


@given(st.lists(st.integers(0, 2**64 - 1), max_size=200, unique=True))
def test_coder_round_trip(values):
    x = np.sort(np.array(values, np.uint64))
    assert G.golomb_decode(len(x), *G.golomb_encode(x)).tolist() == x.tolist()


def test_code_is_short():
    x = np.sort(np.random.default_rng(0).integers(0, 2**63, 10_000, dtype=np.uint64))
    k, unary, low = G.golomb_encode(x)
    assert (len(unary) + len(low)) * 8 / len(x) < 64 - np.log2(len(x)) + 3


def brute(rows):
    groups = {}
    for doc, text in rows:
        text = text or ""
        groups.setdefault("".join(c for c in text if c not in " \t\n\x0b\x0c\r"), []).append((-len(text), doc is None, doc or 0, doc))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in G.exact_groups(df).collect()), key=str)


def test_whole_table(docs):
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(odd, empty):
    assert result(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert G.exact_groups(empty).count() == 0
    kept = G.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted(((r[0],) for r in brute([(r.doc_id, r.text) for r in odd.collect()]) if r[3]), key=str)
    assert G.drop_copies(empty).count() == 0


def test_many_owners_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(G, "PER_OWNER", 50)
    rows = [(i, "same text" if i % 3 == 0 else f"text {i // 2}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(df) == brute(rows)
