"""Ranked search: the treap against a plain grid, rankings against brute force and SQL, awkward rows."""

import math
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscalflow.llm import ranked_search as R
from fiscalflow.llm.queries import OP11_SQL
from tests.conftest import SF_CHECK

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    """The contract on lists of (id, text), by plain loops."""
    found = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, t in found:
            score = 0
            for w in set(TERM.findall((text or "").translate(LOWER))) & set(t):
                tf, m = t.count(w), 100 - 90 + (90 * len(t) * n_docs) // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(0, 400), st.integers(0, 10_000))
def test_treap_holds_the_grid(bits, n, seed):
    rng = np.random.default_rng(seed)
    side = 1 << bits
    at = rng.choice(side * side, min(n, side * side), replace=False)
    grid = np.zeros((side, side), np.int64)
    rows, cols, values = at // side, at % side, rng.integers(1, 1_000_000, len(at))
    grid[rows, cols] = values
    stored = R.Treap.build(rows, cols, values, bits)
    treap = R.Treap(bits, *stored)
    assert len(treap.impact) == len(at)  # one node an entry
    every = np.arange(side * side)
    assert (treap.lookup(every // side, every % side) == grid.ravel()).all()
    if len(at):
        assert treap.impact[0] == values.max()
        parent = np.flatnonzero(treap.on) >> 2
        assert (treap.impact[parent] >= treap.impact[1:]).all()  # heap order


@pytest.mark.parametrize(("block_docs", "states", "group"), [(8192, 48, 1500), (7, 1, 5), (64, 2, 40)])
def test_random_texts_against_brute_force(spark, monkeypatch, block_docs, states, group):
    rng = np.random.default_rng(block_docs)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words, rng.integers(0, 25), p=share / share.sum())) for _ in range(300)]
    docs = list(enumerate(texts + texts[:40] + ["w1 w1 w2"] * 30))
    items = [(i, " ".join(rng.choice(words, 8))) for i in range(12)] + [(99, "none of these"), (100, "w1 w2")]
    monkeypatch.setattr(R, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(R, "STATES", states)
    monkeypatch.setattr(R, "GROUP_TERMS", group)
    index = R.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    found = got(R.search(index, spark.createDataFrame(items, "item_id long, text string")))
    assert found == sorted(brute(docs, items), key=key)
    # Tasks import the module with its own constants, so small blocks and groups are tried in this process.
    assert local(docs, items) == sorted(brute(docs, items), key=key)


def local(docs, items, k=10):
    """Index and search in this process, with the module's present constants."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([(t or "").encode() for _, t in docs], pa.binary())})
    totals = next(R._totals(iter([batch]))).to_pylist()[0]
    blocks = list(R._index(totals["total"], max(1, totals["length"]))(iter([batch])))
    chunk = [(i, np.unique(np.fromiter(map(R.term_hash, set(R.terms_of((t or "").encode()))), np.uint64))) for i, t in items]

    class Sent:
        value = chunk

    df = next(R._frequencies(Sent)(iter(blocks))).to_pydict()
    total = {}
    for t, n in zip(df["term"], df["df"], strict=True):
        total[t] = total.get(t, 0) + n
    Sent.value = (chunk, np.array(list(total), np.int64).view(np.uint64), np.array(list(total.values()), np.int64))
    found = next(R._best(Sent, k)(iter(blocks))).to_pylist()
    by = {}
    for r in found:
        by.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
    return sorted(((i, rank, d, s) for i, rs in by.items() for rank, (d, s) in enumerate(rs, 1)), key=key)


def test_table_against_sql(spark):
    docs, items = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    found = got(R.rank_documents(docs, items))
    assert found == sorted(con.execute(OP11_SQL).fetchall(), key=key) and found


def test_awkward_rows(spark, odd, empty):
    items = [(1, "The quick  BROWN fox"), (2, None), (3, ""), (4, "日本語 token abcdef0123456789"), (None, "fox"), (5, "alpha épsilon"), (1, "The quick  BROWN fox"), (6, "12345")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'x' AS score", "'x' AS rank")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(R.rank_documents(odd, asked)) == sorted(brute(docs, [i for i in dict.fromkeys(items) if i[0] is not None]), key=key)
    assert R.rank_documents(empty, asked).count() == 0
    assert R.rank_documents(odd, asked.where("false")).count() == 0
    assert R.rank_documents(odd.where("doc_id = 9"), asked.where("item_id = 2")).columns == ["item_id", "rank", "doc_id", "score"]
