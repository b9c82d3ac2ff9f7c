"""Hard negatives: intervals hold the true scores, results equal brute force, awkward rows."""

import numpy as np
import pytest

from fiscalflow.llm import hard_negatives as H
from tests.conftest import SF_CHECK


def brute(rows):
    """The contract on (id, label, vector) rows, by plain loops."""
    ok = [(i, (c + 1) % 10 if i % 7 == 0 else c, [int(np.floor(256 * float(x))) for x in v]) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, la, va in ok:
        if a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=False)), i, c) for i, c, v in ok if i != a]
        pos = sorted(((s, i) for s, i, c in scored if c == la), key=lambda t: (-t[0], t[1]))[:5]
        for ps, p in pos:
            neg = sorted(((s, i) for s, i, c in scored if c != la and 80 * ps <= 100 * s <= 100 * ps), key=lambda t: (-t[0], t[1]))[:5]
            out += [(a, p, k, i, ps, s) for k, (s, i) in enumerate(neg, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_every_score(dim):
    rng = np.random.default_rng(dim)
    x = np.concatenate([rng.integers(-300, 300, (200, dim)), np.zeros((1, dim), int), np.full((1, dim), 7), rng.integers(-2, 2, (20, dim)) * 100_000]).astype(np.int32)
    codes, aligned, residual = H.encode(x, H.rotations(dim))
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    q = H.Anchors(np.arange(len(x)), np.zeros(len(x), int), x)
    least, most = q.interval(slice(0, len(x)), codes, aligned, residual, norms)
    true = x.astype(np.int64) @ x.astype(np.int64).T
    assert (least <= true).all() and (true <= most).all()
    if dim == 64:  # the last residual is a small part of a vector, so the filter does filter
        assert np.median(residual[:200] / norms[:200]) < 0.2


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    assert got(H.mine(df)) == brute(rows)


def test_small_chunks_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(20, 8)).round(2)
    rows = [(i, int(i // 3 % 4), [float(x) for x in base[i % 20]]) for i in range(0, 700)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    whole = got(H.mine(df))
    assert whole == brute(rows) and whole
    monkeypatch.setattr(H, "ANCHORS", 2)
    assert got(H.mine(df)) == whole


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.4]), (2, 2, [0.5, 0.35]), (3, 3, [0.4, 0.4]), (4, None, [0.5, 0.5]), (5, 2, None), (6, 2, [0.5, None]), (8, 2, [nan, 0.5]), (9, 2, [inf, 0.1]),
        (None, 2, [0.5, 0.4]), (100, 2, [0.5, 0.4, 0.0]), (10, 2, []), (11, 1, [-1.0, -1.0]), (200, 9, []), (12, 2, [0.5]), (13, 3, [1e30, 1e30]), (-100, 3, [0.5, 0.45]), (0, 1, [0.5, 0.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "'x' AS id", "'x' AS score", "'x' AS ids", "1 AS rank", "'x' AS v")
    plain = [(i, c, [*v, 0.0, 0.0, 0.0][:3] if v is not None else None) for i, c, v in dict.fromkeys((i, c, tuple(v) if v is not None else None) for i, c, v in rows) if i != 13]
    assert got(H.mine(df)) == brute(plain)
    out = H.mine(df.where("false"))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.count() == 0
