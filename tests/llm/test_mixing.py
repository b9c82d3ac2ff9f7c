from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fiscalflow.llm import mixing as M


def brute_rates(p, n, target, total, steps):
    """The same projected gradient, with every rate kept between steps."""
    share = n @ p / n.sum()
    target = target / target.sum() * total
    step = 1 / (share.max() + M.PULL)
    rate, look = np.ones(len(n)), np.ones(len(n))
    for t in range(steps):
        residual = (n * look) @ p / n.sum() - target
        if np.abs(residual).max() < M.CLOSE:
            break
        before = rate
        rate = np.maximum(0, look - step * (p @ residual + M.PULL * (look - 1)))
        look = rate + t / (t + 3) * (rate - before)
    return rate


def test_rates_against_kept_state(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3] * 4, 500).astype(np.float32)
    n = rng.integers(0, 300, 500)
    rows = [(int(x), q.tobytes()) for x, q in zip(n, p, strict=True)]
    table = spark.createDataFrame([(a, bytearray(b)) for a, b in rows], "n_tokens long, posterior binary").repartition(3)
    target = np.array([0.4, 0.3, 0.2, 0.1])
    fit = M.fit_rates(table, 4, target, 0.8)
    got = fit.rates(p)[0]
    assert np.allclose(got, brute_rates(p.astype(float), n.astype(float), target, 0.8, M.STEPS), atol=1e-5)
    assert (got >= 0).all()
    assert np.allclose((n * got) @ p / n.sum(), target * 0.8, atol=0.01)


def test_targets_are_met_on_the_table(docs):
    """With the language as domain the words tell it: expected and drawn tokens reach equal weights."""
    got = M.mix(docs, {"en": 1, "fr": 1, "de": 1, "es": 1}, domain_col="lang", total=0.4).select("lang", "mix.*").toPandas()
    expected = got.assign(w=got.n_tokens * got.rate).groupby("domain").w.sum() / got.n_tokens.sum()
    assert np.allclose(expected, 0.1, atol=0.02)
    drawn = got.assign(w=got.n_tokens * got.copies).groupby("lang").w.sum() / got.n_tokens.sum()
    assert np.allclose(drawn, 0.1, atol=0.05)
    assert (got.lang == got.domain).mean() > 0.97


def test_words_alone_tell_held_out_domains(docs):
    model = M.fit_classifier(docs.where("doc_id % 2 = 0"), domain_col="lang")
    rows = docs.where("doc_id % 2 = 1").select("text", "lang").collect()
    right = np.mean([model.domains[int(model.posterior(r.text.encode(), None)[1].argmax())] == r.lang for r in rows])
    assert right > 0.9


def test_default_targets_repeat_nothing_much(docs):
    got = M.mix(docs).select("source", "mix.*").toPandas()
    assert got.rate.max() < 1.1 and got.copies.max() <= 2 and abs(got.copies.sum() - got.rate.sum()) < 60


@pytest.mark.parametrize("rare", [1e-2, 1e-4, 1e-6])
def test_a_rare_domain_does_not_set_the_total(spark, rare):
    """All tokens are drawn at any share of the rarest domain; the hot one is thinned, the others are not."""
    share = np.array([0.35, *[(0.65 - rare) / 19] * 19, rare])
    p = np.eye(len(share), dtype=np.float32)
    table = spark.createDataFrame([(int(x), bytearray(q.tobytes())) for x, q in zip(np.round(share * 10**7), p, strict=True)], "n_tokens long, posterior binary")
    fit = M.fit_rates(table, len(share))
    got = fit.rates(p)[0]
    assert abs(share @ got - 1) < 0.01 and abs(fit.target.sum() - 1) < 1e-9
    assert got[0] < 0.7 and (got[1:] > 1).all()


def crisp(spark, share, others=0):
    """Documents of one domain each, as posteriors; the last ``others`` domains are known by their tag alone."""
    k, size = len(share), len(share) - others
    p = np.eye(k, dtype=np.float32)
    own = np.maximum(-1, np.arange(k) - size)
    if others:
        p = np.hstack([p[:, :size], (own >= 0).astype(np.float32)[:, None]])
    rows = [(int(x), bytearray(q.tobytes()), int(o)) for x, q, o in zip(np.round(share * 10**8), p, own, strict=True)]
    return spark.createDataFrame(rows, "n_tokens long, posterior binary, own int").coalesce(2), p, own


def test_rare_targets_are_met_within_a_part_of_them(spark):
    share = np.array([0.4, 0.3, 0.29989, 1e-4, 1e-5])
    for others in (0, 2):
        table, p, own = crisp(spark, share, others)
        fit = M.fit_rates(table, len(share) - others, others=others)
        want = share**M.FLATTEN / (share**M.FLATTEN).sum()
        assert not fit.missed
        assert np.allclose(share * fit.rates(p, own if others else None)[0], want, rtol=0.021, atol=0)


def test_targets_out_of_reach_are_named(spark, monkeypatch):
    monkeypatch.setattr(M, "STEPS", 3)
    monkeypatch.setattr(M, "MORE_STEPS", 4)
    rows = [(10, bytearray(np.array([0.5, 0.5], np.float32).tobytes()))] * 4
    fit = M.fit_rates(spark.createDataFrame(rows, "n_tokens long, posterior binary").coalesce(1), 2, np.array([0.9, 0.1]))
    assert fit.missed == (0, 1)


def test_domains_beyond_those_with_a_word_model(spark, monkeypatch):
    """Each source has its target, also those known by their tags alone; a target of no source is an error."""
    monkeypatch.setattr(M, "DOMAINS", 2)
    rng = np.random.default_rng(0)
    sources = ["a"] * 150 + ["b"] * 120 + ["c"] * 12 + ["d"] * 6
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 40)), s) for i, s in enumerate(sources)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(2)
    got = M.mix(table, {"a": 1, "b": 1, "c": 1, "d": 1}).select("source", "mix.*").toPandas()
    assert (got.source == got.domain).all()
    drawn = got.assign(w=got.n_tokens * got.rate).groupby("source").w.sum() / got.n_tokens.sum()
    assert (drawn > 0.2).all() and (drawn < 0.3).all()
    with pytest.raises(ValueError, match="nowhere"):
        M.mix(table, {"a": 1, "nowhere": 1})


def test_odd_rows(odd, empty):
    rows = M.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["mix"].n_tokens == len((r["text"] or "").split()) and r["mix"].rate >= 0 for r in rows if r["doc_id"] != 11)
    same = {(r["mix"].rate, r["mix"].copies) for r in rows if r["doc_id"] == 6}
    assert len(same) == 1
    drawn = M.draw(M.mix(odd))
    assert drawn.columns == odd.columns
    assert drawn.count() == sum(r["mix"].copies for r in rows)
    assert M.mix(empty).count() == 0
    untagged = M.mix(odd.withColumn("source", F.lit(None).cast("string"))).select("mix.*").collect()
    assert {(r.rate, r.copies) for r in untagged} == {(1.0, 1)}
    with pytest.raises(ValueError):
        M.mix(odd, {"nowhere": 1.0})


def test_texts_are_judged_once(spark):
    docs = spark.createDataFrame([(i, "uma palavra " * (i % 5), "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    plan = M.mix(docs).select("doc_id", "mix.*")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[1]


def test_words_of_many_texts_are_those_of_each():
    texts = [None, b"", b" \t", b"A b\x0bB\x0c a", b"  \xc3\x89t\xc3\xa9 \xc3\xa9T ", b"\xff \x00\x1f\x85 Z\xa0z", "\u00a0x\u2003y".encode(), b"a", b"\r\n"]
    for rows in (texts, texts[::-1], [b"", b" "], []):
        got = M.text_codes(pa.array([b"left out", *rows, b"left out"], pa.binary()).slice(1, len(rows)))
        assert [x.tolist() for x in got] == [[xxhash.xxh3_64_intdigest(w) % M.WORDS for w in (raw or b"").lower().split()] for raw in rows]


def test_steps_read_a_narrow_table(spark, monkeypatch):
    """No step has a task for each piece of the texts' table, whose rows are wide."""
    docs = spark.createDataFrame([(i, "uma palavra " * (i % 5), "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string").repartition(4)
    read = []
    fit_rates = M.fit_rates
    monkeypatch.setattr(M, "fit_rates", lambda posteriors, *more: read.extend(posteriors.inputFiles()) or fit_rates(posteriors, *more))
    mixed = M.mix(docs)
    assert read and not set(read) & set(mixed.inputFiles())
    assert mixed.count() == 20 and not any(Path(f.removeprefix("file:")).exists() for f in read)
