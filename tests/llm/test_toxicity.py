import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscalflow.llm import toxicity as X
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_CHECK}/labels.parquet")


def model_of(words):
    return X.CharModel.fit(X.trigram_counts(words) * 20)


def test_viterbi_against_all_readings():
    model = model_of(["idiot", "stupid", "loser", "silo", "dot", "lit"])
    for written in ("1d10t", "$tup1d", "l0$er", "s.t.u", "looser", "loooser", "i d", "s*t"):
        options = X.lattice(written)
        best = {}
        for path in itertools.product(*options, [(" ", 0.0)]):
            text, score, a, b = "".join(t for t, _ in path), sum(c for _, c in path), 0, 0
            for c in text:
                z = 0 if c == " " else X._SYMBOL.get(c, X._OTHER)
                score += float(model.logp[a, b, z])
                a, b = b, z
            best[text.strip()] = max(best.get(text.strip(), -math.inf), score)
        assert best[X.viterbi(options, model)] == pytest.approx(max(best.values()), abs=1e-4)


def test_readings_of_obfuscated_words():
    model = model_of(["idiot", "stupid", "loser", "worthless", "pathetic", "moron", "trash"] * 3 + ["plain", "words", "here"])
    read = X.Restorer(model).readings
    for text, want in (("an 1d10t!", "idiot"), ("s t u p i d it", None), ("w.o.r.t.h.l.e.s.s", "worthless"), ("looooser", "loser"), ("st*pid", "stupid"), ("p@thet1c", "pathetic"), ("m0r0n", "moron"), ("tr@sh,", "trash"), ("$tupid", "stupid")):
        if want:
            assert want in read(text), text
    assert any("stupid" in r for r in read("you s t u p i d people"))
    assert read("plain words, here. (really) $$$ *** a b 12 2024") == []


def test_ngram_hashes_tell_words_apart():
    for text, words in (("ab abc", ["ab", "abc"]), ("", []), ("x", ["x"])):
        want = set()
        for w in words:
            p = f"_{w}_"
            want |= {(n, p[i : i + n]) for n in (3, 4, 5) for i in range(len(p) - n + 1)}
        assert len(np.unique(X.ngram_hashes(text))) == len(want)
    a, b = X.ngram_hashes("achlichtz"), X.ngram_hashes("achlichst")
    assert len(np.intersect1d(a, b)) >= 15


def test_held_out_accuracy(spark, docs, labels):
    got = X.learn_and_score(docs, labels)
    rows = got.join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert got.count() == docs.count()
    out = [r for r in rows if r.held_out]
    hit = np.mean([r.predicted for r in out if r.toxic == 1])
    false = np.mean([r.predicted for r in out if r.toxic == 0])
    assert hit >= 0.6 and false <= 0.06
    auc = np.mean([(a.score > b.score) + (a.score == b.score) / 2 for a in out if a.toxic for b in out if not b.toxic])
    assert auc >= 0.85


def test_odd_rows(spark, odd, empty, docs, labels):
    model = X.fit(docs, labels)
    rows = X.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    none = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(none) == 1 and none.pop() == pytest.approx(1 / (1 + math.exp(-model.intercept)))
    assert X.score(empty, model).count() == 0
    one_kind = labels.withColumn("toxic", F.lit(0)).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    assert X.fit(docs, one_kind) is None
    assert {r.score for r in X.score(odd, None).collect()} == {0.0}
    assert X.learn_and_score(empty, labels).count() == 0
