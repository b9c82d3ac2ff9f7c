from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscalflow.llm import langid
from fiscalflow.llm.common import held_out


def grams(text):
    out, words = [], []
    for c in text.lower():
        words.append(c if c.isalpha() else " ")
    for w in "".join(words).split():
        out += list(w)
        for n in (2, 3):
            p = f"_{w}_"
            out += [p[i : i + n] for i in range(len(p) - n + 1)]
    return out


def code(gram):
    v = 0
    for c in gram:
        v = (v << 21) | (1 if c == "_" else ord(c))
    return v


def ranked(counts, k):
    return [c for c, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:k]]


def test_codes_are_the_grams_of_words():
    for text in ("", "!!! 12", "a", "Ça va, bien?", "a1b  cc"):
        a, b = Counter(langid.ngram_codes(text).tolist()), Counter(map(code, grams(text)))
        # A gap between words is one symbol, so two-letter gaps of neighbours are shared.
        assert {k for k in a if k >> 21} == {k for k in b if k >> 21} and all(a[k] == b[k] for k in a if 1 < k < 1 << 21)


def test_distance_against_brute_force():
    train = {"en": "the cat sat on the mat and the dog", "fr": "le chat est sur le tapis et le chien"}
    profiles = {k: langid.top_ngrams(langid.ngram_codes(v), 50).tolist() for k, v in train.items()}
    ranker = langid.Ranker(profiles, 50)
    for text in ("the dog", "le chien est", "x", "chat"):
        own = langid.top_ngrams(langid.ngram_codes(text), 50).tolist()
        for i, lang in enumerate(ranker.langs):
            place = {c: r for r, c in enumerate(profiles[lang])}
            want = sum(min(50, abs(place[c] - r)) if c in place else 50 for r, c in enumerate(own)) / (50 * len(own))
            assert ranker.distances(text)[i] == pytest.approx(want)
    assert ranker.predict("the cat")[0] == "en" and ranker.predict("le chat")[0] == "fr"
    assert ranker.predict("12 ?") == ("und", 0.0)


def test_profiles_are_the_most_frequent_codes(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("aa ab", "x"), ("ab abc", "x"), ("zz", "y"), ("q", None)])]
    got = langid.fit_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), size=5)
    for lang, texts in (("x", ["aa ab", "ab abc"]), ("y", ["zz"])):
        counts = Counter(np.concatenate([langid.ngram_codes(t) for t in texts]).tolist())
        assert got[lang] == [c for c, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]]
    assert set(got) == {"x", "y"}


def test_held_out_accuracy(docs):
    got = langid.learn_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 200 and right >= 0.98


def test_odd_rows(odd, empty):
    rows = langid.learn_and_predict(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4, 9))
    assert all(r.lang_pred in ("en", "fr") for r in rows if r.doc_id in (1, 5, 6, 10))
    assert langid.learn_and_predict(empty).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.learn_and_predict(unlabelled).collect()} == {"und"}
    kept = langid.drop_rejected(odd, langid.fit_profiles(odd.where(~held_out(F.col("doc_id")))))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
