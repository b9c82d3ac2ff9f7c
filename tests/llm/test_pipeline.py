"""Every stage of the pipeline against a plain version of it, each on its own input."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from fiscalflow.llm import mixing
from fiscalflow.llm.common import materialize
from fiscalflow.llm.queries import vocabulary
from tests.conftest import SF_SMALL
from tests.llm.test_golomb_dedup import brute as exact
from tests.llm.test_jaccard_join import brute as near


@pytest.fixture(scope="module")
def stages(spark, small):
    """Rows into and out of each stage; letterless documents are added for the first."""
    docs = small.union(spark.createDataFrame([(10**6, "12 34", "en", "src1", 5), (10**6 + 1, None, "en", "src1", None)], small.schema))
    out = [("input", docs.collect(), docs.columns)]
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), spark, "test-pipeline")
        out.append((name, docs.collect(), docs.columns))
    return out


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_stage_names_and_columns(stages):
    assert [s[0] for s in stages[1:]] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "bpe_encode"]
    assert all(s[2] == stages[0][2] for s in stages[1:-1])


def test_language_id_drops_letterless_texts_only(stages):
    keep = [(d, t) for d, t in pairs(stages[0][1]) if any(c.isalpha() for c in t or "")]
    assert sorted(pairs(stages[1][1])) == sorted(keep) and len(keep) < len(stages[0][1])


def test_exact_dedup(stages):
    kept = {d for d, _, _, on, _ in exact(pairs(stages[1][1])) if on}
    assert sorted(pairs(stages[2][1])) == sorted((d, t) for d, t in pairs(stages[1][1]) if d in kept)


def test_near_dedup(stages):
    kept = {d for d, _, c in near(pairs(stages[2][1])) if d == c}
    assert sorted(pairs(stages[3][1])) == sorted((d, t) for d, t in pairs(stages[2][1]) if d in kept)


def test_mixing(spark, stages):
    before = spark.createDataFrame(stages[3][1])
    copies = {r.doc_id: r["mix"].copies for r in mixing.mix(before).collect()}
    assert sorted(pairs(stages[4][1])) == sorted((d, t) for d, t in pairs(stages[3][1]) for _ in range(copies[d]))
    assert 0 < len(stages[4][1]) <= len(stages[3][1]) * 1.1


def test_bpe(stages):
    library = Tokenizer.from_file(vocabulary())
    want = []
    for d, t in pairs(stages[4][1]):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), np.array(ids, "<u4").tobytes(), t or ""))
    assert sorted((*r[:4], bytes(r.ids), r.text) for r in stages[5][1]) == sorted(want)


def test_odd_rows_and_empty_table(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in C.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), spark, "test-pipeline")
        assert "ids_sha256" in docs.columns


def test_models_start_no_other_python_workers(spark, odd, monkeypatch):
    """Rows of Python objects would be made by workers of another kind, which stay beside those of the tasks."""
    from fiscalflow.llm import langid

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: pytest.fail("rows of Python objects"))
    assert set(langid.fit_profiles(odd)) == {"en", "fr"}
    assert mixing.fit_classifier(odd).domains == ["a", "b", "c"]
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
