import hashlib
import random
import re
import string

from fiscalflow.llm import secrets_scan as S

BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"(AKIA[A-Z0-9]+)", 16),
    ("hex", r"([0-9a-f]+)", 32),
)


def brute(text):
    found = []
    for k, (kind, pattern, least) in enumerate(BASE):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m[1]) >= least]
    return [x[2] for x in sorted(found)]


def check(rows, got):
    assert len(rows) == len(got)
    key = lambda x: str(x)
    want = sorted(((d, sum(b.startswith("assign") for b in brute(t)), sum(b.startswith("access") for b in brute(t)), sum(b.startswith("hex") for b in brute(t)), hashlib.sha256(",".join(brute(t)).encode()).hexdigest()) for d, t in rows), key=key)
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got), key=key) == want


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = S.scan(docs).collect()
    check(rows, got)
    texts = dict(rows)
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("markov")] == brute(texts[r.doc_id])


def planted():
    rnd = random.Random(7)
    rand = lambda n, a=string.ascii_letters + string.digits: "".join(rnd.choice(a) for _ in range(n))
    secrets = [rand(40) for _ in range(20)] + ["ghp_" + rand(36) for _ in range(5)] + [rand(32, string.ascii_uppercase + string.digits) for _ in range(5)]
    ordinary = ["internationalization2", "the-long-hyphenated-name-of-2024", "some_function_name_with_version2", "configuration/settings/defaults1", "1234567890123456", "thisisaverylongordinaryword"]
    return secrets, ordinary


def test_markov_models_tell_random_strings(spark, docs):
    """Trained on the table's own samples, they find planted random strings and leave long names alone."""
    secrets, ordinary = planted()
    rows = [(10_000 + i, f"é see {s} here") for i, s in enumerate(secrets)] + [(20_000 + i, f"see {s} here") for i, s in enumerate(ordinary)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.scan(docs.select("doc_id", "text").union(more)).collect()}
    found = [got[10_000 + i].spans == f"markov:6:{6 + len(s)}" for i, s in enumerate(secrets)]
    assert sum(found) >= 0.95 * len(secrets)
    assert not any(got[20_000 + i].n_markov for i in range(len(ordinary)))
    clean = [r for d, r in got.items() if d < 10_000]
    assert sum(r.n_markov > 0 for r in clean) <= 0.01 * len(clean)


def test_recall_by_kind_of_random_string(spark, docs):
    """At least 0.9 of each kind, with digits or without; long names of every spelling stay."""
    rnd = random.Random(11)
    rand = lambda n, a: "".join(rnd.choice(a) for _ in range(n))
    kinds = {"mixed": string.ascii_letters + string.digits, "letters": string.ascii_letters, "small": string.ascii_lowercase, "capitals": string.ascii_uppercase, "small and digits": string.ascii_lowercase + string.digits, "base64": string.ascii_letters + string.digits + "+/"}
    planted = [(kind, "x" + rand(rnd.choice((24, 32, 40)), a) + "k") for kind, a in kinds.items() for _ in range(40)]
    names = ["internationalization", "getUserAccountSettings", "CONFIGURATION_DEFAULTS", "the-quick-brown-fox-jumps", "InternationalBusinessMachines", "responsabilidade_social", "counterrevolutionary"]
    rows = [(10_000 + i, f"see {s} here") for i, (_, s) in enumerate(planted)] + [(20_000 + i, f"see {s} here") for i, s in enumerate(names)]
    got = {r.doc_id: r.n_markov for r in S.scan(docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for kind in kinds:
        hits = [got[10_000 + i] for i, (k, _) in enumerate(planted) if k == kind]
        assert sum(hits) >= 0.9 * len(hits), (kind, sum(hits))
    assert [n for i, n in enumerate(names) if got[20_000 + i]] == []
    clean = [n for d, n in got.items() if d < 10_000]
    assert sum(n > 0 for n in clean) <= 0.01 * len(clean)


def test_odd_rows(spark, odd, empty):
    check([(r.doc_id, r.text) for r in odd.collect()], S.scan(odd).collect())
    assert S.scan(empty).count() == 0
    rows = [(1, "secret: token: abcdefghij x"), (2, "é日 token: 'abcdefgh12'"), (3, "AKIAshort AKIAAKIA1234567890"), (4, "0123456789abcdef" * 3 + "g"), (5, "PASSWORD=x TOKEN = \"abcdefgh\""), (6, "token=" + "a" * 20_000)]
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got)


def test_only_built_in_expressions(docs):
    plan = S.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
