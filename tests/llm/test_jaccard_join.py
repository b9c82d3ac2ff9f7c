import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscalflow.llm import jaccard_join as J
from fiscalflow.llm.components import components


def grams(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), best[find(i)]) for i, (doc, _) in enumerate(rows))


def result(df):
    return sorted(tuple(r) for r in J.jaccard_components(df).collect())


def test_five_equal_words_are_the_gram_of_a_longer_text(spark):
    """A text of exactly five words has the shingle that the same five words have in a longer text."""
    rows = list(enumerate(["x x x x x", "x x x x x x", "- - - - -", "- " * 40, "x x x x", "a b c d e", "a b c d e f"], 1))
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3), (5, 1, 5), (6, 1, 6), (7, 2, 7)]


def families(seed, n):
    """Families of edited copies around and below the threshold, with shared passages and exact copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rnd.randint(3, 150))]
        if rnd.random() < 0.4:
            base[rnd.randrange(len(base)) :] = passage
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5])):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.2:
                copy = copy[: max(1, int(len(copy) * rnd.uniform(0.6, 1)))]
            rows.append((len(rows) * 7 % 10_007, rnd.choice([" ", "\n"]).join(copy)))
    return rows[:n]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.floats(0, 0.4), st.integers(1, 8), st.integers(1, 8))
def test_prefixes_lose_no_similar_pair(seed, n, edit, i, j):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    b = np.unique(np.concatenate([a[rng.random(len(a)) >= edit], rng.integers(0, 2**63, int(edit * n), dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    want = bool(both) and 100 * both >= 80 * (len(a) + len(b) - both)
    longest = lambda s, l: min(l, int(J.need(len(s))))  # noqa: E731, E741
    if len(b):
        assert J.similar(a, b, longest(a, i), longest(b, j)) == want
        if want:  # the smaller set's flagged prefix meets the other's prefix
            x, y = sorted((a, b), key=len)
            assert len(np.intersect1d(x[: len(x) - J.need_smaller(len(x)) + 1], y[: len(y) - J.need(len(y)) + 1])) >= 1


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 400), st.integers(0, 400))
def test_counts_bound_what_is_shared(seed, n, m, both):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**64, n + m + both, dtype=np.uint64)
    a, b = np.unique(np.concatenate([x[:n], x[n + m :]])), np.unique(x[n:])
    assert np.minimum(J.gram_counts(a), J.gram_counts(b)).sum() >= len(np.intersect1d(a, b))


def test_longer_prefix_where_candidates_cost_more():
    rare, hot = np.arange(100, dtype=np.uint64), np.arange(1000, 1100, dtype=np.uint64)
    order = J.Order(hot, np.full(100, 1000))
    assert order.arrange(rare)[2] == 1
    grams_, known, matches = order.arrange(hot)
    assert matches == J.MOST_MATCHES and known.all()
    mixed = order.arrange(np.concatenate([hot[:50], rare[:50]]))
    assert mixed[0][:50].tolist() == rare[:50].tolist()


def test_families_against_brute_force(spark):
    for seed in (1,):
        rows = families(seed, 260)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert result(df) == brute(rows)


def test_tiny_blocks_and_hot_lists(spark, monkeypatch):
    """All the ways around a hot group: frequent grams, random pivots, blocks with salted queries."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rnd.choice([0, 1, 2, 2, 3, 4])):
            copy[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(J, "BLOCK", 400)
    monkeypatch.setattr(J, "QUERIES", 200)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    got = [tuple(r) for r in J.jaccard_components(odd).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute(rows)
    # Rows without an id keep the class of their equals.
    assert sorted((r[1:] for r in got if r[0] is None), key=str) == [(1, None), (8, -12)]
    assert J.jaccard_components(empty).count() == 0
    kept = J.drop_near_copies(odd)
    assert kept.columns == odd.columns and J.drop_near_copies(empty).count() == 0


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(40)] + [(None, 1), (5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_boilerplate_line_links_nothing(spark):
    """20,000 short texts around one line: their own grams are more than the difference allowed, so no list is left to be compared."""
    line = " ".join(f"w{i}" for i in range(12))
    rows = [(i, f"a{i} {line} b{i}") for i in range(20_000)] + [(30_000, "a5 " + line + " b5"), (30_001, line + " x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r[0]: r[2] for r in J.jaccard_components(df).collect()}
    assert got[30_000] == 5 and all(c == d for d, c in got.items() if d != 30_000)


def test_lists_of_the_same_sets_are_one():
    import pandas as pd

    sizes = np.repeat(np.array([101, 100, 100], np.uint32), 40)  # size 50; the first set's postings are flagged
    heads = np.repeat(np.array([9, 8, 7], np.uint64), 40)
    rows = pd.DataFrame([{"bucket": 1, "heads": heads.tobytes(), "sizes": sizes.tobytes(), "grams": np.tile(np.arange(40, dtype=np.uint32) * 7, 3).tobytes()}] * 2)
    out = J._lists(10, 80)(rows)
    assert len(out) == 3 and out["list"].nunique() == 1 and set(out["grams"]) == {40} and sorted(out["flag"]) == [False, False, True]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 80), st.floats(0, 0.4), st.sampled_from([1, 3, 30]))
def test_halves_never_share_less(seed, n, edit, kinds):
    rng = np.random.default_rng(seed)
    draw = lambda k: (rng.integers(0, 2**kinds, k, dtype=np.uint64) << np.uint64(32)) | rng.integers(0, 2**32, k, dtype=np.uint64)
    a = np.unique(draw(n))
    b = np.unique(np.concatenate([a[rng.random(len(a)) >= edit], draw(int(edit * n))]))
    half = lambda x: np.sort((x >> np.uint64(32)).astype(np.uint32))
    assert J._shared(half(a), half(b)) >= len(np.intersect1d(a, b))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 700), st.floats(0, 1), st.floats(0, 1), st.sampled_from([50, 80, 95]))
def test_parities_never_tell_more_than_the_difference(seed, n, edit, cut, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    b = np.unique(np.concatenate([a[rng.random(len(a)) >= edit][: 1 + int(cut * n)], rng.integers(0, 2**64, 1 + int(edit * n / 2), dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    apart = J.least_apart(J.parities(a), J.parities(b))
    assert apart == J.least_apart(J.parities(b), J.parities(a)) <= len(a) + len(b) - 2 * both
    if 100 * both >= percent * (len(a) + len(b) - both):
        assert apart <= J.most_apart(len(a), len(b), percent)


def test_blocks_keep_every_set_that_may_be_similar():
    import pandas as pd

    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**64, 260, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[: int(k)], rng.integers(0, 2**64, int(extra), dtype=np.uint64)])) for k, extra in zip(rng.integers(1, 260, 120), rng.integers(0, 30, 120), strict=True)]
    table = pd.DataFrame({"f": 0, "k": 0, "s": 0, "doc": range(120), "comp": np.arange(120) // 2, "n": [len(s) for s in sets], "parities": [J.parities(s).tobytes() for s in sets]})
    queries = table.iloc[::3]
    out = J._possible(80)(queries, table)
    want = {0: set(), 1: set()}
    for q in queries["doc"]:
        for m in range(120):
            both = len(np.intersect1d(sets[q], sets[m]))
            if q // 2 != m // 2 and 100 * both >= 80 * (len(sets[q]) + len(sets[m]) - both):
                want[0].add(q)
                want[1].add(m)
    got = {k: set(out.loc[out["kind"] == k, "doc"]) for k in (0, 1)}
    assert want[0] and want[0] <= got[0] and want[1] <= got[1] < set(range(120))


def test_pairs_that_share_a_gram_by_chance_fetch_no_set(spark, monkeypatch):
    """Texts that share one phrase with another, as random texts of a large corpus do, end at their parities."""
    written = {}

    def recorded(df, session, label, write=J.materialize):
        out = write(df, session, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(J, "materialize", recorded)
    text = lambda i: " ".join([*(f"p{i // 2}y{k}" for k in range(20)), *(f"w{i}x{k}" for k in range(90))])
    rows = [(i, text(i)) for i in range(400)] + [(1000, text(7) + " z")]
    got = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == sorted([(i, 106, i) for i in range(400)] + [(1000, 107, 7)])
    assert written["join-sets"] > 200  # in lists
    assert written["join-whole"] + written["join-halves"] <= 12
