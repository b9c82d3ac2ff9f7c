"""Property tests of Column rules, each batched into one DataFrame (one Spark job per property)."""

from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from fiscalflow.functions import names, urls

NAME_ALPHABET = st.sampled_from(list("abcXYZ019_-. áÉçãÕüß") + ["pda", "dicionario", "Dicionário", "202401", "2005"])
names_st = st.lists(st.lists(NAME_ALPHABET, min_size=0, max_size=8).map("".join), min_size=30, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names_st)
def test_group_and_ignore_rules_depend_on_the_plain_stem_only(spark, values):
    """Folders, suffix, accents and the choice of separator change neither rule; the group is a part of the name."""
    df = spark.createDataFrame([(v,) for v in values if v and "." not in v], "n string")
    g, i = names.group_from_name, names.ignore_by_name
    other = F.concat(F.lit("dir/"), F.replace(names.strip_accents("n"), F.lit("_"), F.lit("-")), F.lit(".csv"))
    for r in df.select("n", g("n").alias("g"), i("n").alias("i"), g(other).alias("g2"), i(F.concat(F.lit("d/"), "n", F.lit(".ods"))).alias("i2"), names.strip_accents("n").alias("s")).collect():
        assert r.g and r.g == r.g2 and r.i == r.i2, r.n
        assert r.g == names.NO_GROUP or r.g.upper() == r.g
        assert r.i == ("dicionario" in r.s.lower())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names_st)
def test_safe_names_are_plain_and_stay(spark, values):
    """A safe name has letters, digits and single inner underscores only, and is its own safe name."""
    df = spark.createDataFrame([(v,) for v in values], "n string")
    safe = [r.s for r in df.select(names.safe_name("n").alias("s")).collect()]
    assert all("__" not in s and s.strip("_") == s != "" and s.replace("_", "").isalnum() for s in safe)
    again = spark.createDataFrame([(s,) for s in safe], "n string").select(names.safe_name("n").alias("s")).collect()
    assert [r.s for r in again] == safe


SEG = st.sampled_from(["a", "b", "..", ".", "", "x.csv", "pasta", "d.zip"])
rel_st = st.lists(SEG, min_size=1, max_size=5).map("/".join)
base_st = st.sampled_from(["http://h.org/a/b/c", "http://h.org/a/b/", "https://h.org", "http://h.org/a?q=1", "ftp://h.org/p/q/"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(base_st, rel_st), min_size=30, max_size=60))
def test_resolve_href_matches_urljoin(spark, pairs):
    # A host-rooted path with both ".." and empty segments: the standard library departs from RFC 3986 there.
    pairs = [(b, h) for b, h in pairs if h and not h.startswith("//") and not (h[0] == "/" and "//" in h and ".." in h)]
    df = spark.createDataFrame(pairs, "b string, h string")
    for r in df.select("b", "h", urls.resolve_href("b", "h").alias("u")).collect():
        assert r.u == urljoin(r.b, r.h), (r.b, r.h)
