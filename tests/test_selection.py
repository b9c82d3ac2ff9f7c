"""Exact ranks and medians by selection; listings followed over known pages."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from fiscalflow.operators import selection as S
from fiscalflow.session import materialize
from fiscalflow.sources.crawl import crawl


@pytest.mark.parametrize("few", [10_000, 5])
def test_medians_equal_sorting(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW", few)
    monkeypatch.setattr(S, "ACCURACY", 20)
    rnd = random.Random(few)
    values = {
        "continuo": [rnd.random() for _ in range(999)], "empates": [5.0] * 700 + [rnd.random() for _ in range(500)], "dois": [1.0] * 300 + [2.0] * 300, "um": [7.0], "par": [1.0, 4.0],
        "longe": [2.0 ** -(k % 900) for k in range(2000)], "infinito": [float("inf")] * 3 + [float("-inf")] * 4 + [0.0] * 4, None: [3.0, 1.0, 2.0], "vazio": [None],
    }
    rows = [(k, v) for k, vs in values.items() for v in [*vs, None]]
    df = spark.createDataFrame(rows, "`chave.x` string, v double").repartition(5)
    got = {r[0]: r.mediana for r in S.exact_median(df, ["chave.x"], "v").collect()}
    assert got == {k: statistics.median(vs) for k, vs in values.items() if k != "vazio"}


def test_any_rank_and_no_rows(spark):
    df = spark.createDataFrame([(float(i * 37 % 1000),) for i in range(1000)], "v double")
    ranks = materialize(spark.createDataFrame([(1,), (250,), (1000,)], "rank long"), spark, "t")
    assert sorted((r.rank, r.value) for r in S.exact_ranks(df, [], "v", ranks).collect()) == [(1, 0.0), (250, 249.0), (1000, 999.0)]
    assert S.exact_median(df.where("false").withColumn("k", F.lit(1)), ["k"], "v").count() == 0


def test_cycles_end_and_unknown_folders_are_told(spark):
    page = lambda *links: "".join(f'<a href="{x}">x</a>' for x in links)
    rows = [
        ("http://h/a/", page("b/", "x.csv", "../c/", "http://outro/z/", "x.csv")),
        ("http://h/a/b", page("../", "y.zip", "falta/", "nota.txt")),
        ("http://h/c/?p=1", page("/a/", "z.csv", "/a/x.csv")),
        ("http://h/longe/", page("w.csv")),
        ("http://h/vazia/", None),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    got = crawl(pages, ["http://h/a/", "http://h/vazia/"])
    assert sorted((r.url_link, r.pagina, r.nivel) for r in got.files.collect()) == [("http://h/a/b/y.zip", "http://h/a/b", 1), ("http://h/a/x.csv", "http://h/a", 0), ("http://h/c/z.csv", "http://h/c", 1)]
    assert {(r.pagina, r.conhecida) for r in got.folders.collect()} == {("http://h/a", True), ("http://h/a/b", True), ("http://h/c", True), ("http://h/a/b/falta", False), ("http://h/vazia", True)}
