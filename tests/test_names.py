"""Name rules against the truth tables read off the reference (FIXTURES.md §2)."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from fiscalflow.functions import names

GROUPS = [
    ("AC_202401_HOSP_CONS.zip", "CONS"),
    ("AC_202401_HOSP_DET.zip", "DET"),
    ("pda-043-rpc-201505.csv", "043_RPC_2015"),
    ("pda-043-rpc-202602.parquet", "043_RPC_2026"),
    ("pda-043-rpc-2005_2009.parquet", "2009"),
    ("pda-048-taxa_de_resolutividade.csv", "RESOLUTIVIDADE"),
    ("nota_tecnica_vcm_faixa_etaria.zip", "ETARIA"),
    ("produtos_e_prestadores_hospitalares.zip", "HOSPITALARES"),
    ("IGR.csv", "IGR"),
    ("___.csv", "SEM_GRUPO"),
    ("Ação_Saúde.csv", "SAUDE"),
    ("dir/sub/pda-001-abc-199912.csv", "001_ABC_1999"),
]
IGNORED = [
    ("Dicionario_de_dados.ods", True),
    ("DICIONÁRIO-2023.xlsx", True),
    ("meu_dicionario.csv", True),
    ("dados.csv", False),
    ("dicionario", True),
]
SAFE = [("Açúcar & Café", "ACUCAR_CAFE"), ("__a--b__", "A_B"), ("***", "SEM_GRUPO"), ("043_rpc_2015", "043_RPC_2015")]
RUN = [("  Minha Execução/2024 ", "Minha_Execucao_2024"), ("a--b  c", "a_b_c"), ("___", None), ("   ", None)]


def test_group_rule(spark):
    df = spark.createDataFrame(GROUPS, "name string, expected string")
    got = df.select("name", "expected", names.group_from_name("name").alias("g")).collect()
    for r in got:
        assert r.g == r.expected, r.name


def test_caller_group_wins(spark):
    df = spark.createDataFrame([("IGR.csv", "X"), ("IGR.csv", ""), ("IGR.csv", None)], "name string, given string")
    got = [r.g for r in df.select(names.group_from_name("name", F.col("given")).alias("g")).collect()]
    assert got == ["X", "IGR", "IGR"]


def test_ignore_rule(spark):
    df = spark.createDataFrame(IGNORED, "name string, expected boolean")
    for r in df.select("name", "expected", names.ignore_by_name("name").alias("i")).collect():
        assert r.i == r.expected, r.name


def test_safe_names(spark):
    df = spark.createDataFrame(SAFE, "g string, expected string")
    for r in df.select("g", "expected", names.safe_name("g").alias("s")).collect():
        assert r.s == r.expected


def test_safe_run_name(spark):
    df = spark.createDataFrame(RUN, "n string, expected string")
    for r in df.select("n", "expected", names.safe_run_name("n").alias("s")).collect():
        assert r.s == r.expected, r.n


def test_strip_accents_is_nfkd_without_marks(spark):
    words = ["Ação", "Ñandú", "Ærø", "Straße", "Ελληνικά", "Čeština", "e\u0301", "ǅemal", "oﬁcina ﬄ", "½ litro", "a_½", "\U0001d400\U0001d41b", "№ 5", "", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.s for r in df.select(names.strip_accents("w").alias("s")).collect()] == ["".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)) for w in words]


def test_group_of_expanding_characters(spark):
    df = spark.createDataFrame([("a_½.csv", "1⁄2"), ("pda_oﬁ.csv", "OFI"), ("x_\U0001d400.csv", "A")], "n string, g string")
    assert all(r.got == r.g for r in df.select("g", names.group_from_name("n").alias("got")).collect())


def test_file_stem_and_suffix(spark):
    rows = [("a/b/Arq.Final.CSV", "Arq.Final", ".csv"), (".bashrc", ".bashrc", ""), ("name.", "name.", ""), ("x", "x", "")]
    df = spark.createDataFrame(rows, "p string, stem string, suffix string")
    for r in df.select("stem", "suffix", names.file_stem("p").alias("s"), names.file_suffix("p").alias("x")).collect():
        assert (r.s, r.x) == (r.stem, r.suffix)


def test_names_cost_little_a_row(spark):
    """Time does not go with the number of characters that expand: 200,000 plain names, and long texts with one fraction."""
    import time

    rows = spark.range(0, 200_000, 1, 1).select(F.concat(F.lit("Customer#"), F.col("id").cast("string"), F.lit(" / BUILDING")).alias("n"))
    texts = spark.range(0, 20, 1, 1).select(F.concat(F.lit("½ é"), F.repeat(F.lit("palavras "), 10_000)).alias("n"))
    began = time.monotonic()
    assert rows.filter(names.safe_run_name("n").endswith("_BUILDING")).count() == 200_000
    assert texts.filter(names.strip_accents("n").startswith("1⁄2 epalavras ")).count() == 20
    assert time.monotonic() - began < 20
