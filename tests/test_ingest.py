"""Archives, end-to-end ingest, merge from a manifest, reruns."""

import pytest
from pyspark.sql import functions as F

from fiscalflow.plans.ingest import ingest, merge_from_manifest, norm_path, plain_path, tag_rows
from fiscalflow.sources import archives
from fiscalflow.sources.manifest import MANIFEST_SCHEMA, read_manifest, write_manifest
from tests.fixtures import corrupt_entry_zip, ods_bytes, write, xlsx_bytes, zip_bytes

IGR_A = "REGISTRO_ANS;COMPETENCIA;IGR;QTD_RECLAMACOES\n312924;202401;1,5;10\n346659;202401;2,25;4\n"
IGR_B = "REGISTRO_ANS;COMPETENCIA;IGR;QTD_RECLAMACOES\n312924;202402;1,75;12\n"


def test_zip_expansion_rules(spark, tmp_path):
    inner = zip_bytes({"pda-043-rpc-202401.csv": IGR_A})
    deep = zip_bytes({"d.csv": IGR_B})
    for _ in range(3):
        deep = zip_bytes({"n.zip": deep})
    outer = zip_bytes(
        {
            "dados/IGR_2024.csv": IGR_B,
            "Dicionário_de_dados.ods": ods_bytes([["a"]]),
            "leia-me.txt": "texto",
            "../fuga.csv": IGR_B,
            "interno.zip": inner,
            "fundo.zip": deep,
            "planilha.xlsx": xlsx_bytes([["x", "y"], [1, 2]]),
            "antigo.xls": b"\xd0\xcf\x11\xe0",
        }
    )
    write(tmp_path / "in" / "AC_202401_HOSP_CONS.zip", outer)
    write(tmp_path / "in" / "quebrado.zip", b"PK\x03\x04 nao e zip")
    rows = archives.zip_entries(
        spark.read.format("binaryFile").load(str(tmp_path / "in")), str(tmp_path / "land"), max_depth=2
    ).collect()
    by = {r.arquivo_origem: r for r in rows}
    ok = {k for k, r in by.items() if r.status == "ok"}
    assert "AC_202401_HOSP_CONS.zip::dados/IGR_2024.csv" in ok
    assert "AC_202401_HOSP_CONS.zip::interno.zip::pda-043-rpc-202401.csv" in ok
    assert "AC_202401_HOSP_CONS.zip::planilha.xlsx" in ok
    assert "AC_202401_HOSP_CONS.zip::../fuga.csv" in ok  # read, but landed under a hashed folder
    assert all(str(tmp_path / "land") in by[k].caminho_local for k in ok)
    assert by["AC_202401_HOSP_CONS.zip::Dicionário_de_dados.ods"].status == "ignorado"
    assert by["AC_202401_HOSP_CONS.zip::leia-me.txt"].status == "ignorado"
    assert by["AC_202401_HOSP_CONS.zip::antigo.xls"].status == "ok"  # landed; its reader will report it
    deep_err = [r for r in rows if r.status == "erro" and "depth" in (r.motivo or "")]
    assert len(deep_err) == 1 and deep_err[0].profundidade == 2
    # the outermost archive's group is kept by every nested entry
    assert {by[k].grupo_mescla_padrao for k in ok} == {"CONS"}
    assert [r.status for r in rows if r.arquivo_zip.endswith("quebrado.zip")] == ["erro"]


def test_corrupt_entry_is_an_error_row(spark, tmp_path):
    write(tmp_path / "in" / "c.zip", corrupt_entry_zip({"bom.csv": IGR_A}, "ruim.csv"))
    rows = archives.zip_entries(spark.read.format("binaryFile").load(str(tmp_path / "in")), str(tmp_path / "land")).collect()
    st = {r.nome_arquivo: r.status for r in rows}
    assert st == {"bom.csv": "ok", "ruim.csv": "erro"}


def test_same_stem_archives_do_not_collide(spark, tmp_path):
    write(tmp_path / "in" / "a" / "dados.zip", zip_bytes({"x.csv": IGR_A}))
    write(tmp_path / "in" / "b" / "dados.zip", zip_bytes({"x.csv": IGR_B}))
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert res.unified.count() == 3


def landing(tmp_path):
    root = tmp_path / "landing"
    write(root / "IGR.csv", IGR_A)
    write(root / "sub" / "IGR_extra.csv", IGR_B.replace(";", "|"), encoding="utf-8")
    write(root / "latin" / "IGR_antigo.csv", "REGISTRO_ANS;COMPETENCIA;IGR;QTD_RECLAMACOES\n419133;202312;3,5;1\n", encoding="latin-1")
    write(root / "pacote_IGR.zip", zip_bytes({"IGR_zip.csv": IGR_B, "Dicionario.csv": "a\n1\n"}))
    write(root / "planilha_IGR.xlsx", xlsx_bytes([["REGISTRO_ANS", "COMPETENCIA", "IGR", "QTD_RECLAMACOES"], [422631, 202403, "0,5", 2]]))
    write(root / "dicionario_de_dados.csv", "a\n")
    write(root / "notas.txt", "x")
    write(root / "velho.xls", b"\xd0\xcf")
    write(root / "vazio.csv", b"")
    return root


def test_ingest_end_to_end(spark, tmp_path):
    res = ingest(spark, str(landing(tmp_path)), str(tmp_path / "out"), where="REGISTRO_ANS <> '346659'")
    u = res.unified
    got = sorted((r.REGISTRO_ANS, r.COMPETENCIA, r.arquivo_origem, r.grupo_mescla) for r in u.collect())
    assert got == [
        ("312924", "202401", "IGR.csv", "IGR"),
        ("312924", "202402", "IGR_extra.csv", "EXTRA"),
        ("312924", "202402", "pacote_IGR.zip::IGR_zip.csv", "IGR"),
        ("419133", "202312", "IGR_antigo.csv", "ANTIGO"),
        ("422631", "202403", "planilha_IGR.xlsx", "IGR"),
    ]
    ign = {r.arquivo for r in res.ignored.collect()}
    assert {"dicionario_de_dados.csv", "notas.txt", "pacote_IGR.zip::Dicionario.csv"} <= ign
    errs = {r.arquivo for r in res.errors.collect()}
    assert errs == {"velho.xls"}  # zero-byte files are skipped by Spark's file listing
    assert res.manifest.count() == 6  # the damaged workbook is a listed file, too
    assert set(res.merge.outputs) == {"IGR", "EXTRA", "ANTIGO"}
    assert res.merge.group(spark, "IGR").count() == 3
    # the written manifest reads back as all-string
    m = read_manifest(spark, f"{res.out_dir}/manifesto")
    assert m.schema == MANIFEST_SCHEMA and m.count() == 6


def test_rerun_does_not_double_rows(spark, tmp_path):
    root = landing(tmp_path)
    a = ingest(spark, str(root), str(tmp_path / "out")).unified.count()
    b = ingest(spark, str(root), str(tmp_path / "out")).unified.count()
    assert a == b == 6


def test_columns_filters_and_missing_column(spark, tmp_path):
    root = landing(tmp_path)
    res = ingest(
        spark, str(root), str(tmp_path / "out"),
        columns=["REGISTRO_ANS", "IGR"], filters=[F.col("REGISTRO_ANS") == "312924"],
    )
    u = res.unified
    assert set(u.columns) == {"REGISTRO_ANS", "IGR", "arquivo_origem", "grupo_mescla"}
    assert {r.REGISTRO_ANS for r in u.collect()} == {"312924"}
    with pytest.raises(ValueError, match="nenhum arquivo"):
        ingest(spark, str(root), str(tmp_path / "out2"), columns=["NAO_EXISTE"])


def test_merge_from_manifest(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, s string").coalesce(1).write.parquet(str(tmp_path / "pq" / "pda-043-rpc-202401.parquet"))
    spark.createDataFrame([("2", 2.5)], "k string, v double").coalesce(1).write.parquet(str(tmp_path / "pq" / "pda-043-rpc-202402.parquet"))
    files = sorted(str(p) for p in (tmp_path / "pq").rglob("*.parquet") if p.is_file())
    rows = [
        (files[0], "x", "pda-043-rpc-202401.parquet", "u", "pda-043-rpc-202401.parquet", "", "t"),
        (files[1], "y", "pda-043-rpc-202402.parquet", "u", "pda-043-rpc-202402.parquet", " ", "t"),
        (str(tmp_path / "pq" / "sumiu.parquet"), "z", "sumiu.parquet", "u", "sumiu.parquet", "043", "t"),
        (files[0], "w", "dicionario.parquet", "u", "dicionario.parquet", "", "t"),
    ]
    man_path = write_manifest(spark.createDataFrame(rows, MANIFEST_SCHEMA), str(tmp_path / "manifesto"))
    res = merge_from_manifest(spark, man_path, str(tmp_path / "out"))
    assert set(res.merge.outputs) == {"043_RPC_2024"}
    u = res.unified
    assert dict(u.dtypes)["k"] == "string" and u.count() == 2
    assert [r.arquivo for r in res.errors.collect()] == ["sumiu.parquet"]
    assert [r.arquivo for r in res.ignored.collect()] == ["dicionario.parquet"]
    with pytest.raises(ValueError):
        merge_from_manifest(spark, spark.createDataFrame([], MANIFEST_SCHEMA), str(tmp_path / "o2"))


def test_rows_are_tagged_without_a_shuffle(spark, tmp_path):
    """Dealt by file, all rows of a large file went to one task."""
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    members = [{"caminho_local": norm_path(f), "arquivo_origem": "a.parquet", "grupo": "A"} for f in df.inputFiles()]
    tagged = tag_rows(df, members, spark, plain_path(F.col("_metadata.file_path")))
    assert "hashpartitioning" not in tagged._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.arquivo_origem, r.grupo_mescla) for r in tagged.collect()) == [(i, "a.parquet", "A") for i in range(10)]


def test_late_quotes_land_in_more_files_as_the_table_grows(spark, tmp_path, monkeypatch):
    from fiscalflow.plans import catalog
    from fiscalflow.sources import sinks

    rows = [(i, f"um {i}\n\"dois\"; {i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    seen, write_csv = [], sinks.write_csv
    monkeypatch.setattr(sinks, "write_csv", lambda df, *a, **k: seen.append(df.rdd.getNumPartitions()) or write_csv(df, *a, **k))
    monkeypatch.setattr(catalog, "_LATE_BYTES", 500)
    got = {(r.doc_id, r.text) for r in catalog.q_csv_late_quotes(spark, str(tmp_path)).collect()}
    assert got == {(str(i), t) for i, t in rows} | {(f"a{i}", t.replace("\n", " ")) for i, t in rows}
    assert seen[0] > 4
