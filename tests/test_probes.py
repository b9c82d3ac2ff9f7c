"""Hand-made awkward files: every row comes back exactly, or its file is an error row."""

import zipfile

import pytest
from pyspark.sql import functions as F

from fiscalflow.operators.merge import with_lineage
from fiscalflow.operators.windows import with_partition_total
from fiscalflow.plans.ingest import ingest, merge_from_manifest
from fiscalflow.sources import dialect, files, sheets, sinks
from fiscalflow.streaming.incremental import read_output, run_incremental
from tests.fixtures import ods_bytes, write, xlsx_bytes


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_quoted_line_break_after_the_sample(spark, tmp_path):
    lines = [f"{i};texto simples numero {i}" for i in range(5000)]
    write(tmp_path / "in" / "a_IGR.csv", "id;t\n" + "\n".join(lines) + '\n9999;"um\ndois"\n')
    u = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).unified
    assert u.count() == 5001 and u.where("id = '9999'").first().t == "um\ndois"


def test_latin1_after_an_ascii_sample(spark, tmp_path):
    text = "id;t\n" + "".join(f"{i};ascii apenas aqui\n" for i in range(8000)) + "x;São João\n"
    assert len(text) > 100_000
    write(tmp_path / "in" / "a_IGR.csv", text, encoding="latin-1")
    u = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).unified
    assert u.where("id = 'x'").first().t == "São João"


def test_encoding_is_that_of_all_lines():
    assert dialect.sniff(("a;b\n" + "é;1\n" * 50).encode())[0] == "UTF-8"
    assert dialect.sniff("é;1\n".encode("latin-1") + b"a;b\n" * 5)[0] == "ISO-8859-1"
    assert dialect.sniff(b"a;b\n\xc3;1\nx;y\n")[0] == "ISO-8859-1"


def test_names_with_special_characters(spark, tmp_path):
    for i, name in enumerate(["a+b_IGR.csv", "a 100%_IGR.csv", "dados[1]_IGR.csv", "x{y}*_IGR.csv", "q?_IGR.csv"]):
        write(tmp_path / "in" / name, f"id;v\n{i};{name}\n")
    write(tmp_path / "in" / "c 5%+_IGR.xlsx", xlsx_bytes([["id", "v"], ["9", "c 5%+_IGR.xlsx"]]))
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = rows(res.unified, "arquivo_origem", "v")
    assert len(got) == 6 and all(a == b for a, b in got) and res.errors.count() == 0


def test_columns_named_like_helpers_stay(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "path;Row_Idx;v;arquivo_origem\n1;2;3;antigo\n")
    write(tmp_path / "in" / "b_IGR.xlsx", xlsx_bytes([["path", "Row_Idx", "v"], ["4", "5", "6"]]))
    u = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).unified
    assert rows(u, "path", "Row_Idx", "v", "arquivo_origem") == [("1", "2", "3", "a_IGR.csv"), ("4", "5", "6", "b_IGR.xlsx")]


def test_corrupt_workbook_is_an_error_row(spark, tmp_path):
    write(tmp_path / "in" / "ruim_IGR.xlsx", b"PK nao e planilha")
    write(tmp_path / "in" / "bom_IGR.csv", "id\n1\n")
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert res.unified.count() == 1
    assert [r.arquivo for r in res.errors.collect()] == ["ruim_IGR.xlsx"]
    assert [r.arquivo_origem for r in res.files_read.collect()] == ["bom_IGR.csv"]


def test_csv_round_trip_keeps_values(spark, tmp_path):
    values = ["  antes", "depois  ", "", None, 'diz "oi", ok', "duas\nlinhas", "\ttab", "a\\b"]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), schema="k int, v string", multiline=True)
    assert {r.k: r.v for r in back.collect()} == dict(enumerate(values))
    run_incremental(spark, str(tmp_path / "c"), "k int, v string", str(tmp_path / "s"), checkpoint=str(tmp_path / "ck"))
    assert {r.k: r.v for r in read_output(spark, str(tmp_path / "s")).collect()} == dict(enumerate(values))


def test_unmappable_characters_fail_the_write(spark, tmp_path):
    with pytest.raises(Exception, match="cannot hold"):
        sinks.write_csv(spark.createDataFrame([("preço €",)], "v string"), str(tmp_path / "c"), encoding="ISO-8859-1")
    sinks.write_csv(spark.createDataFrame([("ação",), (None,)], "v string"), str(tmp_path / "d"), encoding="ISO-8859-1")
    assert files.read_csv(spark, str(tmp_path / "d"), encoding="ISO-8859-1").where("v = 'ação'").count() == 1


def test_ragged_rows_are_counted(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "x;y\n1;2\n1;2;EXTRA\n3\n4;5\n")
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert rows(res.rejects, "arquivo", "linhas") == [("a_IGR.csv", 2)] and res.unified.count() == 4


def test_typed_columns_and_numeric_predicate(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "\nk;v\n3;a\n5;b\nruim;c\n")
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema="k int", where="k > 4")
    assert rows(res.unified, "k", "v") == [(5, "b")]
    assert rows(res.rejects, "arquivo", "linhas") == [("a_IGR.csv", 1)]


def test_own_manifest_can_be_merged_again(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "k;v\n1;a\n")
    write(tmp_path / "in" / "b_IGR.xlsx", xlsx_bytes([["k", "v"], ["2", "b"]]))
    write(tmp_path / "in" / "c_IGR.ods", ods_bytes([["k", "v"], ["3", "c"]]))
    first = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), merge=False)
    again = merge_from_manifest(spark, f"{first.out_dir}/manifesto", str(tmp_path / "m"))
    assert rows(again.unified, "k", "v") == [("1", "a"), ("2", "b"), ("3", "c")]


def test_single_file_rule_is_about_the_whole_input(spark, tmp_path):
    write(tmp_path / "um" / "a_IGR.csv", "k\n1\n")
    res = ingest(spark, str(tmp_path / "um"), str(tmp_path / "o1"), merge_single=False)
    assert res.merge.outputs == {} and rows(res.unified, "k", "grupo_mescla") == [("1", "IGR")]
    for n in ("a_IGR", "b_IGR", "c_VCM"):
        write(tmp_path / "tres" / f"{n}.csv", "k\n1\n")
    res = ingest(spark, str(tmp_path / "tres"), str(tmp_path / "o3"), merge_single=False)
    assert res.unified.count() == 3 and set(res.merge.outputs) == {"IGR", "VCM"}


def test_metadata_columns_left_out(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "k\n1\n")
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), include_metadata=False)
    assert res.unified.columns == ["k"]


def test_ods_repeats_comments_and_blanks(tmp_path):
    t, o, x = (f"urn:oasis:names:tc:opendocument:xmlns:{k}:1.0" for k in ("table", "office", "text"))
    body = (
        '<table:table-row><table:table-cell><office:annotation><text:p>nota</text:p></office:annotation><text:p>a<text:s text:c="3"/>b</text:p></table:table-cell></table:table-row>'
        '<table:table-row table:number-rows-repeated="3"><table:table-cell/></table:table-row>'
        '<table:table-row table:number-rows-repeated="2"><table:table-cell table:number-columns-repeated="2"><text:p>x</text:p></table:table-cell></table:table-row>'
    )
    xml = f'<office:document-content xmlns:office="{o}" xmlns:table="{t}" xmlns:text="{x}"><office:body><office:spreadsheet><table:table>{body}</table:table></office:spreadsheet></office:body></office:document-content>'
    path = tmp_path / "a.ods"
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("content.xml", xml)
    assert sheets.read_ods(path.read_bytes()) == [["a   b"], [], [], [], ["x", "x"], ["x", "x"]]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_no_exchange_of_rows_for_lineage_and_totals(spark, tmp_path):
    """With the broadcast threshold set low, the large side still does not move."""
    spark.range(2000).select("id", (F.col("id") % 7).alias("g"), F.lit(1.0).alias("v")).write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1kb")
    try:
        assert "Exchange" not in final_plan(with_lineage(fact))
        plan = final_plan(with_partition_total(fact, "g", "v", "grupo", "total"))
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_local_scratch_on_a_cluster(monkeypatch):
    from fiscalflow import session

    class Context:
        master = "spark://cluster:7077"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()  # noqa: N815
        conf: dict = {}

    with pytest.raises(ValueError, match="all machines share"):
        session.checkpoint_root(Session())


def test_headers_with_a_dot(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "valor.total;k`x\n1;2\n")
    write(tmp_path / "in" / "b_IGR.csv", "k`x;outra\n3;4\n")
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema="`valor.total` int", columns=None)
    got = {tuple(r[:3]) for r in res.unified.select("`valor.total`", "`k``x`", "outra").collect()}
    assert got == {(1, "2", None), (None, "3", "4")} and res.errors.count() == 0
    only = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out2"), columns=["valor.total"])
    assert only.unified.columns[0] == "valor.total" and [r.arquivo for r in only.errors.collect()] == ["b_IGR.csv"]


def test_headers_that_differ_in_case_and_repeat(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", "Nome;k\nAna;1\n")
    write(tmp_path / "in" / "b_IGR.csv", "nome;k;K\nRui;2;3\n")
    write(tmp_path / "in" / "c_IGR.xlsx", xlsx_bytes([["NOME", "k", "k"], ["Eva", "4", "5"]]))
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(c.lower() for c in res.unified.columns) == ["arquivo_origem", "grupo_mescla", "k", "k_2", "nome"]
    assert rows(res.unified.fillna(""), "Nome", "k", "K_2") == [("Ana", "1", ""), ("Eva", "4", "5"), ("Rui", "2", "3")]


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    write(tmp_path / "in" / "x" / "igual.csv", "k;v\n1;a\nruim\n")
    write(tmp_path / "in" / "y" / "igual.csv", " \n")
    write(tmp_path / "in" / "z" / "p.zip", zip_of({"igual.csv": b"k;v\n2;b\n"}))
    write(tmp_path / "in" / "w" / "p.zip", zip_of({"igual.csv": b"k;v\n3;c\n"}))
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), group="G", merge_single=False)
    assert [r.arquivo for r in res.errors.collect()] == ["y/igual.csv"]
    assert sorted(r.arquivo_origem for r in res.files_read.collect()) == ["w/p.zip::igual.csv", "x/igual.csv", "z/p.zip::igual.csv"]
    assert rows(res.rejects, "arquivo", "linhas") == [("x/igual.csv", 1)]
    assert rows(res.unified.where("k != 'ruim'"), "k", "arquivo_origem") == [("1", "x/igual.csv"), ("2", "z/p.zip::igual.csv"), ("3", "w/p.zip::igual.csv")]
    assert set(res.merge.outputs) == {"G"}  # three files, though of two names


def zip_of(entries):
    from tests.fixtures import zip_bytes

    return zip_bytes(entries)


def test_faults_by_row_of_csv_and_workbooks(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", 'k;v;t\n1;2;"x\ny"\nruim;3;z\n4;cinco;w;EXTRA\n\n6;7\n')
    write(tmp_path / "in" / "b_IGR.xlsx", xlsx_bytes([["k", "v", "t"], ["8", "9", "ok"], ["oito", "9", "mau"]]))
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema="k int, v int", merge=False)
    found = rows(res.rejected_rows().fillna(""), "arquivo", "registro", "coluna", "motivo", "linha")
    wide = "numero de valores diferente do cabecalho"
    assert found == [
        ("a_IGR.csv", 2, "k", "nao e int", "ruim;3;z"), ("a_IGR.csv", 3, "", wide, "4;cinco;w;EXTRA"), ("a_IGR.csv", 3, "v", "nao e int", "4;cinco;w;EXTRA"), ("a_IGR.csv", 4, "", wide, "6;7"),
        ("b_IGR.xlsx", 2, "k", "nao e int", '["oito","9","mau"]'),
    ]
    assert rows(res.rejects, "arquivo", "linhas") == [("a_IGR.csv", 3), ("b_IGR.xlsx", 1)]
