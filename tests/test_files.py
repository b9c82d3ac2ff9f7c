"""CSV dialects and encodings, spreadsheets, lenient casts, Parquet folders."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.sources import dialect, files, sheets, tabular
from tests.fixtures import ods_bytes, write, xlsx_bytes

TABLE = [("1", "Ana", "10,5"), ("2", "José", "3"), ("3", "Çá", "7,25")]


def csv_text(sep: str) -> str:
    rows = [[v.replace(",", ".") if sep == "," else v for v in r] for r in TABLE]
    return "\n".join([sep.join(["id", "nome", "valor"])] + [sep.join(r) for r in rows]) + "\n"


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_sniff_separator(sep):
    enc, got, header = dialect.sniff(csv_text(sep).encode("utf-8"))
    assert (enc, got) == ("UTF-8", sep) and header == sep.join(["id", "nome", "valor"])


def test_one_column_falls_back_to_semicolon():
    assert dialect.sniff(b"valor\n1\n2\n")[1] == ";"


def test_encodings_and_bom():
    assert dialect.sniff(csv_text(";").encode("latin-1"))[0] == "ISO-8859-1"
    enc, _, header = dialect.sniff(b"\xef\xbb\xbf" + csv_text(";").encode("utf-8"))
    assert enc == "UTF-8" and header.startswith("id")


def test_sample_cut_inside_a_character_is_still_utf8():
    body = ("a;b\n" + "x" * 99_995 + "é;1\n").encode("utf-8")
    sample = body[:100_000]
    with pytest.raises(UnicodeDecodeError):
        sample.decode("utf-8")
    assert dialect.sniff(sample)[0] == "UTF-8"


def test_detect_and_read_equal_across_encodings(spark, tmp_path):
    write(tmp_path / "u.csv", csv_text(";"))
    write(tmp_path / "b.csv", b"\xef\xbb\xbf" + csv_text(";").encode("utf-8"))
    write(tmp_path / "l.csv", csv_text(";"), encoding="latin-1")
    listing = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    found = {r.path.rsplit("/", 1)[-1]: r for r in dialect.detect_dialects(listing).collect()}
    assert found["l.csv"].encoding == "ISO-8859-1" and found["u.csv"].encoding == "UTF-8"
    results = []
    for name, r in sorted(found.items()):
        df = files.read_csv(spark, r.path, sep=r.sep, encoding=r.encoding)
        results.append(sorted(tuple(x) for x in df.collect()))
        assert df.columns == ["id", "nome", "valor"]
    assert results[0] == results[1] == results[2]


def test_bad_values_become_null_and_are_counted(spark, tmp_path):
    write(tmp_path / "x.csv", "id;v\n1;10\n2;abc\n3;\n4;4\n")
    raw = files.read_csv(spark, str(tmp_path / "x.csv"), sep=";")
    typed, rejects = files.cast_with_rejects(raw, T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())]))
    assert sorted((r.id, r.v) for r in typed.collect()) == [(1, 10), (2, None), (3, None), (4, 4)]
    assert rejects.first().asDict() == {"id": 0, "v": 1}


def test_header_only_csv_reads_empty(spark, tmp_path):
    write(tmp_path / "h.csv", "a;b\n")
    df = files.read_csv(spark, str(tmp_path / "h.csv"), sep=";")
    assert df.columns == ["a", "b"] and df.count() == 0


def test_spreadsheets(spark, tmp_path):
    rows = [["id", "nome", "valor"], [1, "Ana", 10.5], [2, "José", None], [3, None, 7]]
    write(tmp_path / "a.xlsx", xlsx_bytes(rows))
    write(tmp_path / "b.ods", ods_bytes(rows))
    cells = sheets.spreadsheet_rows(spark.read.format("binaryFile").load(str(tmp_path)))
    classes = sheets.promote_header(cells)
    assert len(classes) == 1
    names, df = classes[0]
    assert names == ["id", "nome", "valor"]
    got = sorted((r[sheets.PATH].rsplit(".", 1)[-1], r.id, r.nome, r.valor) for r in df.collect())
    assert got == [
        ("ods", "1", "Ana", "10.5"), ("ods", "2", "José", None), ("ods", "3", None, "7"),
        ("xlsx", "1", "Ana", "10.5"), ("xlsx", "2", "José", None), ("xlsx", "3", None, "7"),
    ]


def test_parquet_dir_one_scan_per_schema(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, s string").write.parquet(str(tmp_path / "p1"))
    for i, f in enumerate((tmp_path / "p1").glob("*.parquet")):
        f.rename(tmp_path / f"ano{i}_2023.PARQUET")
    spark.createDataFrame([("2", 1.5)], "k string, v double").write.parquet(str(tmp_path / "p2"))
    for i, f in enumerate((tmp_path / "p2").glob("*.parquet")):
        f.rename(tmp_path / f"ano{i}_2024.parquet")
    write(tmp_path / "notas.txt", "x")
    scans = files.scan_parquet_dir(spark, str(tmp_path))
    assert len(scans) == 2
    from fiscalflow.operators.union import relaxed_union

    u = relaxed_union(scans)
    assert dict(u.dtypes) == {"k": "string", "s": "string", "v": "double"}
    assert sorted(r.k for r in u.collect()) == ["1", "2"]


def test_convert_tabular_to_csv_and_parquet(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", csv_text(";"))
    write(tmp_path / "in" / "b.xlsx", xlsx_bytes([["id", "nome", "valor"], [4, "Rui", "1,5"]]))
    paths = [str(tmp_path / "in" / "a.csv"), str(tmp_path / "in" / "b.xlsx")]
    outs = tabular.convert_tabular(spark, paths, str(tmp_path / "csv")).folders
    assert len(outs) == 2
    back = [files.read_csv(spark, o, sep=",") for o in outs]
    assert sorted(r.id for df in back for r in df.collect()) == ["1", "2", "3", "4"]
    pq = tabular.convert_tabular(spark, paths, str(tmp_path / "pq"), fmt="parquet").folders
    assert sum(spark.read.parquet(o).count() for o in pq) == 4


def test_url_file_name(spark):
    from fiscalflow.functions.urls import url_file_name

    df = spark.createDataFrame([("https://x.org/FTP/PDA/Dados%20ANS%C3%A7.csv?x=1",), ("ftp://h/a/",)], "u string")
    assert [r.n for r in df.select(url_file_name("u").alias("n")).collect()] == ["Dados ANSç.csv", ""]


def test_quoted_newlines_are_detected_and_read(spark, tmp_path):
    from fiscalflow.plans.ingest import ingest

    write(tmp_path / "in" / "notas.csv", 'id;texto\n1;"linha um\nlinha dois"\n2;simples\n')
    write(tmp_path / "in" / "outras.csv", "id;texto\n3;sem quebra\n")
    d = {r.path.rsplit("/", 1)[-1]: r.multilinha for r in dialect.detect_dialects(
        spark.read.format("binaryFile").load(str(tmp_path / "in")).select("path")).collect()}
    assert d == {"notas.csv": True, "outras.csv": False}
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), group="NOTAS")
    got = sorted((r.id, r.texto) for r in res.unified.collect())
    assert got == [("1", "linha um\nlinha dois"), ("2", "simples"), ("3", "sem quebra")]
