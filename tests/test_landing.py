"""Landing stream: any kind of file once; a replayed batch adds nothing."""

from pyspark.sql import functions as F

from fiscalflow.plans.xls_landing import xls_bytes
from fiscalflow.streaming import landing as L
from tests.fixtures import write, zip_bytes


def test_archives_and_workbooks_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    write(src / "a_IGR.csv", "k;v\n1;a\n")
    write(src / "p_IGR.zip", zip_bytes({"x.csv": "k;v\n2;b\n", "dentro.zip": zip_bytes({"y.csv": "k;v\n3;c\n"})}))
    write(src / "b_IGR.xls", xls_bytes([["k", "w"], [4, 2.5]]))
    write(src / "ruim_IGR.xlsx", b"PK")
    first = L.run_landing(spark, str(src), out, ck)
    assert (first.batches, first.rows_written) == ([0], 4)
    assert [r.arquivo for r in L.read_landing_errors(spark, out).collect()] == ["ruim_IGR.xlsx"]
    assert L.run_landing(spark, str(src), out, ck).rows_written == 0
    write(src / "c_IGR.csv", "k;v\n5;e\n")
    second = L.run_landing(spark, str(src), out, ck)
    assert (second.batches, second.rows_written) == ([1], 1)
    rows = L.read_landing(spark, out).select("k", "arquivo_origem", "grupo_mescla", "lote").collect()
    assert sorted(tuple(r) for r in rows) == [("1", "a_IGR.csv", "IGR", 0), ("2", "p_IGR.zip::x.csv", "IGR", 0), ("3", "p_IGR.zip::dentro.zip::y.csv", "IGR", 0), ("4", "b_IGR.xls", "IGR", 0), ("5", "c_IGR.csv", "IGR", 1)]


def test_a_replayed_batch_adds_nothing(spark, tmp_path, monkeypatch):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    write(src / "a_IGR.csv", "k;v\n1;a\n2;b\n")
    real = L.write_parquet
    calls = []

    def dies(df, path, *a):
        real(df, path, *a)
        calls.append(path)
        if len(calls) == 2:  # rows and errors are written, the commit is not
            raise RuntimeError("driver gone")
        return path

    monkeypatch.setattr(L, "write_parquet", dies)
    try:
        L.run_landing(spark, str(src), out, ck)
        raise AssertionError
    except Exception as e:  # noqa: BLE001 - the stream wraps it
        assert "driver gone" in str(e)
    assert L.read_landing(spark, out) is None
    again = L.run_landing(spark, str(src), out, ck)
    assert again.rows_written == 2 and L.read_landing(spark, out).agg(F.count(F.lit(1)), F.countDistinct("k")).first()[:] == (2, 2)


def test_a_batch_without_a_readable_file(spark, tmp_path):
    write(tmp_path / "in" / "a_IGR.csv", " \n")
    run = L.run_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert run.rows_written == 0 and L.read_landing(spark, str(tmp_path / "out")) is None
    assert L.read_landing_errors(spark, str(tmp_path / "out")).count() == 1
