"""Binary workbooks: what the test writer writes comes back; damaged ones are error rows."""

import datetime as dt
import io
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscalflow.plans import xls_landing as W
from fiscalflow.plans.ingest import ingest
from fiscalflow.sources import sheets, tabular, xls
from tests.fixtures import write, xlsx_bytes, zip_bytes


def read(data):
    return list(xls.rows(io.BytesIO(data)))


def shown(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat(sep=" ")
    return str(int(v)) if isinstance(v, (int, float)) and float(v).is_integer() and abs(v) < 1e15 else str(v)


def expected(rows):
    out = [[shown(v) for v in r] for r in rows]
    for r in out:
        while r and r[-1] is None:
            r.pop()
    while out and not out[-1]:
        out.pop()
    return out


cell = st.one_of(st.none(), st.booleans(), st.text(max_size=30), st.integers(-(2**40), 2**40), st.sampled_from([0.25, 10.5, -3.75, 1e-7, 12.34, 1 / 3, 2.0**60]), st.datetimes(dt.datetime(1905, 1, 1), dt.datetime(2200, 1, 1)).map(lambda d: d.replace(microsecond=0)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(cell, max_size=6), max_size=30), st.booleans(), st.sampled_from([40, 64, 8224]))
def test_cells_come_back(rows, date_1904, limit):
    rows = [[v for v in r] for r in rows]
    assert read(W.xls_bytes(rows, date_1904=date_1904, limit=limit)) == expected(rows)


def test_other_cell_records():
    f = lambda r, c, body: W.record(xls.FORMULA, struct.pack("<HHH", r, c, 0) + body + bytes(6))
    rows = [
        [W.record(xls.MULRK, struct.pack("<HH", 0, 1) + b"".join(struct.pack("<HI", s, W.rk(v)) for s, v in ((0, 7), (1, 45_000), (0, 0.25))) + struct.pack("<H", 3))],
        [W.record(xls.LABEL, struct.pack("<HHH", 1, 0, 0) + W.text("rótulo"))],
        [f(2, 0, struct.pack("<d", 2.5)), f(2, 1, b"\x00" + bytes(5) + b"\xff\xff"), W.record(xls.STRING, W.text("texto")), f(2, 2, b"\x01\x00\x01" + bytes(3) + b"\xff\xff"), f(2, 3, b"\x02\x00\x07" + bytes(3) + b"\xff\xff")],
        [W.record(xls.BOOLERR, struct.pack("<HHHBB", 3, 0, 0, 0x2A, 1)), W.record(xls.NUMBER, struct.pack("<HHHd", 3, 1, 2, 45_000.5))],
    ]
    assert read(W.xls_bytes(rows)) == [[None, "7", "2023-03-15", "0.25"], ["rótulo"], ["2.5", "texto", "true", "#DIV/0!"], ["#N/A", "2023-03-15 12:00:00"]]


@pytest.mark.parametrize("size", [512, 4096])
def test_large_and_small_files(size):
    rnd = random.Random(1)
    rows = [[f"chave {i}", i * 1.5, f"{i}" + "á" * rnd.randrange(700)] for i in range(12_000)]
    stream = W.workbook(rows)
    assert len(stream) > 109 * 128 * 512 or size == 4096
    assert read(W.compound(stream, size=size)) == expected(rows)
    assert read(W.compound(W.workbook([["a"], [1]]), size=size)) == [["a"], ["1"]]  # a small stream


def test_damaged_files_are_errors_and_end():
    good = W.xls_bytes([["k", "v"], *[[i, f"x{i}"] for i in range(500)]])
    rnd = random.Random(2)
    for _ in range(300):
        bad = bytearray(good)
        for _ in range(rnd.randrange(1, 6)):
            bad[rnd.randrange(len(bad))] = rnd.randrange(256)
        cut = bytes(bad[: rnd.randrange(len(bad))]) if rnd.random() < 0.3 else bytes(bad)
        try:
            read(cut)
        except Exception as e:  # noqa: BLE001 - any error, but an end
            assert not isinstance(e, (MemoryError, RecursionError))
    for data, why in ((b"\xd0\xcf", "cut off"), (b"PK" + bytes(600), "not a compound file"), (W.compound(b"x" * 5000, name="Outro"), "no workbook"), (W.compound(W.record(xls.FILEPASS, b"\0\0") + bytes(5000)), "encrypted"), (W.compound(W.record(xls.BOF, struct.pack("<HH", 0x0500, 5)) + bytes(5000)), "BIFF8")):
        with pytest.raises(ValueError, match=why):
            read(data)


def test_ingest_takes_xls_alone_in_archives_and_beside_others(spark, tmp_path):
    rows = [["id", "nome", "quando"], [1, "Ana", dt.datetime(2024, 5, 1)], [2, None, dt.datetime(2024, 5, 2)]]
    write(tmp_path / "in" / "a_IGR.xls", W.xls_bytes(rows))
    write(tmp_path / "in" / "b_IGR.xlsx", xlsx_bytes([["id", "nome", "quando"], ["3", "Rui", "2024-05-03"]]))
    write(tmp_path / "in" / "c_IGR.zip", zip_bytes({"d_IGR.XLS": W.xls_bytes([["id", "nome", "quando"], [4, "Eva", None]])}))
    write(tmp_path / "in" / "ruim_IGR.xls", W.xls_bytes(rows)[:700])
    res = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = sorted(tuple(r) for r in res.unified.select("id", "nome", "quando", "arquivo_origem").collect())
    assert [g[0] for g in got] == ["1", "2", "3", "4"] and got[0][:3] == ("1", "Ana", "2024-05-01") and got[3][3] == "c_IGR.zip::d_IGR.XLS"
    assert [r.arquivo for r in res.errors.collect()] == ["ruim_IGR.xls"]


def test_conversion_reports_bad_files(spark, tmp_path):
    good = {"a.xls": W.xls_bytes([["k", "v"], [1, "x"]]), "b.csv": b"k;v\n2;y\n"}
    bad = {"c.xls": b"\xd0\xcf", "d.csv": b"\n \n", "e.xlsx": b"PK", "f.txt": b"k\n", "g.parquet": b"PAR1"}
    paths = [str(write(tmp_path / "in" / n, d)) for n, d in (good | bad).items()]
    done = tabular.convert_tabular(spark, paths, str(tmp_path / "out"), fmt="parquet")
    assert sorted(r.k for f in done.folders for r in spark.read.parquet(f).collect()) == ["1", "2"]
    assert sorted(r.arquivo.rsplit("/", 1)[-1] for r in done.errors.collect()) == sorted(bad)


def test_a_task_streams_rows(spark, tmp_path):
    rows = [["k"], *[[i] for i in range(25_000)]]
    write(tmp_path / "a.xls", W.xls_bytes(rows))
    cells = sheets.spreadsheet_rows(spark.createDataFrame([(str(tmp_path / "a.xls"),)], "path string"))
    assert cells.count() == 25_001 and cells.where("erro IS NOT NULL").count() == 0
