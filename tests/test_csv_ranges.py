"""CSV by ranges: the same rows as one task reads, whatever the ranges; dialects by ranges; row-level rejects."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiscalflow.sources import csv_ranges as R
from fiscalflow.sources import dialect, files
from tests.fixtures import write

VALUES = ["", "a", "b;c", 'diz "oi"', "duas\nlinhas", "x\r\ny", '"', "\n\n", " ", "é", ";", '";"', "z" * 50, "1,5"]


def csv_bytes(rows, sep=";", end="\n", encoding="utf-8"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return out.getvalue().encode(encoding)


def random_rows(n, seed):
    rnd = random.Random(seed)
    return [[str(i), rnd.choice(VALUES), rnd.choice(VALUES)] for i in range(n)]


@pytest.fixture
def tiny_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def walked(data: bytes, cuts, sep=";"):
    """Records by the summaries of the lines cut into ranges at the given places."""
    lines = data.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    rows = []
    for k, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(lines)], strict=True)):
        seen = R.Range([R.Quotes(sep)])
        for line in lines[lo:hi]:
            seen.take(line)
        rows.append(seen.row(0, k))
    return R.walk(rows, 0), rows[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(VALUES), min_size=2, max_size=3), min_size=1, max_size=8), st.data())
def test_summaries_do_not_depend_on_the_ranges(rows, data):
    raw = csv_bytes([["k", *r] for r in rows])
    n = raw.count(b"\n")
    cuts = sorted(set(data.draw(st.lists(st.integers(0, n), max_size=4))))
    (starts, fields, broken), last = walked(raw, cuts)
    (_, whole_fields, whole_broken), whole = walked(raw, [])
    assert fields == whole_fields and broken == whole_broken
    total = starts[-1][1] + last[f"s0{int(starts[-1][0])}"]["records"]
    assert total == whole["s00"]["records"] == len(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(['"', ";", "a", '""', " "]), max_size=12).map("".join))
def test_automaton_follows_the_rules(text):
    line = text.encode()
    q = R.Quotes(";")

    def plain(inside):
        i, at_start = 0, not inside
        while i < len(line):
            c = line[i : i + 1]
            if inside:
                if c == b'"':
                    if line[i + 1 : i + 2] == b'"':
                        i += 1
                    else:
                        inside, at_start = False, False
            elif at_start and c == b'"':
                inside = True
            else:
                at_start = c == b";"
            i += 1
        return inside

    assert q.after(line, False) == plain(False)
    assert q.after(line, True) == plain(True)


@pytest.mark.parametrize(("sep", "end", "encoding"), [(";", "\n", "utf-8"), (",", "\r\n", "latin-1"), ("\t", "\n", "utf-8"), ("|", "\r\n", "utf-8")])
def test_many_tasks_read_one_file(spark, tmp_path, tiny_ranges, sep, end, encoding):
    rows = random_rows(300, sep)
    write(tmp_path / "a 1%.csv", csv_bytes([["k", "u", "v"], *rows], sep, end, encoding))
    path = str(tmp_path / "a 1%.csv")
    (d,) = dialect.detect_dialects(spark.createDataFrame([(path,)], "path string")).collect()
    assert (d.sep, d.multilinha, d.registros, d.encoding) == (sep, True, 301, "UTF-8" if encoding == "utf-8" else "ISO-8859-1")
    assert R.scan_lines(spark, [path]).select("block").distinct().count() > 10
    got = R.read_csv_by_ranges(spark, path, ["k", "u", "v"], sep=sep, encoding=d.encoding)
    key = lambda r: int(r[0])
    found = sorted((tuple(r) for r in got.select("k", "u", "v").collect()), key=key)
    assert found == [(k, u or None, v or None) for k, u, v in rows]
    if end == "\n":  # with other line ends Spark's one-task reader changes those within quotes
        whole = files.read_csv(spark, path, sep=sep, encoding=d.encoding, multiline=True)
        assert found == sorted((tuple(r) for r in whole.collect()), key=key)
    assert got.where(f"CAST(k AS int) + 1 != {R.ROW}").count() == 0
    assert got.where(F.col(files.REJECTED).isNotNull()).count() == 0


def test_many_tasks_read_one_typed_file(spark, tmp_path, tiny_ranges):
    rows = random_rows(300, 5)
    write(tmp_path / "a.csv", csv_bytes([["k", "u", "v"], *rows, ["x", "não é", "int"], ["7", "curta"]], ","))
    got = files.read_csv(spark, str(tmp_path / "a.csv"), schema="k int, u string, v string", multiline=True)
    assert got.rdd.getNumPartitions() > 10
    want = [(int(k), u or None, v or None) for k, u, v in rows] + [(None, "não é", "int"), (7, "curta", None)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_several_files_blank_lines_bom_and_lone_returns(spark, tmp_path, tiny_ranges):
    write(tmp_path / "a.csv", b"\xef\xbb\xbf\n  \nk;v\n1;\"x\ny\"\n\n2;b\n\n")
    write(tmp_path / "b.csv", b"k;v\r1;\"m\rn\"\r2;c\r")
    write(tmp_path / "c.csv", b"")
    write(tmp_path / "d.csv", b"k;v\n3;\"nunca fechado\n4;x\n")
    paths = [str(tmp_path / f"{n}.csv") for n in "abcd"]
    got = R.records(spark, paths, ";").collect()
    by = {n: [r.raw for r in sorted(got, key=lambda r: r.record) if r.path.endswith(f"{n}.csv")] for n in "abcd"}
    assert by["a"] == [b"k;v\n", b'1;"x\ny"\n', b"2;b\n"]
    assert [x.rstrip(b"\r\n") for x in by["b"]] == [b"k;v", b'1;"m\rn"', b"2;c"] and by["c"] == []
    assert by["d"][0] == b"k;v\n" and len(by["d"]) in (1, 2)
    found = {r.path.rsplit("/", 1)[-1]: r for r in dialect.detect_dialects(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    assert [found[f"{n}.csv"].header for n in "abcd"] == ["k;v", "k;v", "", "k;v"]
    assert [found[f"{n}.csv"].multilinha for n in "abcd"] == [True, True, False, True]


def test_separator_by_agreement_of_records():
    ragged = "id;valor\n" + "".join(f"{i};10,{i}\n" for i in range(50)) + "1;2;3\n" * 3
    assert dialect.sniff(ragged.encode())[1] == ";"  # every row has one comma, the header has none
    prose = "a|b\n" + "".join(f"{i}|um, dois, {'x, ' * (i % 4)}fim\n" for i in range(30))
    assert dialect.sniff(prose.encode())[1] == "|"
