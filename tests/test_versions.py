"""Merges by version: only groups whose files changed are merged again; a run that dies leaves the version before."""

import os
import time

import pytest

from fiscalflow.plans import versions as V
from tests.fixtures import write, zip_bytes


def contents(spark, out, number=None):
    return sorted((r.k, r.grupo_mescla, r.desde) for r in V.read_version(spark, str(out), number).collect())


def test_only_changed_groups_are_merged(spark, tmp_path, monkeypatch):
    src, out = tmp_path / "in", tmp_path / "out"
    write(src / "a_NORTE.csv", "k;v\n1;a\n")
    write(src / "b_NORTE.csv", "k;v\n2;b\n")
    write(src / "c_SUL.csv", "k;outra\n3;c\n")
    write(src / "d_LESTE.zip", zip_bytes({"d.csv": "k;v\n4;d\n"}))
    first = V.merge_changed(spark, str(src), str(out))
    assert (first.number, first.merged) == (1, ["LESTE", "NORTE", "SUL"])
    assert contents(spark, out) == [("1", "NORTE", 1), ("2", "NORTE", 1), ("3", "SUL", 1), ("4", "LESTE", 1)]
    assert V.merge_changed(spark, str(src), str(out)).merged == [] and V.latest(spark, str(out)) == 1

    os.utime(src / "c_SUL.csv", (time.time() + 50, time.time() + 50))  # touched, but the same
    assert V.merge_changed(spark, str(src), str(out)).merged == []

    write(src / "e_NORTE.csv", "k;v\n5;e\n")  # a new file
    second = V.merge_changed(spark, str(src), str(out))
    assert (second.number, second.merged, second.removed) == (2, ["NORTE"], [])
    assert contents(spark, out) == [("1", "NORTE", 2), ("2", "NORTE", 2), ("3", "SUL", 1), ("4", "LESTE", 1), ("5", "NORTE", 2)]
    assert len(contents(spark, out, 1)) == 4  # the version before is still there

    write(src / "c_SUL.csv", "k;outra\n6;c\n")  # other content of the same size
    os.utime(src / "c_SUL.csv", (time.time() + 90, time.time() + 90))
    (src / "d_LESTE.zip").unlink()
    write(src / "f_OESTE.csv", " \n")  # cannot be read
    real = V.ingest
    monkeypatch.setattr(V, "ingest", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executors gone")))
    with pytest.raises(RuntimeError):
        V.merge_changed(spark, str(src), str(out))
    assert V.latest(spark, str(out)) == 2 and len(contents(spark, out)) == 5
    monkeypatch.setattr(V, "ingest", real)
    third = V.merge_changed(spark, str(src), str(out))
    assert (third.number, third.merged, third.removed) == (3, ["SUL"], ["LESTE", "OESTE"])
    assert [r.arquivo for r in third.errors.collect()] == ["f_OESTE.csv"]
    assert contents(spark, out) == [("1", "NORTE", 2), ("2", "NORTE", 2), ("5", "NORTE", 2), ("6", "SUL", 3)]

    fourth = V.merge_changed(spark, str(src), str(out), where="k > 1")  # other options: all groups
    assert fourth.merged == ["NORTE", "SUL"] and [c[0] for c in contents(spark, out)] == ["2", "5", "6"]


def test_fingerprints_do_not_depend_on_the_ranges(spark, tmp_path):
    path = str(write(tmp_path / "a.csv", "".join(f"{i};{'x' * (i % 50)}\n" for i in range(2000))))
    other = str(write(tmp_path / "b.csv", "".join(f"{i ^ 1};{'x' * ((i ^ 1) % 50)}\n" for i in range(2000))))
    whole = V.fingerprints(spark, [path]).first().impressao
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        assert V.fingerprints(spark, [path]).first().impressao == whole != V.fingerprints(spark, [other]).first().impressao
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
