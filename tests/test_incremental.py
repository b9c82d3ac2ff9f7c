"""Incremental ingest: each file once; reruns add nothing."""

from fiscalflow.streaming.incremental import read_output, run_incremental
from tests.fixtures import write

SCHEMA = "REGISTRO_ANS long, COMPETENCIA int, QTD_RECLAMACOES long"


def test_each_file_once(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    write(src / "IGR_2024.csv", "REGISTRO_ANS,COMPETENCIA,QTD_RECLAMACOES\n1,202401,3\n2,202401,4\n")
    r1 = run_incremental(spark, str(src), SCHEMA, out, ck)
    assert r1.rows_written == 2
    r2 = run_incremental(spark, str(src), SCHEMA, out, ck)
    assert r2.rows_written == 0
    write(src / "IGR_2025.csv", "REGISTRO_ANS,COMPETENCIA,QTD_RECLAMACOES\n1,202501,5\n")
    r3 = run_incremental(spark, str(src), SCHEMA, out, ck)
    assert r3.rows_written == 1
    df = read_output(spark, out)
    assert sorted((r.arquivo_origem, r.grupo_mescla, r.QTD_RECLAMACOES) for r in df.collect()) == [
        ("IGR_2024.csv", "2024", 3), ("IGR_2024.csv", "2024", 4), ("IGR_2025.csv", "2025", 5),
    ]
