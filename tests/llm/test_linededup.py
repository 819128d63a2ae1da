"""Line dedup against its SQL and on edge cases."""

import duckdb
import pyarrow as pa

from pricewise.llm import linededup


def both(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.drop_boilerplate(docs).collect()), key=str)
    d, t, s, n = zip(*rows) if rows else ((),) * 4
    documents = pa.table({"doc_id": pa.array(d, pa.int64()), "text": pa.array(t, pa.string()), "source": pa.array(s, pa.string())})  # noqa: F841
    want = duckdb.connect().execute("SELECT doc_id, text, n_lines, n_dropped FROM (" + linededup.SQL + ")")
    return got, sorted(want.fetchall(), key=str)


def test_rules_and_edge_cases(spark):
    rows = [(i, f"menu\nown {i}\n\n menu \t\nend", "a", "c") for i in range(6)]
    rows += [(10 + i, f"few {i % 4}\nx{i}", "b", "c") for i in range(8)]
    rows += [(30, None, "a", None), (31, "", "a", None), (32, "menu", "a", None), (33, "menu\r\n\r\nmenu", None, None), (None, "menu\nnull id", "a", None)]
    rows += [(40, "same\nrow", "c", None)] * 7 + [(50, "line\n" * 30_000 + "menu", "a", None)]
    rows += [(60 + i, "rare" if i < 5 else f"r{i}", "d", None) for i in range(50)]
    got, want = both(spark, rows)
    assert got == want
    by = {r[0]: r for r in got}
    assert by[0][1] == "own 0\n" and by[32][1] == "" and by[30][1] is None and by[40][1] == ""
    assert by[10][1] == "few 0\nx0" and by[33][1] == "menu\r\n\r\nmenu"
    assert by[60][1] == "rare"  # 5 of 50: equal to the ratio


def test_empty(spark):
    assert both(spark, [])[0] == []
