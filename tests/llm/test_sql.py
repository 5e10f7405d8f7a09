"""The operators against their SQL where rows repeat an id, or have none."""
import duckdb
import pytest

from scoreline.llm import lines, quality, substrings

LONG = " ".join(f"w{k}" for k in range(60))
ROWS = [(7, "a shared line\nown words 1"), (None, f"x {LONG} y"), (None, None), (7, f"{LONG} z\n\n b b b b b b"), (8, ""), (8, "")] + [(5, "a shared line\nThe other " + "and the word " * 30) for _ in range(10)]


@pytest.mark.parametrize("op, sql", [(lines.op4_lines, lines.SQL["op4_lines"]), (quality.op5_quality, quality.SQL["op5_quality"]), (substrings.op10_substrings, substrings.SQL["op10_substrings"])])
def test_rows_that_repeat_an_id(spark, docs, table_dir, op, sql):
    where = table_dir(documents=docs(*ROWS).coalesce(1))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{where}/documents.parquet/*.parquet')")
    want = con.sql(sql)
    got = op(spark, where).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall())) and len(want.fetchall()) == len(ROWS)
