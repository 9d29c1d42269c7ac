"""Every query with an oracle gives the rows DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import rows_of


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(sf + "/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["txt14_drop_header_rows", "txt15_merge_continuations", "txt18_keep_three_columns"])
def test_whole_turns_are_read(spark, sf, name):
    ends = {r.text.strip(" ")[-20:] for r in spark.read.parquet(f"{sf}/conversations.parquet").where("length(text) > 60 and turn = 0").collect()}
    found = " ".join(r.description or "" for r in entry.queries()[name](spark, sf).collect())
    assert ends and all(e in found for e in ends)


def test_entry_reports_before_and_after(spark):
    report = entry.entry(spark)
    assert report.columns[:4] == ["c_custkey", "c_custkey_OBF", "c_name", "c_name_OBF"]
    assert report.count() == 150
