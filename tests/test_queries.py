"""Registered queries against their SQL on the smallest tables."""

import glob
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
TABLES = "/root/testdata/sf0.001"
if not os.path.isdir(TABLES):
    pytest.skip("no tables", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402
from check_oracles import canonical  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, TABLES)
    result = duck.sql(entry.oracle_sql()[name])
    want = canonical(result.columns, result.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", sorted(entry.queries().keys() - entry.oracle_sql().keys()))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, TABLES).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["target", "n", "median_ch0"]
