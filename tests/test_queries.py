"""Every query against its SQL on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(v) for v in r) for r in df.select(cols).collect())
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for f in os.listdir(DATA):
            con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
        sql = f"select {', '.join(f'"{c}"' for c in cols)} from ({entry.oracle_sql()[name]})"
        assert rows == sorted(tuple(plain(v) for v in r) for r in con.sql(sql).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_the_core_does_without_the_subpackage():
    code = "import sys; sys.modules['synoptic.llm'] = None; import __spark_entry__ as e; assert 'p5_found' in e.queries() and 'p2_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
