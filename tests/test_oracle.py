"""Every registered query against its DuckDB oracle on the driver tables (sf0.001)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakeward.plans.registry import QUERIES
from tools.oracle_check import TABLES, digest

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    """Operators that SQL can't express are tested against brute force in their own folder."""
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [r.asDict() for r in df.collect()]
    cols = sorted(df.columns)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert cols == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, cols) == digest(orows, cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "__START_AT" in df.columns
