"""Every registered query against its DuckDB oracle on the smallest test data,
plus the driver contract (entry / queries / oracle_sql)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

SF = os.environ.get("RATETIDE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

import __spark_entry__ as E  # noqa: E402

KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from compare import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_contract(spark):
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    df = E.entry(spark)
    assert df.columns[:2] == ["broad_region", "property_type"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    from compare import digest

    sql = E.oracle_sql().get(key)
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    if sql is None:
        pytest.skip("no oracle")
    cur = duck.execute(sql)
    d = digest([c[0] for c in cur.description], cur.fetchall())
    s = digest(sdf.columns, srows)
    assert s[0] == d[0]
    assert s[1] == d[1]
    assert s[2] == d[2], (sorted(set(s[3]) - set(d[3]))[:3], sorted(set(d[3]) - set(s[3]))[:3])
