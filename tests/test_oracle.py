"""Every registered query against its DuckDB reference SQL on the smallest
given tables (the driver repeats this at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "email", "name", "total_events", "max_event_types"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert df.columns and (rows or name == "pipeline")
        return
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)
