"""Every query of the library against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from gridloom.plans import artifacts, driver, statements, tables  # noqa: F401  (they register their queries)

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows):
    shown = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple("" if v is None else shown(v) for v in row) for row in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(driver.SQL))
def test_query(spark, duck, name):
    df = driver.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(driver.SQL[name])
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    assert canonical(df.select(*cols).collect()) == canonical([tuple(r[i] for i in order) for r in want.fetchall()])


def test_every_query_has_sql():
    assert set(driver.QUERIES) == set(driver.SQL)
