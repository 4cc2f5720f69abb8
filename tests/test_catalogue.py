"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from pagewright.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:
        if want[c].dtype.kind in "fiub" and got[c].dtype.kind in "fiub":
            want[c] = want[c].astype(got[c].dtype)
    assert rows(got) == rows(want)
