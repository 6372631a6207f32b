"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from eventlake.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    found = oracle.execute(registry.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    expected = sorted((tuple(r[columns.index(c)] for c in names) for r in found.fetchall()), key=str)
    assert got == expected


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
