import duckdb
import pytest

from eventlake.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    found = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in found.description]
    expected = sorted((tuple(r[columns.index(c)] for c in names) for r in found.fetchall()), key=str)
    assert got == expected
