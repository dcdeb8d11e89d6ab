import duckdb
import pytest

from folio.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    names = sorted(d[0] for d in want.description)
    columns = [d[0] for d in want.description]
    want = sorted(tuple(r[columns.index(n)] for n in names) for r in want.fetchall())
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == names
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == want
