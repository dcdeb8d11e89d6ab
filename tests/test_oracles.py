import duckdb
import pytest

import __spark_entry__ as entry
from folio.plans import registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(repr([r[k] for k in order]) for r in found)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = rows(names, rel.fetchall())
    assert len(got) == len(want) and got == want, [(a, b) for a, b in zip(got, want) if a != b][:3]


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
