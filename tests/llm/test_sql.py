import duckdb
import pytest

from seine.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want, got = c.execute(ORACLE[name]).fetchdf(), QUERIES[name](spark, SMALL).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    rows = lambda d: sorted(str([None if x != x else x for x in r]) for r in d[sorted(d.columns)].astype(object).values.tolist())
    assert rows(got) == rows(want)
