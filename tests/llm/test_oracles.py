import duckdb
import pytest

from skyloom.llm import queries
from skyloom.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        db.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    found = db.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    want = sorted(found.fetchall(), key=str)
    out = queries.queries()[name](spark, SF)
    assert sorted(out.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str) == want
