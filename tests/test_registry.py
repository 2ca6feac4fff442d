import duckdb
import pandas as pd
import pytest

from skyloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(df):
    show = lambda v: "null" if v is None or v is pd.NaT or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_sortedness_has_no_single_task_and_counts_by_file(spark, tmp_path):
    from skyloom.operators import checks

    for name, keys in (("a", [1, 2, 2, 1]), ("b", [0, 5, 3])):
        spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    both = spark.read.parquet(f"{tmp_path}/a", f"{tmp_path}/b")
    assert sorted(r.k for r in checks.unsorted(both, ["k"]).collect()) == [1, 3]
    assert sorted(r.k for r in checks.unsorted(both, ["k"], strict=True).collect()) == [1, 2, 3]
    plan = checks.unsorted(both, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
