import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import embedding_dedup as ed


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    rows = [base[k] + rng.normal(scale=s, size=16) for k in range(40) for s in (0, 0.1, 0.3, 0.35)]
    rows += [rows[0]] * 5 + [rows[0] * 3, -rows[0]]
    return np.array(rows, dtype=np.float32)


@pytest.mark.parametrize(("block", "pivots"), [(2048, 1), (16, 8), (7, 1)])
def test_equals_brute_force(spark, block, pivots):
    x = vectors()
    df = spark.createDataFrame([(100 + k, v.tolist(), 1, "d") for k, v in enumerate(x)], "vec_id long, embedding array<float>, label int, digest string").repartition(3)
    got = {r.vec_id: r for r in ed.embedding_duplicates(df, block=block, max_pivots=pivots).collect()}
    y = x.astype(float)
    n = np.linalg.norm(y, axis=1)
    linked = (y @ y.T) / np.outer(n, n) >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[k], label[linked[k]].min(initial=k)) for k in range(len(x))])
        if (new == label).all():
            break
        label = new
    for k in range(len(x)):
        r = got[100 + k]
        assert (r.n_links, r.component_id, r.kept) == (linked[k].sum(), 100 + label[k], label[k] == k)


def test_edges_of_the_input(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (8, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in ed.embedding_duplicates(df).collect())
    assert got == [(0, 0, None, True), *[(k, 0, k, True) for k in range(1, 7)], (7, 2, 7, True), (8, 2, 7, False), (8, 2, 7, False), (9, 0, 9, True)]
    assert ed.embedding_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [0.02, 1.0]), (0, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("copies", F.lit(0)).withColumn("low", F.lit(0))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.embedding_duplicates(df).collect())
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False)]


def test_bounds_are_rigorous():
    x = np.random.default_rng(1).normal(size=(50, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = ed.quantise(x)
    assert (np.linalg.norm(x - q * s[:, None], axis=1) <= e + 1e-15).all() and e.max() < 0.03


def test_tasks_send_bounded_batches():
    """Of 2 million vectors that no pivot prunes each meets 61 groups; a task holds few of those rows at a time."""
    import pyarrow as pa

    x = vectors()
    grouped = ed._grouped({16: x[:2].astype(float)}, {(16, 0): (math.pi, 1_000_000), (16, 1): (math.pi, 1_000_000)}, 2048)
    groups = len(set(grouped[16][4]))
    assert groups == 61
    n = 2000
    few = ed._grouped({16: x[:2].astype(float)}, {(16, 0): (math.pi, 50_000), (16, 1): (math.pi, 50_000)}, 2048)
    assert len(set(few[16][4])) <= ed.GROUPS
    unit = x[np.arange(n) % len(x)] / np.linalg.norm(x[np.arange(n) % len(x)], axis=1)[:, None]
    columns = {"id": pa.array(range(n)), "copies": pa.array([1] * n), "embedding": pa.array(unit.tolist(), pa.list_(pa.float32())), "dims": pa.array([16] * n, pa.int32())}
    columns |= {"cell": pa.array([0] * n, pa.int32()), "block": pa.array([3] * n, pa.int32())}
    sent = list(ed._deal({16: x[:2].astype(float) / np.linalg.norm(x[:2].astype(float), axis=1)[:, None]}, grouped, 0.4)([pa.RecordBatch.from_pydict(columns)]))
    assert sum(len(b) for b in sent) == n * groups and max(len(b) for b in sent) <= ed.SENT
