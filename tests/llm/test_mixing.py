from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyloom.llm import mixing


def brute(cells, lang, topic, source, cycles=200):
    total = sum(cells.values())
    w = {k: n / total for k, n in cells.items()}
    for _ in range(cycles):
        for axis, goal in ((0, source), (1, lang), (2, topic)):
            now = defaultdict(float)
            for k, x in w.items():
                now[k[axis]] += x
            w = {k: x * goal[k[axis]] / now[k[axis]] for k, x in w.items()}
    return {k: x / (cells[k] / total) for k, x in w.items()}


@pytest.mark.parametrize("held", [mixing.MAX_SMALL, 11])
def test_raking_equals_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(mixing, "MAX_SMALL", held)
    cells = {(f"s{a}", f"l{b}", f"t{c}"): 1 + (a * 7 + b * 3 + c * 11) % 13 for a in range(5) for b in range(3) for c in range(4)}
    lang, topic = {"l0": 0.5, "l1": 0.3, "l2": 0.2}, {"t0": 0.1, "t1": 0.2, "t2": 0.3, "t3": 0.4}
    source = {f"s{a}": (a + 1) / 15 for a in range(5)}
    df = spark.createDataFrame([(*k, n) for k, n in cells.items()], "source string, lang string, topic string, n long")
    got, errors = mixing.rake(df, lang, topic, sources=spark.createDataFrame(list(source.items()), "source string, share double"))
    want = brute(cells, lang, topic, source)
    assert errors[-1] < 1e-6
    for r in got.collect():
        assert r.weight == pytest.approx(want[r.source, r.lang, r.topic], rel=1e-4)


def test_mix_is_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.mixture(docs, keep=0.6).cache()
    r = out.agg((F.sum(F.col("tokens") * F.col("probability")) / F.sum("tokens")).alias("e"), F.avg(F.col("sampled").cast("double")).alias("s"), F.avg("probability").alias("p"), F.max("probability").alias("m")).first()
    assert r.e == pytest.approx(0.6, abs=0.01) and r.s == pytest.approx(r.p, abs=0.05) and r.m <= 1
    assert out.count() == docs.count()
    drawn = lambda d: {(r.doc_id, r.sampled) for r in d.select("doc_id", "sampled").collect()}
    assert drawn(out) == drawn(mixing.mixture(docs.repartition(5), keep=0.6))


def test_edges_of_the_input(spark):
    rows = [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "x" * 50_000, "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("weight", F.lit(1)).withColumn("n", F.lit(1))
    got = mixing.mixture(df).collect()
    assert len(got) == 4 and {r.lang for r in got} == {"(none)", "en"} and len({r.sampled for r in got if r.doc_id == 1}) == 1
    assert mixing.mixture(df.limit(0)).count() == 0


def test_many_languages_and_topics_give_the_same_weights(spark, monkeypatch):
    cells = [(f"s{a}", f"l{b}", f"t{c}", 1 + (a * 7 + b * 3 + c * 11) % 13) for a in range(4) for b in range(5) for c in range(4) if (a + b + c) % 5]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, n long")
    given = {"l0": 0.4, "l9": 0.1}
    for langs in (None, given):
        few, _ = mixing.rake(df, langs)
        want = {(r.source, r.lang, r.topic): r.weight for r in few.collect()}
        monkeypatch.setattr(mixing, "MAX_SMALL", 3)
        many, errors = mixing.rake(df, langs)
        monkeypatch.undo()
        got = {(r.source, r.lang, r.topic): r.weight for r in many.collect()}
        assert got.keys() == want.keys() and errors[-1] < 1e-4
        assert all(got[k] == pytest.approx(w, rel=1e-6) for k, w in want.items())
