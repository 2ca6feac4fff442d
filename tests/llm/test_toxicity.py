import zlib

import numpy as np

from skyloom.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = tx.toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    test = out[out.held_out]
    clean, toxic = test[test.toxic == 0].score, test[test.toxic == 1].score
    assert (toxic.to_numpy()[:, None] > clean.to_numpy()[None]).mean() > 0.85
    assert (test[test.toxic == 0].predicted == 0).mean() > 0.97
    assert (test.predicted == (test.score >= 0.7)).all()


def test_edges_of_the_input(spark):
    docs = spark.createDataFrame([(None, "bad words", 1.0), (1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (3, "x" * 100_000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 5), (None, 1)], "doc_id long, toxic int")
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and not [r for r in got if r.doc_id is None][0].held_out
    assert tx.toxicity(docs.limit(0), labels).count() == 0


def test_fit_separates():
    texts = [f"some plain text number {k} about gardens" for k in range(60)] + [f"text number {k} you absolute zorgblat" for k in range(60)]
    ids, weights, bias = tx.fit(texts, np.array([0] * 60 + [1] * 60))
    table = np.zeros(tx.DIMENSIONS)
    table[ids] = weights
    score = lambda t: bias + table[np.unique(tx.features(t))].sum()
    assert score("what a zorgblat") > 0 > score("plain gardens")
    assert len(tx.fit(["a", "b"], np.array([0, 0]))[0]) == 0
