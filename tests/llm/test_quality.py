import zlib

import numpy as np
import pytest

from skyloom.llm import quality as q
from skyloom.llm import queries


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_labels_of_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op13_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [r for r in rows if r.held_out]
    good, bad = ([r for r in test if r.quality == y] for y in (1, 0))
    assert len(good) > 300 and len(bad) > 50
    assert np.mean([r.predicted for r in good]) > 0.995 and np.mean([r.predicted for r in bad]) < 0.06
    wins = np.mean([[a.score > b.score for a in good] for b in bad])
    assert wins > 0.99


def test_labels_of_held_out_documents_are_never_learnt(spark):
    docs = spark.createDataFrame([(k, "Prose about things, and so on." if k % 2 else "| x | y | z $$$ !!!") for k in range(300)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = (sorted(map(tuple, q.quality(docs, x).collect())) for x in (labels, turned))
    assert a == b and all(p == k % 2 for k, _, _, p in a)


def test_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    known, vectors = (q._unit(rng.standard_normal((n, 8))) for n in (40, 25))
    vectors[3] = 0
    labels = rng.integers(0, 2, 40).astype(np.float32)
    got = q.vote(vectors, known, labels, neighbours=5)
    for v, score in zip(vectors, got, strict=True):
        near = sorted(((float(sum(a * b for a, b in zip(v, w, strict=True))), y) for w, y in zip(known, labels, strict=True)), reverse=True)[:5]
        votes = [(max(c, 0) ** q.SHARPNESS, y) for c, y in near]
        want = (sum(w * y for w, y in votes) + q.PRIOR * labels.mean()) / (sum(w for w, _ in votes) + q.PRIOR)
        assert score == pytest.approx(want, abs=1e-6)
    assert got[3] == pytest.approx(labels.mean(), abs=1e-6)


def test_projection_is_the_best_of_its_rank():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["lorem", "ipsum", "Dolor", "12", "sit!"], 12)) for _ in range(60)]
    rows = [q._damped(t) for t in texts]
    projection, vectors = q.fit(rows, np.ones(60), rank=10)
    x = np.zeros((60, q.TERMS))
    for k, (ids, weights) in enumerate(rows):
        x[k, ids] = weights
    x = q._unit(x * (np.log(61 / ((x > 0).sum(axis=0) + 1)) + 1))
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    exact = q._unit(u[:, :10] * s[:10])
    assert np.abs(np.abs(exact @ exact.T) - np.abs(vectors @ vectors.T)).max() < 1e-3
    again = q._unit(np.array([w @ projection[i] for i, w in rows]))
    assert np.abs(again - vectors).max() < 1e-4


def test_long_texts_are_counted_whole(monkeypatch):
    text = "Abc déf, 12 abc abc!\n" * 200
    whole = q.counts(text)
    monkeypatch.setattr(q, "PART", 100)
    parts = q.counts(text)
    low, high, _ = q.FAMILIES[0]
    assert abs(int(whole[low:high].sum()) - len(text)) <= 2 and np.abs(whole[:16_379] - parts[:16_379]).sum() <= 2
    assert q.counts(None).sum() == q.counts("").sum() == 0


def test_edges_of_the_input(spark):
    texts = ["Good prose, nothing else.", "$$$ ### !!!", None, "", "x" * 3_000_000, "\x00 é 👍 İ ß"]
    rows = [(k, texts[k % 6]) for k in range(60)] + [(None, "Good prose, nothing else."), (1, "$$$ ### !!!"), (1, "$$$ ### !!!")]
    docs = spark.createDataFrame([(k, t, "x", 0.5, "y") for k, t in rows[:4] + rows[5:9] + rows[11:]], "doc_id long, text string, quality string, score double, ids string").repartition(3)
    labels = spark.createDataFrame([(k, 1 - k % 6 % 2, 0) for k in range(60)] + [(1, None, 1), (2, 7, 0), (None, 1, 1), (0, 0, 1)], "doc_id long, quality int, toxic int")
    got = q.quality(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False] and len([r for r in got if r.doc_id == 1]) == 3
    assert q.quality(docs.limit(0), labels).collect() == []
    assert {r.score for r in q.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert q.quality(spark.createDataFrame([(1, "")], "doc_id long, text string"), labels).first().score == 0.5
