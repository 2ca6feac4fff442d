import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from skyloom.llm import periodic_runs as pr
from skyloom.llm import queries

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Runs by comparing the words with themselves at every distance; the smallest period of a stretch counts."""
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, 2 * q) and i > s:
                if not any(all(words[x] == words[x + d] for x in range(s, s + length - d)) for d in range(1, q) if q % d == 0):
                    found.add((s, length, q))
            i += i == s
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic(rnd, n, k):
    words = [rnd.choice("abcde"[:k]) for _ in range(n)]
    if n and rnd.random() < 0.6:
        p, a = rnd.randint(1, 9), rnd.randrange(n)
        words = [w if i < a else words[min(a + (i - a) % p, n - 1)] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for _ in range(120):
        docs = [periodic(rnd, rnd.choice([0, 1, 5, 24, 50, 90]), rnd.choice([1, 2, 2, 3, 5])) for _ in range(rnd.randint(1, 6))]
        flat = np.array([ord(w) - 97 for d in docs for w in d], dtype=np.int64)
        got = [[] for _ in docs]
        for d, *run in zip(*(x.tolist() for x in pr.find_runs(flat, np.array([len(d) for d in docs]), least)), strict=True):
            got[d].append(tuple(run))
        assert got == [brute(d, least) for d in docs]


def test_fibonacci_and_uniform_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    got = {tuple(x[1:]) for x in np.stack(pr.find_runs(np.array(b), np.array([len(b)]), 2), axis=1).tolist()}
    assert got == set(brute(b, 2))
    *_, start, length, period = pr.find_runs(np.zeros(100_000, np.int64), np.array([100_000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [100_000], [1])


def test_parts_of_the_method():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 65, 300):
        values = rnd.permutation(n)
        want = [next((j for j in range(i + 1, n) if values[j] < values[i]), n) for i in range(n)]
        assert pr.next_smaller(values).tolist() == want
        words = rnd.integers(0, 2, n)
        ranks = pr.suffix_ranks(words, n - np.arange(n))
        assert np.argsort(ranks).tolist() == sorted(range(n), key=lambda i: words[i:].tolist())
        high = pr.suffix_ranks(words, n - np.arange(n), True)
        assert np.argsort(high).tolist() == sorted(range(n), key=lambda i: [*words[i:].tolist(), 9])
        if n > 2:
            i = rnd.integers(0, n - 1, 50)
            j = i + 1 + rnd.integers(0, n, 50) % (n - 1 - i)
            common = lambda x, y: next((k for k in range(n - y) if words[x + k] != words[y + k]), n - y)
            assert pr.Extensions(words, np.zeros(n, np.int64), np.full(n, n)).common(i, j).tolist() == [common(x, y) for x, y in zip(i, j, strict=True)]


def rotated(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = rotated(doc_id, text)
    runs = brute(words)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return doc_id, len(runs), s, n, q, runs and 1000 * n // q or None, sha(lines), sha(collapse(words, runs))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_texts_of_its_table(spark):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == docs.keys()
    short = [d for d, t in docs.items() if len(split(t)) < 600]  # what brute force can do
    assert len(short) > 100 and [got[d] for d in short] == [digest(d, docs[d]) for d in short]
    assert sum(got[d][1] > 0 for d in short) > 10


def test_edges_of_the_input(spark):
    ids = [k for k in range(300) if zlib.crc32(str(k).encode()) % 10 == 0][:4]
    texts = [None, "", " \t\n", "one", "the " * 30, "a\x1cb \x0b\x0c\r c", "x y z " * 9 + "é 👍 " * 12]
    rows = [(k, texts[j]) for j, k in enumerate(ids)] + [(1000 + j, t) for j, t in enumerate(texts)] + [(None, "a b " * 9), (7, "a b " * 9), (7, "a b " * 9)]
    df = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in rows], "doc_id long, text string, w string, g int, runs int").repartition(3)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in pr.run_digest(pr.periodic_runs(pr.rotated(df))).collect()), key=str)
    assert got == sorted((digest(*r) for r in rows), key=str)
    assert pr.periodic_runs(df.limit(0)).collect() == []


def test_spans_and_texts_of_the_operator(spark):
    df = spark.createDataFrame([(1, "start here " + "a b c " * 5 + "end")], "doc_id long, text string")
    row = pr.periodic_runs(df).first()
    assert [tuple(r) for r in row.runs] == [(2, 15, 3)] and row.collapsed == "start here a b c end"
    long = " ".join(["w%d" % (k % 70_000) for k in range(200_000)])
    row = pr.periodic_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 70_000)] and len(row.collapsed.split()) == 70_000
