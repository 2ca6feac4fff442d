import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import near_dedup as nd
from skyloom.llm.common import components

SCHEMA = "doc_id long, text string, id string, key string, component string"


def brute(texts, percent=75):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if n * 100 >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(4, 60))]
        for _ in range(rnd.randint(1, 4)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    # a common passage in texts that are half alike
    out += [" ".join(passage + [word() for _ in range(30)]) for _ in range(30)]
    out += ["", " \t\n", None, "one", "ONE", "one two", "é ü", "a\x0bb", "x " * 3000]
    return list(enumerate(out, 100))


@pytest.mark.parametrize("open_limit", [500, 0])
def test_equals_brute_force(spark, open_limit):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in texts], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, open_limit=open_limit).collect()}
    assert got == brute(texts)


def test_edges_of_the_input(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in nd.near_duplicates(df).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 1, False)]
    assert nd.near_duplicates(df.limit(0)).collect() == []


def test_words_and_shingles():
    assert len(nd.shingle_set("a b c d e f")) == 2 and len(nd.shingle_set("a b a b a b a b a")) == 2
    assert len(nd.word_hashes("Ab\x1cC d  e")) == 2
    assert (nd.shingle_set("A B  c") == nd.shingle_set("a\tb\nC")).all()
    assert len(nd.shingle_set("éÉ")) == 1 and nd.shingle_set(None).size == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    x, y = nd.signature(np.concatenate((both, a))), nd.signature(np.concatenate((both, b)))
    assert abs((x == y).mean() - 0.6) < 0.15


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 20)] + [(7, 7), (200, 199)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(20)} | {199: 199, 200: 199}
    assert components(spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))).count() == 0


def test_words_that_a_polynomial_can_not_tell_apart(spark):
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = morse.translate(str.maketrans("ab", "ba"))
    assert nd.word_hashes(morse) != nd.word_hashes(other) and len(nd.shingle_set(f"{morse} x {other} x {morse} x")) == 2
    df = spark.createDataFrame([(1, morse), (2, other), (3, morse + " "), (4, morse[:-1])], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    words = ["a" * n for n in range(1, 200)] + ["a" * n + "b" + "a" * (199 - n) for n in range(200)]
    assert len(set(nd.word_hashes(" ".join(words)).tolist())) == len(words)
    assert (nd.word_hashes(" ".join(words)) == np.concatenate([nd.word_hashes(w) for w in words])).all()
