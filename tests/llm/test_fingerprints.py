import hashlib

from pyspark.sql import functions as F

from skyloom.llm import fingerprints as fp


def shingles(t):
    w = [x for x in (t or "").lower().split() if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in fp.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    off = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        m = len(t) // 2
        edited = t[: len(t) - m] + after[:m]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off.append(abs(r.near_edited - likeness(shingles(t), shingles(edited))))
        off.append(abs(r.near_next - likeness(shingles(t), shingles(after))))
        if len(shingles(t)) < fp.K:
            assert r.n_shingles == len(shingles(t))
    assert max(off) < 0.2 and sum(off) / len(off) < 0.03


def test_edges_of_the_input(spark):
    rows = [(None, "n u l l i d"), (1, None), (2, ""), (3, "a"), (3, "a"), (4, "𝒳 é " * 5000), (5, "A")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("at", F.lit(1)).withColumn("bucket", F.lit(2))
    got = sorted(fp.fingerprints(df).collect(), key=lambda r: (r.doc_id or 0, r.n_chars))
    assert [r.n_chars for r in got] == [11, 0, 0, 1, 1, 20_000, 1]
    assert got[3].fingerprint == got[4].fingerprint == got[6].fingerprint and got[1].fingerprint == "" and got[1].near_next == 1.0
    single = fp.fingerprints(df.where("doc_id = 4")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert fp.fingerprints(df.limit(0)).count() == 0


def test_merge_and_containment(spark):
    words = [f"w{k}" for k in range(1000)]
    df = spark.createDataFrame([("whole", " ".join(words)), ("part", " ".join(words[:600])), ("part", " ".join(words[596:]))], "k string, text string")
    merged = {r.k: r.s for r in fp.merge_sketches(fp.with_sketch(df, "text", "s"), ["k"], "s").collect()}
    assert merged["whole"] == merged["part"]
    pair = spark.createDataFrame([(" ".join(words[:500]), " ".join(words))], "a string, b string")
    pair = fp.with_sketch(fp.with_sketch(pair, "a", "x"), "b", "y")
    r = pair.select(fp.resemblance(F.col("x"), F.col("y")), fp.containment(F.col("x"), F.col("y")), fp.distinct_shingles(F.col("y"))).first()
    assert abs(r[0] - 0.5) < 0.15 and r[1] > 0.75 and abs(r[2] - 996) < 250
