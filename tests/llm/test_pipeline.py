import re

import corpus_pipeline as cp
from skyloom.llm.common import durable
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_dedup import brute as brute_docs

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in cp.STAGES:
        before, docs = docs, durable(stage(spark, docs, SF), "stage")
        kept[name] = (before.collect(), docs.collect())
        assert name == names[-1] or docs.columns == columns
    # line dedup against brute force
    before, after = kept["line dedup"]
    want = brute_lines([(r.doc_id, r.text) for r in before])
    left = {}
    for (i, _), first in want.items():
        left.setdefault(i, 0)
    for at, first in want.items():
        left[at[0]] += at == first
    blank = {r.doc_id for r in before if not re.search(r"[^ \t\r\n]", r.text or "")}
    assert {r.doc_id for r in after} == {i for i, n in left.items() if n} | blank
    for r in after:
        assert len([x for x in (r.text or "").split("\n") if x.strip(" \t\r")]) == left.get(r.doc_id, 0)
    # near-dedup against brute force
    before, after = kept["minhash near-dedup"]
    found = brute_docs([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {i for i, (_, c) in found.items() if i == c}
    # mixing only leaves documents out; packing takes all of them
    before, after = kept["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and len(after) > 0.4 * len(before)
    assert {r.doc_id for r in kept["best-fit packing"][1]} == {r.doc_id for r in after}


def test_empty_corpus(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def awkward(spark):
    line = "a line that is long enough to be shingled and that stands in some documents"
    rows = [
        (None, f"first of two without an id\n{line}", "en", None, 1),
        (None, f"{line}\nsecond of two without an id, quite another", None, "web", 1),
        (1, line, "en", "web", 1),
        (2, None, "en", "web", None),
        (3, "", None, None, 0),
        (4, "a document that stands here twice in full", "de", "web", 41),
        (4, "a document that stands here twice in full", "de", "web", 41),
        (4, "another text under the same number as two others", "de", "web", 48),
        (5, " ".join(f"word{k}" for k in range(20_000)), "en", "web", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("score", "kept", "id", "key", "_key", "_text", "_gone", "component", "component_id", "_source", "_sampled", "tokens", "length")
    return docs, docs.selectExpr("*", *[f"'x' as {c}" for c in clashing])


def test_stages_take_nulls_ties_repeats_and_clashing_columns(spark):
    docs, wide = awkward(spark)
    columns, long = docs.columns, docs.where("doc_id = 5").first().text
    got = {}
    for name, stage in cp.STAGES:
        out = stage(spark, wide, SF)
        got[name] = out.collect()
        assert name == "best-fit packing" or out.columns == columns
    every = sorted(map(repr, docs.collect()))
    assert sorted(map(repr, got["toxicity"])) == every
    lines = [(r.doc_id, r.text) for r in got["line dedup"]]
    # Document 1 keeps the shared line; of the equal rows of document 4 one is left.
    assert sorted(t for i, t in lines if i is None) == ["first of two without an id", "second of two without an id, quite another"]
    assert [i for i, _ in lines if i is not None] and sorted(i for i, _ in lines if i is not None) == [1, 2, 3, 4, 4, 5]
    assert {t for i, t in lines if i == 5} == {long} and {t for i, t in lines if i in (2, 3)} == {None, ""}
    # Rows without an id are linked with nothing, and nothing else here is similar enough.
    near = [(r.doc_id, r.text) for r in got["minhash near-dedup"]]
    assert sum(i is None for i, _ in near) == 2 and {1, 2, 3, 4, 5} <= {i for i, _ in near}
    mixed = [repr(r) for r in got["mixing"]]
    assert set(mixed) <= set(every) and mixed.count(repr(docs.where("doc_id = 4 and n_chars = 41").first())) in (0, 2)
    pieces = got["best-fit packing"]
    assert {r.doc_id for r in pieces} == {None, 1, 2, 3, 4, 5}
    spans = sorted((r.sequence_id, r.offset, r.length) for r in pieces)
    for (s, o, n), (t, p, _) in zip(spans, spans[1:]):
        assert p == (o + n if s == t else 0)
