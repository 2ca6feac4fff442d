import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyloom.llm import queries
from skyloom.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabularies():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_level():
    """The printable characters that stand for the 256 bytes in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def brute(vocabularies, texts):
    """Alignment by the definition: every pair of tokens is looked at."""
    a, b = vocabularies
    table, rows, counts = byte_level(), [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        e = a.encode(want.decode(), add_special_tokens=False)
        left = [(i, bytes(table[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text or "")]
        if not text or b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
            rows.append(([], [], [], ""))
            continue
        spans = []
        for side in (left, right):
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            spans.append([(i, end - len(x), end) for (i, x), end in zip(side, ends, strict=True)])
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        parts = [[",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in spans] for low, high in zip([0, *cuts], cuts, strict=False)]
        counts.update(links)
        rows.append((*spans, links, ";".join("|".join(p) for p in parts)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (len(x), len(y), len(g.split(";")) if g else 0, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), g)
        for x, y, links, g in rows
    ]


TEXTS = [
    "", None, "a", " ", "  ", " a ", "the of and", "a  b", "a\n b", "a \n b", "a\t\tb", "end \n", "x▁y z", "ﬁne ½ é naïve", "日本語 テキスト 𝔘𝔫𝔦", "<|endoftext|> <s> <0x41> </s>",
    "don't we'll 12345 1.5e10", "aaaa" * 500, "\x00 \x7f ​", "a b", "the the the " * 40, "  lead", "trail  ", "\n", "é 👍🏽",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def corpus(seed=3):
    rnd = random.Random(seed)
    parts = ["the", "of", "tion", "ing", "é", "ß", "日", " ", "  ", "\n", ".", ",", "12", "A", "zu", "qu", "\t"]
    return TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(150)]


@pytest.mark.parametrize("most", [ta.BROADCAST_PAIRS, 20, 0])
def test_equals_brute_force(spark, vocabularies, most):
    texts = corpus()
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in enumerate(texts)], "doc_id long, text string, pair string, row int, groups string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in ta.align(df, broadcast_pairs=most).collect()}
    assert [got[k] for k in range(len(texts))] == brute(vocabularies, texts)


def test_query_on_its_whole_table(spark, vocabularies):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r[c] for c in [*COLUMNS[:-1], "groups_sha256"]) for r in queries.op11_token_alignment(spark, SF).collect()}
    want = brute(vocabularies, [d.text for d in docs])
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert got == {d.doc_id: (*w[:-1], digest(w[-1])) for d, w in zip(docs, want, strict=True)}


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_links, r.count_sum, r.n_best) for r in ta.align(df).collect())
    assert got == [(0, 2, 6, 2), (1, 2, 6, 2), (1, 2, 6, 2), (2, 0, 0, 0)]
    assert ta.align(df.limit(0)).collect() == []
    long = "thorou " * 100_000 + "x" * 200_000
    row = ta.align(spark.createDataFrame([(1, long)], "doc_id long, text string"), digest=True).first()
    assert row.n_groups > 100_000 and row.n_links >= max(row.n_a, row.n_b) and len(row.groups_sha256) == 64


def test_what_is_remembered_does_not_change_results(monkeypatch):
    texts = corpus(5)
    plain = ta.Aligner()
    want = plain.texts(texts)
    again = plain.texts(texts)
    assert all((np.asarray(x) == np.asarray(y)).all() for x, y in zip(want, again, strict=True))
    pairs, times = plain.totals()
    assert times.sum() == 2 * want[0][:, 3].sum() and len(plain.totals()[0]) == 0
    whole = ta.Aligner()
    whole.tokenizers.by_word = False
    assert all((np.asarray(x) == np.asarray(y)).all() for x, y in zip(want, whole.texts(texts), strict=True))


def test_totals_survive_a_worker_that_starts_anew(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ta, "KNOWN_WORDS", 3)
    monkeypatch.setattr(ta, "CHUNK_CHARS", 40)
    texts = corpus(7)
    ta._aligner.cache_clear()
    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])]
    totals, own = Counter(), Counter()
    for out in ta._tasks(ta.A, ta.B)(iter(batches)):
        for r in out.to_pylist():
            (totals if r["total"] else own).update(dict(zip(r["pairs"], r["times"], strict=True)))
    ta._aligner.cache_clear()
    assert totals == own and len(own) > 100
