import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyloom.llm import packing

TEXTS = ["", None, "Hello world", "a  b", "a   b  c", " x", "x ", "x  ", "\n\n a \n b", "don't  I'll\t x", "é ü 日本語 𝒳", "<|endoftext|> hi", "a <|endoftext|>  b<|endoftext|><|endoftext|>", "1 234", "a  b   c", "w " * 3000, "tok" * 2000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer(tokenizer):
    rnd = random.Random(0)
    texts = [t or "" for t in TEXTS] + ["".join(rnd.choice(" \n\tabé1.'") for _ in range(40)) for _ in range(300)]
    mine = packing.Encoder()
    for t in texts:
        assert mine.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_plan_places_each_item_once():
    rnd = random.Random(1)
    for _ in range(30):
        counts = dict(Counter(rnd.randint(1, 64) for _ in range(rnd.randint(1, 400))))
        rows, places = packing.plan(counts, 64), {}
        for length, low, high, first, per, offset in rows:
            for rank in range(low, high):
                places[length, rank] = (first + (rank - low) // per, offset + (rank - low) % per * length)
        assert Counter(k for k, _ in places) == counts and all(r < counts[k] for k, r in places)
        taken = Counter()
        for (length, _), (s, at) in places.items():
            for k in range(at, at + length):
                taken[s, k] += 1
        ends = Counter(s for s, _ in taken)
        assert set(taken.values()) == {1} and max(k for _, k in taken) < 64
        assert all((s, k) in taken for s, n in ends.items() for k in range(n))
        assert len(ends) <= -(-sum(k * n for k, n in counts.items()) // 64) * 11 / 9 + 1


def test_pack(spark, tokenizer):
    rows = list(enumerate(TEXTS * 3)) + [(None, "no id"), (3, "a  b")]
    df = spark.createDataFrame([(i, t, 9, 9) for i, t in rows], "doc_id long, text string, length int, piece int").repartition(3)
    out = packing.best_fit_packing(df).collect()
    by_sequence, of = {}, {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        of.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    for i, t in enumerate(TEXTS):
        if i == 3:
            continue
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(of[i], key=lambda r: r.piece)
        assert sum(r.length for r in parts) == len(ids) and all(r.length == 1024 for r in parts[1:])
        for k, r in enumerate(parts):
            assert r.piece == k and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert len(of[3]) == 2 and len(of[None]) == 1
    assert packing.best_fit_packing(df.limit(0)).count() == 0
