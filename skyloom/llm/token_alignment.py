"""Alignment of two tokenizers' tokens by their byte ranges.

B's token ends are a static interval index: bisecting it at an A token's start and end gives the
run of B tokens that overlap it.  A byte offset where tokens of both end separates groups.
Both vocabularies cut between a word and the single space after it, so texts are aligned word by
word and known words are looked up; texts with other spaces are aligned whole, by the same code.
The counts of linked ids are summed up over the corpus and come back to each document's links.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import durable

A, B = "byte_bpe_50k", "piece_bpe_32k"
CHUNK_CHARS = 1_000_000
KNOWN_WORDS, KNOWN_LINKS = 500_000, 8_000_000  # what a Python worker remembers at most, before it starts anew
BROADCAST_PAIRS = 2_000_000  # pairs of ids with their counts, 16 bytes each
_WHOLE = re.compile(r"  |\A | \Z|\s \s|\s \Z")
_SCHEMA = "total boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


class Tokenizers:
    """Ids of both vocabularies and the bytes of each id."""

    def __init__(self, a: str = A, b: str = B):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self._a = tiktoken.Encoding(a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.bytes_a[k] = token
        self._b = sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{b}.model"))
        pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if sp.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        # Without a piece that goes on after a word's end, merges never cross it.
        self.by_word = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A's ids of a space and the text, and B's ids of the text (B puts that space itself)."""
        return [self._a.encode_ordinary(" " + t) for t in texts], self._b.encode(texts, num_threads=1)


def overlaps(ends_a: np.ndarray, sizes_a: np.ndarray, ends_b: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first B token that overlaps it and the one after the last."""
    return np.searchsorted(ends_b, ends_a - sizes_a, "right"), np.searchsorted(ends_b - sizes_b, ends_a, "left")


def _spans(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. counts[0] - 1, 0, 1, .. counts[1] - 1, .."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _offsets(counts) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


class Aligner:
    """Alignments of strings, each tokenised as a space and the string; what has been aligned is remembered."""

    def __init__(self, a: str = A, b: str = B):
        self.tokenizers = t = Tokenizers(a, b)
        self._size_a, self._size_b = (np.array([len(x) for x in table], dtype=np.int64) for table in (t.bytes_a, t.bytes_b))
        self.base = len(t.bytes_b)  # a pair of ids is a * base + b
        marked = [[f"{k}{mark}" for k in range(len(table)) for mark in marks] for table, marks in ((t.bytes_a, ",|"), (t.bytes_b, ",;"))]
        self._written = np.array(marked[0] + marked[1], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.groups: list[str | None] = []
        self._numbers = np.zeros((1024, 4), dtype=np.int64)  # n_a, n_b, n_groups, n_links
        self._first, self._links = np.zeros(1024, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self._used = 0
        self.seen = np.zeros(1024, dtype=np.int64)  # how often each string stood in valid texts

    def full(self) -> bool:
        return len(self.groups) > KNOWN_WORDS or self._used > KNOWN_LINKS

    def _align(self, strings: list[str]):
        """valid, numbers, groups and pairs of strings that are new."""
        t = self.tokenizers
        ids_a, ids_b = t.encode(strings)
        valid = np.ones(len(strings), dtype=bool)
        for k, s in enumerate(strings):
            data = (" " + s).encode("utf-8", "surrogatepass")
            if b"".join([t.bytes_b[i] for i in ids_b[k]]) != data or b"".join([t.bytes_a[i] for i in ids_a[k]]) != data:
                valid[k], ids_a[k], ids_b[k] = False, [], []
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (ids_a, ids_b))
        # Valid strings have the same bytes on both sides, so they can stand on one line.
        ends_a, ends_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        first, last = overlaps(ends_a, self._size_a[a], ends_b, self._size_b[b])
        n = last - first
        pairs = np.repeat(a, n) * self.base + b[np.repeat(first, n) + _spans(n)]
        close_a, close_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
        order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
        written = self._written[np.concatenate((a * 2 + close_a, 2 * len(self._size_a) + b * 2 + close_b))[order]].tolist()
        at_a, at = _offsets(n_a), _offsets(n_a + n_b)
        groups = ["".join(written[x:y])[:-1] for x, y in zip(at.tolist(), at[1:].tolist(), strict=False)]
        links, closed = _offsets(n)[at_a], _offsets(close_a)[at_a]
        return valid, np.stack((n_a, n_b, np.diff(closed), np.diff(links)), axis=1), groups, pairs

    def _learn(self, strings: list[str]) -> None:
        valid, numbers, groups, pairs = self._align(strings)
        low, high = len(self.groups), len(self.groups) + len(strings)
        while high >= len(self._first):
            self._numbers = np.concatenate((self._numbers, np.zeros_like(self._numbers)))
            self._first, self.seen = (np.concatenate((x, np.zeros_like(x))) for x in (self._first, self.seen))
        while self._used + len(pairs) > len(self._links):
            self._links = np.concatenate((self._links, np.zeros_like(self._links)))
        self._numbers[low:high] = numbers
        self._first[low:high] = self._used + _offsets(numbers[:, 3])[:-1]
        self._links[self._used : self._used + len(pairs)] = pairs
        self._used += len(pairs)
        self.groups += [g if ok else None for g, ok in zip(groups, valid.tolist(), strict=True)]
        self.codes.update(zip(strings, range(low, high), strict=True))

    def _pairs_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of all strings, and the number of each."""
        n = self._numbers[codes, 3]
        return self._links[np.repeat(self._first[codes], n) + _spans(n)], n

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and how often they were linked since the last call."""
        codes = np.flatnonzero(self.seen)
        pairs, n = self._pairs_of(codes)
        pairs, at = np.unique(pairs, return_inverse=True)
        times = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(times, at, np.repeat(self.seen[codes], n))
        self.seen[:] = 0
        return pairs, times

    def texts(self, texts: list[str | None]):
        """numbers (n_a, n_b, n_groups, n_links), groups, and pairs and times with offsets, of each text."""
        parts = [[] if not t else [t] if not self.tokenizers.by_word or _WHOLE.search(t) else t.split(" ") for t in texts]
        strings = list(chain.from_iterable(parts))
        codes = list(map(self.codes.get, strings))
        if None in codes:
            self._learn(list(dict.fromkeys(s for s, c in zip(strings, codes, strict=True) if c is None)))
            codes = list(map(self.codes.__getitem__, strings))
        cuts, groups, bad = _offsets([len(p) for p in parts]), [], []
        for k, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
            found = list(map(self.groups.__getitem__, codes[x:y]))
            bad += [k] * (None in found)
            groups.append("" if None in found else ";".join(found))
        codes, row = np.array(codes, dtype=np.int64), np.repeat(np.arange(len(texts)), np.diff(cuts))
        if bad:
            good = ~np.isin(row, bad)
            codes, row = codes[good], row[good]
        np.add.at(self.seen, codes, 1)
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        numbers = np.diff(np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(self._numbers[codes], axis=0)))[at], axis=0)
        pairs, n = self._pairs_of(codes)
        top = self.base * len(self._size_a)
        keys, times = np.unique(np.repeat(row, n) * top + pairs, return_counts=True)
        return numbers, groups, keys % top, times, np.searchsorted(keys // top, np.arange(len(texts) + 1))


@lru_cache(maxsize=1)
def _aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _batch(total: bool, ids, numbers, groups, pairs, times, cuts) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int64())) for x in (pairs, times)]
    columns = [pa.array(numbers[:, k], pa.int64()) for k in range(4)]
    names = ["total", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    return pa.RecordBatch.from_arrays([pa.array([total] * len(groups)), ids, *columns, pa.array(groups, pa.string()), *lists], names=names)


def _totals(aligner: Aligner, rows: int = 10_000):
    pairs, times = aligner.totals()
    if len(pairs):
        cuts = np.append(np.arange(0, len(pairs), rows), len(pairs))
        yield _batch(True, pa.nulls(len(cuts) - 1, pa.int64()), np.zeros((len(cuts) - 1, 4)), [""] * (len(cuts) - 1), pairs, times, cuts)


def _tasks(a: str, b: str):
    def run(batches):
        aligner = _aligner(a, b)
        aligner.seen[:] = 0
        for batch in batches:
            sizes = np.cumsum([len(t or "") for t in batch.column("text").to_pylist()]) // CHUNK_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(x, y - x)
                if part.num_rows:
                    yield _batch(False, part.column("doc_id"), *aligner.texts(part.column("text").to_pylist()))
                if aligner.full():
                    yield from _totals(aligner)
                    aligner.clear()
        yield from _totals(aligner)

    return run


def _counted(found: DataFrame, base: int) -> DataFrame:
    """pair, count and whether that is the highest of the pair's B id (of which there are at most ``base``)."""
    counts = durable(found.where("total").select(F.inline(F.arrays_zip("pairs", "times")).alias("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    highest = counts.groupBy((F.col("pair") % base).alias("b")).agg(F.max("n").alias("highest"))
    return durable(counts.withColumn("b", F.col("pair") % base).join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "counted")


def _frequent(counted: DataFrame, most: int) -> int:
    """The smallest power of two so that at most ``most`` pairs have that count or more."""
    level, held = 62, 0
    levels = counted.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect()  # 64 at most
    for row in levels:
        held += row.k
        if held > most:
            break
        level = row.level
    return 2**level


def align(docs: DataFrame, a: str = A, b: str = B, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    ``groups`` writes A's and B's ids by group, ``a1,a2|b1;a3|b2,b3``; with ``digest`` it is ``groups_sha256``,
    the hash of that text (nothing without tokens), and the texts aren't stored.  A pair's count is the number of links of its ids in all
    documents; n_best counts a document's links whose count is the highest of their B id, ties included, count_sum adds up the counts of all its links.

    A text that is null, empty or not given back byte for byte by both tokenizers has no tokens: zeros and an empty
    ``groups``.  Rows without an id and rows that share one are rows of their own; other columns are ignored; an empty table gives none.

    Counts of the ``broadcast_pairs`` most frequent pairs at most are broadcast; links of rarer ones meet their counts in a shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    written = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256") if digest else F.col("groups")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    found = rows.mapInArrow(_tasks(a, b), _SCHEMA)
    found = durable(found.select("total", F.monotonically_increasing_id().alias("row"), *kept, written, "pairs", "times"), "aligned")
    counted = _counted(found, len(Tokenizers(a, b).bytes_b))
    least = _frequent(counted, broadcast_pairs)
    texts = found.where("not total")
    links = texts.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    sums = [F.sum("times").alias("links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    often, rare = F.broadcast(counted.where(F.col("n") >= least)), counted.where(F.col("n") < least)
    scored = links.join(often, "pair").groupBy("row").agg(*sums)
    if not rare.isEmpty():
        left = links.join(often.select("pair"), "pair", "left_anti").join(rare.hint("merge"), "pair")
        scored = scored.unionByName(left.groupBy("row").agg(*sums)).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("links", "n_best", "count_sum")])
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return texts.select("row", *kept, found.columns[7]).join(scored, "row", "left").select(*kept, *zero, found.columns[7])
