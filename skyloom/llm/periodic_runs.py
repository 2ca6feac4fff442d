"""Maximal periodic runs of words, and texts without the repetitions in them.

By the runs theorem every run's Lyndon root is a longest Lyndon word of its place, under the order
of the words or under the reversed one.  The longest Lyndon word from a place ends before the next
smaller value of the inverse suffix array.  Such roots are extended both ways by longest common
extensions: minima of the LCP array from a sparse table.

Texts are worked on in chunks: the words of several documents stand on one line, but suffixes are
compared within their document only.  A chunk needs some 12 * log2(n) bytes a word of its longest document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
CHUNK_WORDS = 100_000
GLANCE = 8  # words by which roots are extended one by one, before suffixes are looked up
_RUNS = "array<struct<start:long,length:long,period:long>>"


def _group_starts(changed: np.ndarray) -> np.ndarray:
    """For each place the last place at or before it where ``changed`` holds; the first one always counts."""
    at = np.where(changed, np.arange(len(changed)), 0)
    return np.maximum.accumulate(at)


def suffix_ranks(key: np.ndarray, left: np.ndarray, end_high: bool = False) -> np.ndarray:
    """Inverse suffix array by prefix doubling: ``key`` orders (document, word), ``left`` counts words to the document's end.

    The end of a document is smaller than every word, or with ``end_high`` larger.
    """
    n = len(key)
    active = np.argsort(key)
    found = key[active]
    first = _group_starts(np.append(True, found[1:] != found[:-1]))
    rank = np.empty(n, dtype=np.int64)
    rank[active] = first
    size = np.bincount(first, minlength=n)
    active = active[size[first] > 1]
    h, end = 1, n if end_high else -1
    while len(active):
        after = np.where(left[active] <= h, end, rank[np.minimum(active + h, n - 1)])
        both = rank[active] * (n + 2) + after + 1
        order = np.argsort(both)
        active, both = active[order], both[order]
        group = both // (n + 2)
        split = np.append(True, both[1:] != both[:-1])
        first = _group_starts(split)
        rank[active] = group + first - _group_starts(np.append(True, group[1:] != group[:-1]))
        size = np.bincount(first, minlength=len(active))
        active = active[size[first] > 1]
        h *= 2
    return rank


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value, or the length; minima of windows of 1, 2, 4.. are jumped over."""
    n = len(values)
    out = np.full(n, n, dtype=np.int64)
    minima = [np.append(values, -1)]  # the end is smaller than all
    active, at = np.arange(n), np.arange(1, n + 1)
    level, jumps = 0, []
    while len(active):
        low = minima[level]
        stop = low[np.minimum(at, len(low) - 1)] < values[active]
        stop |= at + (1 << level) > n + 1
        jumps.append((active[stop], at[stop]))
        active, at = active[~stop], at[~stop] + (1 << level)
        if not len(active):
            break
        if len(low) > 1 << level:
            minima.append(np.minimum(low[: -(1 << level)], low[1 << level :]))
            level += 1
    for top, (who, at) in enumerate(jumps):
        for k in range(min(top, len(minima)) - 1, -1, -1):
            low = minima[k]
            fits = (at + (1 << k) <= n + 1) & (low[np.minimum(at, len(low) - 1)] > values[who])
            at = at + (fits << k)
        out[who] = at
    return out


class Extensions:
    """Longest common extensions to the right of two places of one document: LCP array and sparse table of its minima."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, end: np.ndarray):
        n = len(words)
        self._rank = suffix_ranks(doc * (int(words.max(initial=0)) + 1) + words, end - np.arange(n))
        order = np.empty(n, dtype=np.int64)
        order[self._rank] = np.arange(n)
        lcp = np.zeros(n, dtype=np.int64)
        before = np.append(-1, order[:-1])[self._rank].tolist()  # the suffix before each in sorted order
        w, until, rank = words.tolist(), end.tolist(), self._rank.tolist()
        h, found = 0, [0] * n
        for i in range(n):
            j = before[i]
            if j < 0 or until[j] != until[i]:
                h = 0
                continue
            most = until[i] - max(i, j)
            while h < most and w[i + h] == w[j + h]:
                h += 1
            found[rank[i]] = h
            h = max(h - 1, 0)
        lcp[:] = found
        self._minima = [lcp]
        while 2 << (len(self._minima) - 1) <= n:
            low, half = self._minima[-1], 1 << (len(self._minima) - 1)
            self._minima.append(np.minimum(low[:-half], low[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes from i and from j (other places of the same document) share."""
        a, b = np.minimum(self._rank[i], self._rank[j]) + 1, np.maximum(self._rank[i], self._rank[j]) + 1
        out = np.empty(len(i), dtype=np.int64)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here, low = np.flatnonzero(level == k), self._minima[k]
            out[here] = np.minimum(low[a[here]], low[b[here] - (1 << k)])
        return out


def _lyndon_roots(words: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Places and ends of the longest Lyndon words under both orders; place and end of each are in one document."""
    place = np.arange(len(words))
    key, left, n = doc * (int(words.max(initial=0)) + 1) + words, end - place, len(words)
    base = n - end  # later documents get smaller values, so no search leaves its document
    for end_high in (False, True):
        rank = suffix_ranks(key, left, end_high) - start
        yield place, next_smaller(base + (end - start - 1 - rank if end_high else rank))


def _glance(words: np.ndarray, i: np.ndarray, j: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common words right of (i, j) and left of them, up to ``GLANCE`` each."""
    out = []
    for step in (1, -1):
        n = np.zeros(len(i), dtype=np.int64)
        alive = np.arange(len(i))
        for k in range(GLANCE):
            x, y = (i[alive] + k, j[alive] + k) if step > 0 else (i[alive] - 1 - k, j[alive] - 1 - k)
            inside = y < end[i[alive]] if step > 0 else x >= start[i[alive]]
            alive, x, y = alive[inside], x[inside], y[inside]
            alive = alive[words[x] == words[y]]
            n[alive] += 1
        out.append(n)
    return out[0], out[1]


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of the documents whose words stand one after the other: doc, start, length, period, in that order.

    ``words`` are numbers from 0, ``sizes`` the documents' lengths.  A run is a stretch with smallest period q of
    at least max(min_length, 2 q) words that can't be extended in its document.
    """
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    if not len(words):
        return none
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    start, end = (ends - sizes)[doc], ends[doc]
    roots = []
    for i, j in _lyndon_roots(words, doc, start, end):
        p = j - i
        fits = np.maximum(min_length, 2 * p) <= end - start
        i, j, p = i[fits], j[fits], p[fits]
        right, left = _glance(words, i, j, start, end)
        open_ = (right == GLANCE) | (left == GLANCE) | (right + left + p >= np.maximum(min_length, 2 * p))
        roots.append(np.stack((i, j))[:, open_])
    i, j = np.concatenate(roots, axis=1)
    if not len(i):
        return none
    # Only documents with such roots need suffixes to be looked up.
    held = np.zeros(len(sizes), dtype=bool)
    held[doc[i]] = True
    mask = held[doc]
    at = np.cumsum(mask) - 1
    w, d, s, e = words[mask], doc[mask], at[start[mask]], at[end[mask] - 1] + 1
    n, x, y = len(w), at[i], at[i] + (j - i)
    right, left = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    inside = np.flatnonzero(y < e[x])
    right[inside] = Extensions(w, d, e).common(x[inside], y[inside])
    inside = np.flatnonzero(x > s[x])
    left[inside] = Extensions(w[::-1], d.max() - d[::-1], n - s[::-1]).common(n - x[inside], n - y[inside])
    p = y - x
    length = left + p + right
    kept = length >= np.maximum(min_length, 2 * p)
    rows = np.unique(np.stack((d[x], x - left - s[x], length, p), axis=1)[kept], axis=0)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return tuple(rows.T)


def _worked(texts: list[str | None], min_length: int):
    """(runs, collapsed text) of each text."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at ASCII white space only
    sizes, numbers = np.array([len(w) for w in words], dtype=np.int64), {}
    flat = [numbers.setdefault(x, len(numbers)) for w in words for x in w]
    doc, start, length, period = find_runs(np.array(flat, dtype=np.int64), sizes, min_length)
    first = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    collapsed = []
    for k, w in enumerate(words):
        a, b = first[k], first[k + 1]
        if a < b:
            depth = np.zeros(len(w) + 1, dtype=np.int64)
            np.add.at(depth, start[a:b] + period[a:b], 1)
            np.add.at(depth, start[a:b] + length[a:b], -1)
            w = [w[x] for x in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(w))
    fields = [pa.array(x, pa.int64()) for x in (start, length, period)]
    runs = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    return runs, pa.array(collapsed, pa.string())


def _tasks(min_length: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            # A word and the space after it take two characters at least, but six on average.
            full = np.cumsum([len(t or "") for t in texts]) // (6 * CHUNK_WORDS)
            cuts = [0, *(np.flatnonzero(np.diff(full)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *_worked(texts[a:b], min_length)], names=["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, runs (start, length, period by start, then period) and the collapsed text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  The collapsed text joins by one space the words that are
    in no run after the run's first period.  A null, empty or blank text has no runs and an empty collapsed text.
    Rows without an id and rows that share one are rows of their own; other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_tasks(min_length), f"doc_id long, runs {_RUNS}, collapsed string")


def rotated(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts are made periodic from some word on.

    With h the crc32 of the decimal doc_id, these are the texts with h % 10 = 0 and n > 0 words.  From word
    a = (h div 10) % n on they repeat p = 1 + (n - a) div (3 + (h div 10) % 8) words.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = "filter(split(text, '[ \\\\t-\\\\r]+'), x -> x <> '')"
    a, n = "g % size(w)", "size(w)"
    place = f"if(k < {a}, k, {a} + (k - {a}) % (1 + ({n} - {a}) div (3 + g % 8)))"
    changed = f"array_join(transform(w, (x, k) -> w[cast({place} as int)]), ' ')"
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (h % 10 == 0).alias("picked"), F.floor(h / 10).alias("g"))
    split = picked.withColumn("w", F.when(F.col("picked"), F.expr(words)))
    return split.select("doc_id", F.when(F.col("picked") & (F.size("w") > 0), F.expr(changed)).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: smallest start, then period) and the hashes of runs and collapsed text."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
