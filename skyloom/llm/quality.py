"""Quality of texts by the vote of their nearest labelled neighbours in a latent-semantic space.

Terms are hashed character trigrams in lower case, four-character patterns of letter case, digits and
marks, and repetitions of words; a text's terms are damped, weighted by rarity and projected to
``RANK`` dimensions by a truncated SVD of the labelled texts.  Every document meets every labelled vector in
blocks of exact cosine products, and the nearest ones vote with their similarity.

The labelled texts are a bounded sample (``MAX_LABELLED``, whole texts, the smallest hashes of doc_id).  Tasks turn
them into at most ``TERMS`` numbers each, one task fits the SVD on those, and the model (the projection and the labelled
vectors, some 8 MB) is broadcast.  Only the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import durable

TERMS = 1 << 14
FAMILIES = ((0, 10_000, 1.0), (10_000, 16_379, 1.0), (16_379, TERMS, 0.7))  # trigrams, patterns and repetitions: terms from, to, weight
RANK = 48
MAX_LABELLED = 3_000
NEIGHBOURS = 15
SHARPNESS = 8  # the power of a cosine that is its vote
PRIOR = 1e-3  # votes for the share of label 1
CUT = 0.3
PART = 1_000_000  # characters that are turned into terms at once
BLOCK = 512
_SPACES = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)


def _hashed(codes: list[np.ndarray], family: int) -> np.ndarray:
    low, high, _ = FAMILIES[family]
    h = np.zeros(len(codes[0]), dtype=np.uint64)
    for c in codes:
        h = (h ^ (c + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(40)).astype(np.int64) % (high - low) + low


def _windows(codes: np.ndarray, n: int) -> list[np.ndarray]:
    return [codes[j : len(codes) - n + 1 + j] for j in range(n)]


def _shape(codes: np.ndarray, text: str) -> np.ndarray:
    """Lower case letters as a, others as A, digits as 0, marks as themselves."""
    upper = np.frombuffer(text.upper().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if text.isascii() else None
    lower = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if text.isascii() else None
    if lower is None:  # lengths may change in upper case, so these go by character
        kinds = {c: 97 if c.islower() else 65 if c.isalpha() else 48 if c.isdigit() else ord(c) for c in set(text)}
        known = np.array(sorted(map(ord, kinds)), dtype=np.uint32)
        return np.array([kinds[chr(c)] for c in known.tolist()], dtype=np.uint64)[np.searchsorted(known, codes)]
    letter = upper != lower
    out = np.where(letter, np.where(codes == upper, 65, 97), codes)
    return np.where((codes >= 48) & (codes <= 57), 48, out).astype(np.uint64)


def _repeats(text: str) -> np.ndarray:
    """A term for each word, that tells how far back (1 to 4 words, or further) the same word stood."""
    words: dict[str, int] = {}
    ids = np.array([words.setdefault(w, len(words)) for w in text.split()], dtype=np.int64)
    back = np.full(len(ids), 5, dtype=np.int64)
    for d in (4, 3, 2, 1):
        back[d:][ids[d:] == ids[:-d]] = d
    return back - 1 + FAMILIES[2][0]


def counts(text: str | None) -> np.ndarray:
    """How often each of the ``TERMS`` stands in the whole text; long texts are gone through in parts."""
    out = np.zeros(TERMS, dtype=np.int64)
    text = text or ""
    for at in range(0, len(text), PART):
        part = text[max(0, at - 3) : at + PART]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        low = part.lower()
        low = np.frombuffer((low if len(low) == len(part) else part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        for family, (values, n, skip) in enumerate(((low, 3, 1), (_shape(codes, part), 4, 0))):
            if at == 0:
                values, skip = np.concatenate(([np.uint64(32)], values, [np.uint64(32)])) if at + PART >= len(text) else np.append(np.uint64(32), values), 0
            if len(values) >= n + skip:
                out += np.bincount(_hashed(_windows(values[skip:], n), family), minlength=TERMS)
        out += np.bincount(_repeats(part), minlength=TERMS)
    return out


def _damped(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text and their weights: logarithms of shares, each family of terms with its own length."""
    n = counts(text)
    ids = np.flatnonzero(n)
    weights = np.zeros(len(ids), dtype=np.float32)
    for low, high, length in FAMILIES:
        here = slice(*np.searchsorted(ids, (low, high)))
        x = np.log1p(n[ids[here]] * (1000 / max(n[low:high].sum(), 1)))
        weights[here] = length * x / max(np.linalg.norm(x), 1e-12)
    return ids.astype(np.int32), weights


def _terms(batches):
    for batch in batches:
        ids, weights = zip(*map(_damped, batch.column("text").to_pylist()), strict=True) if batch.num_rows else ((), ())
        lists = [pa.array(ids, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays([batch.column("quality"), *lists], names=["quality", "ids", "weights"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(projection of terms, labelled vectors): subspace iteration on the matrix of weighted terms."""
    x = np.zeros((len(rows), TERMS), dtype=np.float32)
    for k, (ids, weights) in enumerate(rows):
        x[k, ids] = weights
    rarity = np.log((len(rows) + 1) / ((x > 0).sum(axis=0) + 1)).astype(np.float32) + 1
    x = _unit(x * rarity)
    rank = min(rank, *x.shape)
    q = np.random.default_rng(1).standard_normal((TERMS, min(rank + 16, len(rows)))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    left, _, right = np.linalg.svd(x @ q, full_matrices=False)
    projection = (q @ right[:rank].T).astype(np.float32) * rarity[:, None]
    return projection, _unit(x @ (q @ right[:rank].T)).astype(np.float32)


def _fit(batches):
    rows, labels = [], []
    for batch in batches:
        labels += batch.column("quality").to_pylist()
        rows += list(zip(*(map(np.array, batch.column(c).to_pylist()) for c in ("ids", "weights")), strict=True))
    labels = np.array(labels, dtype=np.float32)
    rows, labels = [r for r in rows if len(r[0])], labels[[len(r[0]) > 0 for r in rows]]
    if not rows:
        return
    projection, vectors = fit(rows, labels)
    parts = [projection.tobytes(), vectors.tobytes(), labels.tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["projection", "vectors", "labels"])


def held_out(doc_id):
    """Documents whose labels are never learnt; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, ...] | None:
    """(projection, labelled vectors, labels), or None without labelled texts.

    Labels that are null or not 0 or 1 are passed over, of several for one doc_id the largest counts, and
    repeated documents count each.  The sample is ``max_labelled`` rows at most.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("float").alias("quality"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("quality", "text")
    terms = durable(sample.mapInArrow(_terms, "quality float, ids array<int>, weights array<float>"), "terms")
    terms = terms.orderBy(F.xxhash64("quality", "ids", "weights")).limit(max_labelled)
    model = durable(terms.coalesce(1).mapInArrow(_fit, "projection binary, vectors binary, labels binary"), "model").first()  # one row of bounded size
    if model is None:
        return None
    labels_ = np.frombuffer(model.labels, np.float32)
    vectors = np.frombuffer(model.vectors, np.float32).reshape(len(labels_), -1)
    return np.frombuffer(model.projection, np.float32).reshape(TERMS, -1), vectors, labels_


def vote(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of vectors from exact cosines with all labelled ones; a zero vector gets the share of label 1."""
    near = vectors @ known.T
    k = min(neighbours, known.shape[0])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** SHARPNESS
    return ((weight * labels[top]).sum(axis=1) + PRIOR * labels.mean(dtype=np.float64)) / (weight.sum(axis=1) + PRIOR)


def _scores(model):
    def run(batches):
        held = model.value
        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts) if held else 0, BLOCK):
                projection, known, labels = held
                vectors = np.zeros((min(BLOCK, len(texts) - at), projection.shape[1]), dtype=np.float32)
                for k in range(len(vectors)):
                    ids, weights = _damped(texts[at + k])
                    vectors[k] = weights @ projection[ids]
                out[at : at + BLOCK] = vote(_unit(vectors), known, labels)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, ...] | None) -> DataFrame:
    """doc_id and text's score between 0 and 1; an empty or null text scores the labelled share of 1, without a model all score 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by TERMS, RANK and MAX_LABELLED
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scores(shared), "doc_id long, text string, score double").select("doc_id", "score")


def quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``cut`` on) of every document, from the whole text alone.

    Rows without an id and rows that share one are scored each; other columns are ignored; an empty table gives none.
    """
    out = score(docs, train(docs, labels, max_labelled))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
