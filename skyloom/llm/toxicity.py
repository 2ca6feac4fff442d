"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The model is fitted on a bounded sample of labelled texts (``MAX_LABELLED``, whole texts, the
smallest hashes of doc_id) in one task; its weights are at most ``DIMENSIONS`` numbers, and
every document is scored by tasks that look them up.  Only the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import durable

GRAMS = (4, 5, 6)
DIMENSIONS = 1 << 20
MAX_LABELLED = 8_000
MIN_DOCUMENTS = 5
MIN_EVIDENCE = 30.0
SMOOTHING = 1.0
RIDGE = 1e-4
STEPS = 200
CUT = 0.7


def features(text: str | None) -> np.ndarray:
    """Hashed character n-grams of the text in lower case, one for each place."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = []
    for n in GRAMS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, np.uint64(n))
            for j in range(n):
                h = (h ^ codes[j : len(codes) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append(h >> np.uint64(44))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def fit(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature ids, weights, intercept); without both classes only the smoothed share of label 1."""
    toxic = np.asarray(toxic, dtype=np.float64)
    none = np.empty(0, np.int64), np.empty(0)
    share = (toxic.sum() + 0.5) / (len(toxic) + 1)
    if len(set(toxic.tolist())) < 2:
        return *none, float(np.log(share / (1 - share)))
    sets = [np.unique(features(t)).astype(np.int32) for t in texts]
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    p, q = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for s, y in zip(sets, toxic, strict=True):
        (p if y else q)[s] += 1
    ratio = np.log((p + SMOOTHING) / (n1 + SMOOTHING)) - np.log((q + SMOOTHING) / (n0 + SMOOTHING))
    # Features that tell nothing are left out: chi-square of presence against the label.
    expected = (p + q) * n1 / (n1 + n0)
    evidence = (p - expected) ** 2 / np.maximum(expected * (n0 / (n1 + n0)), 1e-9)
    kept = np.flatnonzero((p + q >= MIN_DOCUMENTS) & (evidence >= MIN_EVIDENCE))
    if not len(kept):
        return *none, float(np.log(share / (1 - share)))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    live = [c[c >= 0] for c in (place[s] for s in sets)]
    rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(c) for c in live])
    columns = np.concatenate(live)
    x = ratio[kept][columns]
    weight, bias = np.zeros(len(kept)), float(np.log(share / (1 - share)))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):  # Adam on the ridge-penalised logistic loss
        z = np.bincount(rows, weights=weight[columns] * x, minlength=len(sets)) + bias
        miss = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic
        grad = np.append(np.bincount(columns, weights=miss[rows] * x, minlength=len(kept)) / len(sets) + RIDGE * weight, miss.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return kept, weight * ratio[kept], float(bias)


def _fit(batches):
    texts, toxic = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        toxic += batch.column("toxic").to_pylist()
    ids, weights, bias = fit(texts, np.array(toxic))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(ids, -1), pa.int64()), pa.array(np.append(weights, bias), pa.float64())], names=["feature", "weight"])


def held_out(doc_id):
    """Documents whose labels are never learnt; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[int, float]:
    """Feature weights, the intercept at -1.

    Labels that are null or not 0 or 1 are passed over, of several for one doc_id the largest
    counts, and repeated documents count each.  The sample is ``max_labelled`` documents at most.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", "text").alias("k"))
    sample = sample.orderBy("k").limit(max_labelled).drop("k")
    model = durable(sample.coalesce(1).mapInArrow(_fit, "feature long, weight double"), "model")
    return {r.feature: r.weight for r in model.collect()}  # at most DIMENSIONS + 1 rows


def _scores(model):
    def run(batches):
        weights = model.value
        bias = weights.get(-1, 0.0)
        table = np.zeros(DIMENSIONS)
        for k, w in weights.items():
            if k >= 0:
                table[k] = w
        live = table != 0
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                ids = features(text)
                out.append(1 / (1 + np.exp(-np.clip(bias + table[np.unique(ids[live[ids]])].sum(), -40, 40))))
            columns = [c for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(out, pa.float64())], names=[*columns, "score"])

    return run


def score(docs: DataFrame, model: dict[int, float]) -> DataFrame:
    """The rows with a score between 0 and 1; a null text is empty and scores the intercept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by DIMENSIONS
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scores(shared), f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, from the whole text alone."""
    model = train(docs, labels, max_labelled)
    out = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
