"""MinHash near-dedup: circulant MinHash signatures, banding, exact verification, components.

Two permutations of a universe of ``UNIVERSE`` places make a whole signature: the first
scatters the shingles over the places, the second, shifted circularly by k, gives
coordinate k.  Bands of ``ROWS`` coordinates make the candidate keys; 32 bands of 4 miss a
pair of similarity 0.75 with a probability of about 5e-6.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import durable, link_components, rows_of, spanning_edges

UNIVERSE = 1 << 20
BANDS, ROWS = 32, 4
WORDS = 5
PERCENT = 75
SEED = 20_260_101
PLACES = 32
TILE_ROWS, TILE_ELEMENTS = 512, 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_LANES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)

_OFFSETS = _LANES * np.arange(1, 6, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """A random number for each byte at each of the first places of a word."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, (PLACES, 256), dtype=np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per word ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case.

    A word's hash sums up a random number for each of its bytes and that byte's place.  Unlike powers of one base these have
    no structure that words could share, so different words agree with a probability of 2**-64.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    inside = np.concatenate(([False], (raw != 32) & ((raw < 9) | (raw > 13)), [False]))
    start, end = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    held = raw[inside[1:-1]]
    size = end - start
    place = np.arange(len(held)) - np.repeat(np.cumsum(size) - size, size)
    values = _letters()[np.minimum(place, PLACES - 1), held]
    far = np.flatnonzero(place >= PLACES - 1)
    if len(far):  # later places of long words: the byte's number and the place are mixed twice
        values[far] = _mix(_mix(values[far] + place[far].astype(np.uint64) * _LANES[0]) + place[far].astype(np.uint64) * _LANES[1])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    at = np.cumsum(size)
    return _mix(sums[at] - sums[at - size] + size.astype(np.uint64) * _LANES[2])


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a shorter text is one shingle, one without words has none."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    out = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        out += _mix(words[j : n - width + 1 + j] + _OFFSETS[j % 5]) * _LANES[(j + 2) % 5]
    return np.unique(_mix(out))


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    scatter, circle = (random.permutation(UNIVERSE).astype(np.uint32) for _ in range(2))
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate((circle, circle[: BANDS * ROWS])), BANDS * ROWS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` circulant MinHash coordinates of a set that isn't empty."""
    scatter, shifted = _permutations()
    places = scatter[shingles & np.uint64(UNIVERSE - 1)]
    low = shifted[places[:2048]].min(axis=0)
    for k in range(2048, len(places), 2048):
        low = np.minimum(low, shifted[places[k : k + 2048]].min(axis=0))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BASE)
    for j in range(ROWS):
        key = _mix(key + rows[:, j] * _LANES[j])
    return key


def _features(batches):
    for batch in batches:
        n, hi, lo, bands = [], [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            a, b = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64)
            n.append(len(s)), hi.append(a), lo.append(b)
            bands.append(band_keys(signature(s)).view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "hi", "lo", "bands"],
        )


def _sets(batches):
    for batch in batches:
        s = [shingle_set(t).view(np.int64) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s, pa.list_(pa.int64()))], names=["id", "s"])


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by products of incidence matrices."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = (np.concatenate(x) if len(x) else np.empty(0, np.int64) for x in (left, right))
    names = np.intersect1d(a, b)
    sides = []
    for flat, sets in ((a, left), (b, right)):
        at = np.searchsorted(names, flat)
        hit = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == flat) if len(names) else np.zeros(len(flat), bool)
        sides.append((np.repeat(np.arange(len(sets)), [len(x) for x in sets])[hit], at[hit]))
    for k in range(0, len(names), columns):
        parts = []
        for (rows, at), sets in zip(sides, (left, right), strict=True):
            here = (at >= k) & (at < k + columns)
            m = np.zeros((len(sets), min(columns, len(names) - k)), dtype=np.float32)
            m[rows[here], at[here] - k] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _tile(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        edges = []
        if len(left) and len(right):
            x, y = ([np.asarray(v) for v in p.s] for p in (left, right))
            n = np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])[None]
            both = shared_counts(x, y)
            linked = (both * 100 >= (n - both) * percent) & (left.c.to_numpy()[:, None] != right.c.to_numpy()[None])
            ids = np.concatenate((left.id.to_numpy(), right.id.to_numpy()))
            edges = [(ids[a], ids[b]) for a, b in spanning_edges(linked)]
        return pd.DataFrame(edges, columns=["u", "v"]).astype("int64")

    return run


def _tiles(members: DataFrame, sets_of, percent: int) -> DataFrame:
    """Edges (u, v) among the members of wide keys: tiles of bounded size, compared inside tasks.

    Keys with the same largest component are one group, so a document moves once and not once a
    key. A group's members outside that component (side 0) meet all its members (side 1); both
    are dealt to blocks by hash, so a hot group makes many tiles, and only connecting edges
    leave a tile.
    """
    once = members.select(F.col("big").alias("key"), "id", "c", "n").distinct().withColumn("out", F.col("c") != F.col("key"))
    sizes = once.groupBy("key").agg(F.count("*").alias("m"), F.count_if("out").alias("outside"), F.sum("n").alias("elements"), F.sum(F.when(F.col("out"), F.col("n")).otherwise(0)).alias("outer"))
    enough = lambda rows, elements: F.greatest(F.ceil(F.col(rows) / TILE_ROWS), F.ceil(F.col(elements) / TILE_ELEMENTS))
    blocks = once.join(sizes, "key").withColumns({"rows": enough("m", "elements"), "parts": enough("outside", "outer")})
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    small = blocks.where("out").select("key", "id", "c", F.lit(0).alias("side"), place("parts").alias("i"), span("rows").alias("j"))
    every = blocks.select("key", "id", "c", F.lit(1).alias("side"), span("parts").alias("i"), place("rows").alias("j"))
    sets = sets_of(members.select("id").distinct())
    dealt = small.unionByName(every).join(sets, "id")
    return dealt.groupBy("key", "i", "j").applyInPandas(_tile(percent), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", open_limit: int = 500) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their distinct
    5-word shingles, confirmed on the full sets; component_id is the smallest doc_id that
    is reachable.  Equal sets are one class from the start, so copies cost one row each.
    Null, empty and blank texts have no shingles and are linked with nothing.  A row
    without an id is its own (component_id null, kept); rows that share an id count as one
    document.  Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    features = durable(rows.mapInArrow(_features, "doc_id long, n_shingles long, hi long, lo long, bands array<long>"), "features")
    real = features.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("hi", "lo").agg(F.min("doc_id").alias("id"))
    classes = durable(classes, "classes")
    keyed = features.join(classes.select(F.col("id").alias("doc_id"), "hi", "lo"), ["doc_id", "hi", "lo"]).select(F.col("doc_id").alias("id"), "bands")

    def sets_of(ids: DataFrame) -> DataFrame:
        return rows_of(rows.select(F.col("doc_id").alias("id"), "text"), ids).mapInArrow(_sets, "id long, s array<long>")

    keys = durable(keyed.select("id", F.explode("bands").alias("key")), "bands")
    found = link_components(keys, sets_of, percent, open_limit, wide_edges=lambda wide: _tiles(wide, sets_of, percent))
    labelled = classes.join(found, "id", "left").select("hi", "lo", F.coalesce("component", "id").alias("component"))
    out = features.select("doc_id", "n_shingles", "hi", "lo").join(labelled, ["hi", "lo"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component")))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
