"""Embedding near-dedup: int8 tile products with rigorous error bounds, exact cosine where needed.

Vectors are dealt to cells around pivot vectors, cells are cut into blocks, and neighbouring blocks make
``GROUPS`` groups (more where a group would outgrow a task's memory).  A vector goes to the tiles of those groups only that
can hold a partner: the angle to a cell's pivot is at most the cell's radius plus the angle of the threshold (triangle inequality on the
sphere).  Within a tile the same inequality holds between centres of blocks.  Blocks multiply int8 values and bound the products'
errors by the vectors' own quantisation errors; only pairs possibly above the threshold are computed in full precision.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import components, durable, spanning_edges

THRESHOLD = 0.95
BLOCK = 2048
MAX_PIVOTS = 1024
SLACK = 1e-9
GROUPS = 16  # so many copies of a vector at most, as long as groups fit
GROUP_ROWS, GROUP_VALUES = 32768, 1 << 22  # vectors of a group, and numbers in them, at most
SENT = 16384  # rows of a batch that a task sends on


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales and exact error norms of unit rows: ``|row - scale * q| <= error``."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q, scale, error


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of the row pairs with cosine >= threshold in double precision."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    (qx, sx, ex), (qy, sy, ey) = quantise(x / nx[:, None]), quantise(y / ny[:, None])
    product = (qx * sx[:, None]).astype(np.float32) @ (qy * sy[:, None]).astype(np.float32).T
    # x = sx qx + dx: <x, y> differs by <sx qx, dy> + <dx, y>, at most |sx qx| ey + ex; the rest is what single precision may lose.
    longest = 1 + float(ex.max()), 1 + float(ey.max())
    error = longest[0] * float(ey.max()) + float(ex.max()) + SLACK + (x.shape[1] + 8) * 2.0**-23 * longest[0] * longest[1]
    linked = product >= threshold + error
    a, b = np.nonzero((product >= threshold - error) & ~linked)
    for k in range(0, len(a), 65536):
        i, j = a[k : k + 65536], b[k : k + 65536]
        linked[i, j] = np.einsum("ij,ij->i", x[i], y[j]) / (nx[i] * ny[j]) >= threshold
    return linked


def _read(batches):
    for batch in batches:
        ids, valid, digest, dims = batch.column("vec_id").to_pylist(), [], [], []
        for i, v in zip(ids, batch.column("embedding").to_pylist(), strict=True):
            ok = i is not None and bool(v) and None not in v
            x = np.array(v, dtype=np.float64) if ok else None
            ok = ok and bool(np.isfinite(x).all()) and bool(x.any()) and math.isfinite(float(np.linalg.norm(x)))
            valid.append(ok), digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if ok else None), dims.append(len(v) if ok else 0)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(valid), pa.array(digest, pa.binary()), pa.array(dims, pa.int32())], names=["vec_id", "embedding", "valid", "digest", "dims"])


def _units(column) -> np.ndarray:
    x = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _cells(pivots: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            dims, out_cell, out_angle = batch.column("dims").to_numpy(), np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                angle = np.arccos(np.clip(_units(batch.column("embedding").take(pa.array(at))) @ pivots[int(d)].T, -1, 1))
                out_cell[at], out_angle[at] = angle.argmin(axis=1), angle.min(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "copies", "embedding", "dims")), pa.array(out_cell), pa.array(out_angle)], names=["id", "copies", "embedding", "dims", "cell", "angle"])

    return run


def _grouped(pivots: dict[int, np.ndarray], sizes: dict[tuple[int, int], tuple[float, int]], block: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the cells, their radius and number of blocks, and the first block and group of each block; ``sizes`` has radius and rows of cells.

    Cells stand in the order of the angle to the first pivot, so that neighbours share a group more often.
    """
    out, first = {}, 0
    for d in sorted(pivots):
        near = np.argsort(-(pivots[d] @ pivots[d][0]), kind="stable")
        cells = np.array([c for c in near if (d, int(c)) in sizes], dtype=np.int64)
        radius, rows = (np.array(v) for v in zip(*(sizes[d, int(c)] for c in cells), strict=True))
        blocks = -(-rows // block)
        most = max(block, min(GROUP_ROWS, GROUP_VALUES // d))
        size = max(block, min(most, -(-int(rows.sum()) // GROUPS)))
        ahead = np.cumsum(np.repeat(rows / blocks, blocks)) - np.repeat(rows / blocks, blocks)
        group = first + np.unique((ahead // size).astype(np.int64), return_inverse=True)[1]
        out[d] = cells, radius, blocks, np.cumsum(blocks) - blocks, group
        first = int(group[-1]) + 1
    return out


def _deal(pivots: dict[int, np.ndarray], grouped: dict[int, tuple[np.ndarray, ...]], reach: float):
    """Sends each vector, as bytes, to the tiles (own group, other group) where it can have a partner, in batches of ``SENT`` rows."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                cells, radius, blocks, start, group = grouped[int(d)]
                place = np.zeros(len(pivots[int(d)]), np.int64)
                place[cells] = np.arange(len(cells))
                starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                at = np.flatnonzero(dims == d)
                for part in np.array_split(at, -(-len(at) // 1024)):
                    rows = batch.take(pa.array(part))
                    cell = place[rows.column("cell").to_numpy()]
                    own = group[start[cell] + rows.column("block").to_numpy()]
                    met = np.arccos(np.clip(_units(rows.column("embedding")) @ pivots[int(d)][cells].T, -1, 1)) <= radius + reach
                    met[np.arange(len(part)), cell] = True
                    met = np.logical_or.reduceat(np.repeat(met, blocks, axis=1), starts, axis=1)
                    index, other = np.nonzero(met)
                    other = group[starts][other]
                    vectors = rows.column("embedding").flatten().to_numpy().reshape(len(part), -1)
                    raw = pa.array([x.tobytes() for x in vectors], pa.binary())
                    for k in range(0, len(index), SENT):
                        i, o = index[k : k + SENT], other[k : k + SENT]
                        keep = pa.array(i)
                        sides = (own[i] > o).astype(np.int32)
                        sent = [rows.column("id").take(keep), rows.column("copies").take(keep), raw.take(keep), pa.array(cell[i])]
                        yield pa.RecordBatch.from_arrays([*sent, *map(pa.array, (np.minimum(own[i], o), np.maximum(own[i], o), sides))], names=["id", "copies", "embedding", "cell", "low", "high", "side"])

    return run


def _ball(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector and the largest angle to it of rows."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    centre = unit.sum(axis=0)
    length = float(np.linalg.norm(centre))
    if length == 0:
        return unit[0], math.pi
    return centre / length, float(np.arccos(np.clip(unit @ (centre / length), -1, 1)).max())


def _tile(threshold: float, kind: type, block: int):
    reach = math.acos(threshold) + 1e-6

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf.low.iloc[0] == pdf.high.iloc[0]
        pdf = pdf.sort_values(["cell", "id"])
        sides = [pdf, pdf] if same else [pdf[pdf.side == 0], pdf[pdf.side == 1]]
        x, ids, copies, balls = [], [], [], []
        for p in sides:
            values = np.frombuffer(b"".join(p.embedding), dtype=kind).reshape(len(p), -1) if len(p) else np.empty((0, 1))
            x.append(values), ids.append(p.id.to_numpy()), copies.append(p.copies.to_numpy())
            balls.append([_ball(values[k : k + block].astype(np.float64)) for k in range(0, len(p), block)])
        count, edges = [np.zeros(len(p), np.int64) for p in sides], []
        for i, (cx, rx) in enumerate(balls[0]):
            a = slice(i * block, (i + 1) * block)
            for j in range(i if same else 0, len(balls[1])):
                cy, ry = balls[1][j]
                if math.acos(min(1.0, max(-1.0, float(cx @ cy)))) > rx + ry + reach:
                    continue
                b = slice(j * block, (j + 1) * block)
                linked = close_pairs(x[0][a].astype(np.float64), x[1][b].astype(np.float64), threshold)
                if same and i == j:
                    linked |= linked.T
                    np.fill_diagonal(linked, False)
                p, q = np.nonzero(linked)
                if not len(p):
                    continue
                np.add.at(count[0][a], p, copies[1][b][q])
                if not (same and i == j):
                    np.add.at(count[0 if same else 1][b], q, copies[0][a][p])
                both = np.concatenate((ids[0][a], ids[1][b]))
                edges += [(int(both[u]), int(both[v]), 0) for u, v in spanning_edges(linked) if both[u] != both[v]]
        out = [(int(i), None, int(c)) for s in range(1 if same else 2) for i, c in zip(ids[s], count[s], strict=True) if c] + edges
        return pd.DataFrame(out, columns=["u", "v", "links"]).astype({"u": "int64", "v": "Int64", "links": "int64"})

    return run


def embedding_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, max_pivots: int = MAX_PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable by links), kept.

    Links are pairs with cosine >= threshold (positive) in double precision.  Vectors that
    are null, empty, zero or hold null or non-finite components, and rows without an id, link
    with nothing; vectors of different length never link.  Equal vectors are one class with a
    count, so copies cost one row; rows of one id with different vectors are vectors of their own that
    report the same id (all of them are kept where it is the smallest of its component).  Pivots: at most ``max_pivots`` vectors a length, those with the
    smallest digests (bounded; they only steer the work, every pair is covered).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    read = durable(rows.mapInArrow(_read, "vec_id long, embedding array<float>, valid boolean, digest binary, dims int" if dict(rows.dtypes)["embedding"] == "array<float>" else "vec_id long, embedding array<double>, valid boolean, digest binary, dims int"), "vectors")
    classes = durable(read.where("valid").groupBy("digest", "dims").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies")), "classes")
    classes = durable(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    per_length = classes.groupBy("dims").agg(F.count("*").alias("n")).collect()
    kind = dict(rows.dtypes)["embedding"]
    own = read.where("valid").dropDuplicates(["vec_id", "digest"])
    own = own.join(classes.select(F.col("low").alias("vec_id"), "digest", "id", "copies"), ["vec_id", "digest"]).select("id", "copies", "embedding", "dims", "digest")
    own = durable(own, "representatives")
    pivots = {}
    for d, n in ((r.dims, r.n) for r in per_length):
        some = own.where(F.col("dims") == d).orderBy("digest").limit(min(max_pivots, -(-n // block))).select("embedding").collect()
        x = np.array([r.embedding for r in some], dtype=np.float64)
        pivots[d] = x / np.linalg.norm(x, axis=1)[:, None]
    placed = own.drop("digest").mapInArrow(_cells(pivots), f"id long, copies long, embedding {kind}, dims int, cell int, angle double")
    placed = durable(placed, "placed")
    # One row a pivot: bounded by max_pivots times the number of vector lengths.
    sizes = placed.groupBy("dims", "cell").agg(F.max("angle").alias("r"), F.count("*").alias("n")).collect()
    sizes = {(r.dims, r.cell): (r.r + SLACK, r.n) for r in sizes}
    counts = vectors.sparkSession.createDataFrame([(d, c, -(-n // block)) for (d, c), (_, n) in sizes.items()], "dims int, cell int, blocks int")
    placed = placed.join(F.broadcast(counts), ["dims", "cell"]).withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
    dealt = placed.mapInArrow(_deal(pivots, _grouped(pivots, sizes, block), math.acos(threshold) + 1e-6), "id long, copies long, embedding binary, cell long, low long, high long, side int")
    found = durable(dealt.groupBy("low", "high").applyInPandas(_tile(threshold, np.float32 if kind == "array<float>" else np.float64, block), "u long, v long, links long"), "tiles")
    links = found.where("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    found_components = components(found.where("v is not null").select("u", "v"))
    labelled = classes.join(links, "id", "left").join(found_components, "id", "left")
    labelled = labelled.select("digest", "low", F.expr("coalesce(links, 0) + copies - 1").alias("n_links"), F.coalesce("component", "id").alias("component"))
    first = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    labelled = labelled.join(first, "component").select("digest", "n_links", "component_id")
    out = read.select("vec_id", "digest").join(labelled, "digest", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
