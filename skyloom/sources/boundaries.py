"""Boundary files as a data source: shapefiles and GeoJSON with a feature a line, one row a ring.

    spark.dataSource.register(Boundaries)
    spark.read.format("boundaries").load("/data/counties.shp")

Partitions are ranges of bytes: of a shapefile by its index (.shx), of lines as text files are split.  A task reads its
own range, and of the table beside a shapefile (.dbf) the rows of its records.  With a schema of fewer columns only these are decoded.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from skyloom.sources.files import Part, listed

SCHEMA = "path string, record bigint, ring int, hole boolean, points array<struct<x:double,y:double>>, properties map<string,string>"
PART_BYTES = 32 << 20
_POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
_ARROW = {"path": pa.string(), "record": pa.int64(), "ring": pa.int32(), "hole": pa.bool_(), "points": _POINTS, "properties": pa.map_(pa.string(), pa.string())}
_POLYGONS = (5, 15, 25)  # fixed values: polygons without and with heights and measures


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


def _shape_ranges(path: str, part_bytes: int) -> list[Range]:
    """Ranges of records of about ``part_bytes``, from the index alone."""
    with Part(path[:-4] + ".shx") as index:
        entries = np.frombuffer(index.read(100, (index.size - 100) // 8 * 8), dtype=">i4").reshape(-1, 2).astype(np.int64)
    ends = np.cumsum(entries[:, 1] * 2 + 8)
    cuts = np.flatnonzero(np.diff(ends // part_bytes)) + 1
    bounds = [0, *cuts.tolist(), len(entries)]
    return [Range(path, a, b) for a, b in zip(bounds, bounds[1:], strict=False) if a < b]


def _table(path: str, first: int, last: int) -> list[dict]:
    """Fields of the records first .. last of the table beside a shapefile; none without it."""
    try:
        part = Part(path[:-4] + ".dbf")
    except FileNotFoundError:
        return [{} for _ in range(first, last)]
    with part:
        rows, head, size = struct.unpack("<iHH", part.read(4, 8))
        if rows < last:
            raise ValueError(f"{path}: the table has {rows} rows, {last} are needed")
        fields, at = [], 1
        for k in range((head - 33) // 32):
            entry = part.read(32 + 32 * k, 32)
            if entry[:1] == b"\r":
                break
            fields.append((entry[:11].split(b"\0")[0].decode("latin-1"), at, at + entry[16]))
            at += entry[16]
        data = part.read(head + first * size, (last - first) * size)

    def text(raw: bytes) -> str:
        try:
            return raw.decode("utf-8").strip(" \0")
        except UnicodeDecodeError:
            return raw.decode("latin-1").strip(" \0")

    return [{name: text(data[k + a : k + b]) for name, a, b in fields} for k in range(0, len(data), size)]


def _clockwise(ring: np.ndarray) -> bool:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) < 0


def _shapes(path: str, first: int, last: int, table: bool) -> Iterator[tuple]:
    """(record, ring, hole, points, properties): outer rings run clockwise in these files, holes the other way."""
    with Part(path[:-4] + ".shx") as index:
        entries = np.frombuffer(index.read(100 + 8 * first, 8 * (last - first)), dtype=">i4").reshape(-1, 2).astype(np.int64) * 2
    properties = _table(path, first, last) if table else [{}] * (last - first)
    with Part(path) as part:
        for k, (offset, size) in enumerate(entries.tolist()):
            content = part.read(offset + 8, size)
            kind = struct.unpack_from("<i", content)[0]
            if kind == 0:
                continue
            if kind not in _POLYGONS:
                raise ValueError(f"{path}: record {first + k} is of type {kind}, not a polygon")
            parts, points = struct.unpack_from("<ii", content, 36)
            starts = [*np.frombuffer(content, "<i4", parts, 44).tolist(), points]
            xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
            for ring, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
                if b > a:
                    yield first + k, ring, not _clockwise(xy[a:b]), xy[a:b], properties[k]


def _lines(path: str, start: int, end: int) -> Iterator[tuple]:
    """Rings of the features whose lines start in the range; the first ring of a polygon is outside, the others are holes."""
    with Part(path) as part:
        at, rest = max(0, start - 1), b""
        skip = start > 0  # the line that the byte before the range belongs to is another task's
        while at < part.size or rest:
            if b"\n" not in rest and at < part.size:
                more = part.read(at, min(1 << 20, part.size - at))
                at += len(more)
                rest += more
                continue
            line, _, rest_after = rest.partition(b"\n")
            begin = at - len(rest)
            rest = rest_after
            if skip:
                skip = False
                continue
            if begin >= end:
                return
            if line.strip(b" \t\r\x1e,"):
                yield from _feature(path, begin, line.strip(b" \t\r\x1e,"))


def _feature(path: str, begin: int, line: bytes) -> Iterator[tuple]:
    try:
        feature = json.loads(line)
        shape, own = feature.get("geometry") or {}, feature.get("properties") or {}
        if not shape:
            return
        if shape["type"] not in ("Polygon", "MultiPolygon"):
            raise ValueError(f"a {shape['type']} is no polygon")
        polygons = [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]
        properties = {k: v if isinstance(v, str) else json.dumps(v) for k, v in own.items() if v is not None}
        rings = [(hole > 0, np.array([p[:2] for p in ring], dtype=np.float64)) for polygon in polygons for hole, ring in enumerate(polygon) if ring]
    except (ValueError, KeyError, TypeError, AttributeError) as e:
        raise ValueError(f"{path}: the feature at byte {begin} can't be read: {e}") from e
    for n, (hole, points) in enumerate(rings):
        yield begin, n, hole, points, properties


class BoundaryReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self._columns = [f.name for f in schema.fields]
        self._path, self._bytes = options["path"], int(options.get("part_bytes", PART_BYTES))

    def partitions(self) -> list[Range]:
        out = []
        for path, size in listed(self._path, ".shp", ".geojsonl", ".geojsons", ".ndjson", ".jsonl"):
            if path.lower().endswith(".shp"):
                out += _shape_ranges(path, self._bytes)
            else:
                out += [Range(path, a, min(a + self._bytes, size)) for a in range(0, size, self._bytes)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        shapes = part.path.lower().endswith(".shp")
        rings = _shapes(part.path, part.start, part.end, "properties" in self._columns) if shapes else _lines(part.path, part.start, part.end)
        held, points = [], 0
        for row in rings:
            held.append(row)
            points += len(row[3])
            if points > 200_000:
                yield self._batch(part.path, held)
                held, points = [], 0
        if held:
            yield self._batch(part.path, held)

    def _batch(self, path: str, rows: list[tuple]) -> pa.RecordBatch:
        record, ring, hole, points, properties = zip(*rows, strict=True)

        def geometry() -> pa.Array:
            xy, cuts = np.concatenate(points), np.cumsum([0, *map(len, points)])
            fields = [pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)]
            return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["x", "y"]))

        make = {"path": lambda: [path] * len(rows), "record": lambda: record, "ring": lambda: ring, "hole": lambda: hole, "properties": lambda: [list(p.items()) for p in properties]}
        arrays = [geometry() if c == "points" else pa.array(make[c](), _ARROW[c]) for c in self._columns]
        return pa.RecordBatch.from_arrays(arrays, names=self._columns)


class Boundaries(DataSource):
    """Options: path (a file, or a folder of them), part_bytes.  ``record`` is a shapefile's record or the byte where a feature's line starts."""

    @classmethod
    def name(cls) -> str:
        return "boundaries"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BoundaryReader:
        return BoundaryReader(schema, self.options)
