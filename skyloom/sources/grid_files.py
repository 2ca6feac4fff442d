"""Scans of gridded observation files as a data source: classic NetCDF, a slab of rows a partition.

    spark.dataSource.register(GridFiles)
    spark.read.format("grid_files").option("production", "true").load("hdfs://.../scans")

A file's header is read once, where partitions are made; a task reads the bytes of its rows alone.  With the option
``prune`` filters on ``grid_row`` leave slabs out; it needs ``spark.sql.python.filterPushdown.enabled``.  Whatever is
wrong with a file is an error that names it.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from skyloom.functions.exprs import GRID_COLS, GRID_LAT0, GRID_LON0, GRID_ROWS, GRID_STEP, MISSING_FLAG
from skyloom.schemas import GRID_CELLS
from skyloom.sources.files import Part, listed

# Names in the files, and the format's types with their sizes and default fill values.
VALUE, FLAG, LATITUDE, LONGITUDE, TIME = "vertical_column_troposphere", "main_data_quality_flag", "latitude", "longitude", "time"
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
_FILLS = {3: -32767, 4: -2147483647, 5: 9.9692099683868690e36, 6: 9.9692099683868690e36, 8: 65535, 9: 4294967295, 10: -9223372036854775806, 11: 18446744073709551614}
_SECONDS = {"d": 86400, "h": 3600, "m": 60, "s": 1}
TOLERANCE = 1e-5


@dataclass
class Variable:
    dims: list[tuple[str, int]]
    attributes: dict
    kind: int
    begin: int

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(n for _, n in self.dims)

    def read(self, part: Part, start: int = 0, count: int | None = None) -> np.ndarray:
        """Values start .. start + count of the flat array."""
        kind = np.dtype(_TYPES[self.kind])
        count = int(np.prod(self.shape, dtype=np.int64)) if count is None else count
        return np.frombuffer(part.read(self.begin + start * kind.itemsize, count * kind.itemsize), dtype=kind)

    def numbers(self, part: Part, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, masked): fill values and values outside the valid range are masked, scale and offset applied."""
        raw, own = self.read(part, start, count), self.attributes
        masked = np.zeros(len(raw), dtype=bool)
        for name in ("_FillValue", "missing_value"):
            if name in own:
                masked |= np.isin(raw, np.atleast_1d(own[name]).astype(raw.dtype))
        if "_FillValue" not in own and self.kind in _FILLS:
            masked |= raw == np.array(_FILLS[self.kind]).astype(raw.dtype)
        low, high = own["valid_range"] if "valid_range" in own else (own.get("valid_min"), own.get("valid_max"))
        for bound, outside in ((low, np.less), (high, np.greater)):
            if bound is not None:
                masked |= outside(raw, bound)
        values = raw.astype(np.float64)
        if "scale_factor" in own or "add_offset" in own:
            values = values * float(own.get("scale_factor", 1)) + float(own.get("add_offset", 0))
        return values, masked


@dataclass
class Header:
    variables: dict[str, Variable] = field(default_factory=dict)


class _Bytes:
    """A cursor over a file's header; more of the file is read as it is needed."""

    def __init__(self, part: Part):
        self._part, self._at, self._data = part, 0, b""

    def take(self, n: int) -> bytes:
        while self._at + n > len(self._data):
            more = min(max(1 << 16, n), self._part.size - len(self._data))
            if more <= 0:
                raise ValueError("the header is cut off")
            self._data += self._part.read(len(self._data), more)
        self._at += n
        return self._data[self._at - n : self._at]

    def number(self, size: int = 4) -> int:
        return struct.unpack(">i" if size == 4 else ">q", self.take(size))[0]

    def text(self, wide: int) -> str:
        n = self.number(wide)
        return self.take(n + -n % 4)[:n].decode("utf-8")


def read_header(part: Part) -> Header:
    """Variables of a classic file (versions 1, 2 and 5) with their shapes, attributes and places."""
    at = _Bytes(part)
    magic = at.take(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise ValueError("this is no classic NetCDF file")
    wide, offset = (8 if magic[3] == 5 else 4), (4 if magic[3] == 1 else 8)
    records = at.number(wide)

    def items(tag: int) -> int:
        found, n = at.number(), at.number(wide)
        if found not in (0, tag) or n < 0:
            raise ValueError("the header can't be read")
        return n

    def attributes() -> dict:
        out = {}
        for _ in range(items(12)):
            name, kind, n = at.text(wide), at.number(), at.number(wide)
            size = n * np.dtype(_TYPES[kind]).itemsize
            data = at.take(size + -size % 4)[:size]
            values = data.decode("utf-8", "replace") if kind == 2 else np.frombuffer(data, dtype=_TYPES[kind])
            out[name] = values if kind == 2 or len(values) != 1 else values[0]
        return out

    dims = [(at.text(wide), at.number(wide)) for _ in range(items(10))]
    dims = [(name, n or records) for name, n in dims]  # the record dimension is written as 0
    attributes()
    header = Header()
    for _ in range(items(11)):
        name = at.text(wide)
        own = [dims[at.number(wide)] for _ in range(at.number(wide))]
        notes, kind, _ = attributes(), at.number(), at.number(wide)
        header.variables[name] = Variable(own, notes, kind, at.number(offset))
    return header


def decode_time(value: float, units: str | None) -> dt.datetime:
    """A number of ``days|hours|minutes|seconds since <time>`` as naive UTC."""
    found = re.fullmatch(r"\s*(days?|d|hours?|hrs?|h|minutes?|mins?|seconds?|secs?|s)\s+since\s+(.+?)\s*", (units or "").lower())
    if not found:
        raise ValueError("the time has no units that can be read")
    since = dt.datetime.fromisoformat(re.sub(r"\s*(utc|z)$", "+00:00", found[2]).upper())
    if since.tzinfo:
        since = since.astimezone(dt.UTC).replace(tzinfo=None)
    return since + dt.timedelta(microseconds=round(float(value) * _SECONDS[found[1][0]] * 1_000_000))


def _plane(name: str, v: Variable) -> tuple[int, int]:
    dims = v.dims
    if dims and dims[0][0] == TIME:
        if dims[0][1] != 1:
            raise ValueError(f"{name} must hold exactly one time")
        dims = dims[1:]
    if len(dims) != 2 or any(d == TIME for d, _ in dims):
        raise ValueError(f"{name} must have exactly two dimensions in space")
    return dims[0][1], dims[1][1]


def check(part: Part, header: Header, production: bool) -> tuple[tuple[int, int], dt.datetime]:
    """The shape and the time of a scan; an error if variables are missing, shapes differ, or, in production, the grid is another."""
    have = header.variables
    for name in (VALUE, FLAG, LATITUDE, LONGITUDE, TIME):
        if name not in have:
            raise ValueError(f"{name} is missing")
    shape = _plane(VALUE, have[VALUE])
    if shape != _plane(FLAG, have[FLAG]):
        raise ValueError("values and flags have different shapes")
    for name, n in ((LATITUDE, shape[0]), (LONGITUDE, shape[1])):
        if have[name].shape not in ((n,), shape):
            raise ValueError(f"{name} doesn't fit the shape of the values")
    if production:
        if shape != (GRID_ROWS, GRID_COLS):
            raise ValueError(f"the grid must have {GRID_ROWS} rows and {GRID_COLS} columns, not {shape[0]} and {shape[1]}")
        for name, n, origin in ((LATITUDE, GRID_ROWS, GRID_LAT0), (LONGITUDE, GRID_COLS, GRID_LON0)):
            if len(have[name].shape) != 1:
                raise ValueError(f"{name} must have one dimension")
            if not (np.abs(have[name].read(part).astype(np.float64) - (origin + GRID_STEP * np.arange(n))) <= TOLERANCE).all():
                raise ValueError(f"{name} is not that of the grid")
    if not np.prod(have[TIME].shape, dtype=np.int64):
        raise ValueError("the time is empty")
    return shape, decode_time(have[TIME].read(part, 0, 1)[0], have[TIME].attributes.get("units"))


@dataclass
class Slab(InputPartition):
    path: str
    header: Header
    shape: tuple[int, int]
    time: dt.datetime
    first: int
    last: int


class GridReader(DataSourceReader):
    def __init__(self, schema, options):
        self._columns = [f.name for f in schema.fields]
        self._schema = schema
        self._path, self._rows = options["path"], int(options.get("slab_rows", 256))
        self._production = str(options.get("production", "false")).lower() == "true"
        self._low, self._high = 0, 2**62

    def partitions(self) -> list[Slab]:
        out = []
        for path, _ in listed(self._path, ".nc", ".nc4", ".netcdf", ".cdf"):
            try:
                with Part(path) as part:
                    header = read_header(part)
                    shape, time = check(part, header, self._production)
            except Exception as e:
                raise ValueError(f"{path}: {e}") from e
            header.variables = {k: header.variables[k] for k in (VALUE, FLAG, LATITUDE, LONGITUDE)}
            for first in range(0, shape[0], self._rows):
                last = min(first + self._rows, shape[0])
                if first <= self._high and last > self._low:
                    out.append(Slab(path, header, shape, time, first, last))
        return out

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        cols, step = slab.shape[1], max(1, (1 << 18) // max(slab.shape[1], 1))
        with Part(slab.path) as part:
            for first in range(slab.first, slab.last, step):
                n = min(step, slab.last - first)
                row = np.repeat(np.arange(first, first + n, dtype=np.int32), cols)
                yield self._batch(part, slab, row, np.tile(np.arange(cols, dtype=np.int32), n), first * cols)

    def _batch(self, part: Part, slab: Slab, row: np.ndarray, col: np.ndarray, start: int) -> pa.RecordBatch:
        have, n = slab.header.variables, len(row)

        def coordinate(name: str, index: np.ndarray) -> np.ndarray:
            if len(have[name].shape) == 1:
                return have[name].read(part)[index].astype(np.float64)
            return have[name].read(part, start, n).astype(np.float64)

        def numbers(name: str, missing: float) -> np.ndarray:
            values, masked = have[name].numbers(part, start, n)
            return np.where(masked, missing, values)

        hour = slab.time.replace(minute=0, second=0, microsecond=0)
        name = re.split(r"[/\\]", slab.path)[-1].rsplit(".", 1)[0]
        make = {
            "granule_id": lambda: pa.array([name] * n),
            "observation_time": lambda: pa.array([slab.time] * n, pa.timestamp("us")),
            "observation_hour": lambda: pa.array([hour] * n, pa.timestamp("us")),
            "grid_row": lambda: pa.array(row),
            "grid_col": lambda: pa.array(col),
            "no2": lambda: pa.array(numbers(VALUE, np.nan), pa.float64()),
            "quality_flag": lambda: pa.array(numbers(FLAG, MISSING_FLAG).astype(np.int32)),
            "latitude": lambda: pa.array(coordinate(LATITUDE, row), pa.float64()),
            "longitude": lambda: pa.array(coordinate(LONGITUDE, col), pa.float64()),
        }
        return pa.RecordBatch.from_arrays([make[c]() for c in self._columns], names=self._columns)


class PruningGridReader(GridReader):
    def pushFilters(self, filters):
        """Bounds of grid_row choose the slabs; Spark still tests the rows of those."""
        for f in filters:
            if getattr(f, "attribute", None) == ("grid_row",):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self._low = max(self._low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self._high = min(self._high, f.value - isinstance(f, LessThan))
            yield f


class GridFiles(DataSource):
    """Options: path (a file, or a folder of them), production (the whole grid is required), slab_rows, prune (by filters).

    With a schema of fewer columns only these are read and decoded.  A masked value is NaN, a masked flag -9999.
    """

    @classmethod
    def name(cls) -> str:
        return "grid_files"

    def schema(self):
        return GRID_CELLS

    def reader(self, schema) -> GridReader:
        prune = str(self.options.get("prune", "false")).lower() == "true"
        return (PruningGridReader if prune else GridReader)(schema, self.options)
