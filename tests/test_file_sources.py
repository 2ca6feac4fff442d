import datetime as dt
import json
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions.exprs import GRID_COLS, GRID_ROWS
from skyloom.schemas import GRID_CELLS
from skyloom.sources import boundaries, grid_files


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    spark.dataSource.register(grid_files.GridFiles)
    spark.dataSource.register(boundaries.Boundaries)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


KINDS = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6}


def write_cdf(path, dims, variables, version=1, record=None):
    """A classic file: dims {name: size}, variables {name: (dims, array, attributes)}."""
    wide, offset = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    text = lambda s: struct.pack(wide, len(s)) + pad(s.encode())

    def notes(own):
        out = struct.pack(">i", 12 if own else 0) + struct.pack(wide, len(own))
        for k, v in own.items():
            data = v.encode() if isinstance(v, str) else np.atleast_1d(v).astype(np.atleast_1d(v).dtype.newbyteorder(">")).tobytes()
            kind, n = (2, len(v)) if isinstance(v, str) else (KINDS[np.atleast_1d(v).dtype.str[1:]], len(np.atleast_1d(v)))
            out += text(k) + struct.pack(">i", kind) + struct.pack(wide, n) + pad(data)
        return out

    data = {k: pad(a.astype(a.dtype.newbyteorder(">")).tobytes()) for k, (_, a, _) in variables.items()}

    def header(begins):
        out = b"CDF" + bytes([version]) + struct.pack(wide, 1 if record else 0) + struct.pack(">i", 10) + struct.pack(wide, len(dims))
        for k, n in dims.items():
            out += text(k) + struct.pack(wide, 0 if k == record else n)
        out += notes({}) + struct.pack(">i", 11) + struct.pack(wide, len(variables))
        for k, (own, a, att) in variables.items():
            out += text(k) + struct.pack(wide, len(own)) + b"".join(struct.pack(wide, list(dims).index(d)) for d in own)
            out += notes(att) + struct.pack(">i", KINDS[a.dtype.str[1:]]) + struct.pack(wide, len(data[k])) + struct.pack(offset, begins[k])
        return out

    size = len(header(dict.fromkeys(variables, 0)))
    begins = {}
    for k in variables:
        begins[k], size = size, size + len(data[k])
    path.write_bytes(header(begins) + b"".join(data.values()))


def small(**changed):
    made = {
        "latitude": (("y", "x"), np.array([[34.0, 34.1], [33.9, 34.2]], "f4"), {}),
        "longitude": (("y", "x"), np.array([[-118.2, -118.1], [-118.3, -118.0]], "f4"), {}),
        "vertical_column_troposphere": (("time", "y", "x"), np.array([[[2.5e15, 3.1e15], [1.8e15, np.nan]]], "f4"), {}),
        "main_data_quality_flag": (("time", "y", "x"), np.array([[[0, 1], [0, 2]]], "i2"), {}),
        "time": (("time",), np.array([hours(2026, 7, 12, 12)], "f8"), {"units": "hours since 1970-01-01 00:00:00"}),
    }
    made.update(changed)
    return {k: v for k, v in made.items() if v}


def hours(*at):
    return (dt.datetime(*at) - dt.datetime(1970, 1, 1)).total_seconds() / 3600


DIMS = {"time": 1, "y": 2, "x": 2}


@pytest.mark.parametrize("version,record", [(1, None), (2, "time"), (5, None)])
def test_a_scan_is_read_back(spark, tmp_path, version, record):
    write_cdf(tmp_path / "g1.nc", DIMS, small(), version, record)
    df = spark.read.format("grid_files").load(str(tmp_path))
    assert df.schema.fieldNames() == GRID_CELLS.fieldNames()
    rows = sorted(df.collect(), key=lambda r: (r.grid_row, r.grid_col))
    assert [(r.granule_id, r.grid_row, r.grid_col, r.quality_flag) for r in rows] == [("g1", 0, 0, 0), ("g1", 0, 1, 1), ("g1", 1, 0, 0), ("g1", 1, 1, 2)]
    assert [r.no2 for r in rows[:3]] == [float(np.float32(v)) for v in (2.5e15, 3.1e15, 1.8e15)] and math.isnan(rows[3].no2)
    assert [round(r.latitude, 4) for r in rows] == [34.0, 34.1, 33.9, 34.2] and round(rows[3].longitude, 4) == -118.0
    assert {(r.observation_time, r.observation_hour) for r in rows} == {(dt.datetime(2026, 7, 12, 12), dt.datetime(2026, 7, 12, 12))}


def test_masks_scale_and_times(spark, tmp_path):
    value = (("y", "x"), np.array([[1, 2], [-7, 900]], "i2"), {"_FillValue": np.int16(-7), "scale_factor": np.float64(0.5), "add_offset": np.float64(10), "valid_max": np.int16(500)})
    flag = (("y", "x"), np.array([[0, -32767], [2, 1]], "i2"), {})
    time = (("time",), np.array([90.5], "f8"), {"units": "minutes since 2026-07-12T11:00:00Z"})
    write_cdf(tmp_path / "g.nc", DIMS, small(vertical_column_troposphere=value, main_data_quality_flag=flag, time=time))
    rows = spark.read.format("grid_files").load(str(tmp_path / "g.nc")).orderBy("grid_row", "grid_col").collect()
    assert [r.no2 for r in rows[:2]] == [10.5, 11.0] and all(math.isnan(r.no2) for r in rows[2:])
    assert [r.quality_flag for r in rows] == [0, -9999, 2, 1] and rows[0].observation_time == dt.datetime(2026, 7, 12, 12, 30, 30)


@pytest.mark.parametrize(
    "changed,message",
    [
        ({"main_data_quality_flag": None}, "main_data_quality_flag is missing"),
        ({"latitude": None}, "latitude is missing"),
        ({"main_data_quality_flag": (("y", "z"), np.zeros((2, 3), "i2"), {})}, "different shapes"),
        ({"vertical_column_troposphere": (("y",), np.zeros(2, "f4"), {})}, "two dimensions"),
        ({"vertical_column_troposphere": (("two", "y", "x"), np.zeros((2, 2, 2), "f4"), {})}, "two dimensions"),
        ({"longitude": (("z",), np.zeros(3, "f4"), {})}, "longitude doesn't fit"),
        ({"time": (("time",), np.zeros(1, "f8"), {})}, "no units"),
        ({"time": (("none",), np.zeros(0, "f8"), {"units": "hours since 2020-01-01"})}, "time is empty"),
    ],
)
def test_files_that_are_no_scans(spark, tmp_path, changed, message):
    write_cdf(tmp_path / "bad.nc", DIMS | {"z": 3, "two": 2} | ({"none": 0} if "time" in changed else {}), small(**changed))
    with pytest.raises(Exception, match=message) as e:
        spark.read.format("grid_files").load(str(tmp_path)).collect()
    assert "bad.nc" in str(e.value)


def test_other_files_and_other_grids_are_refused(spark, tmp_path):
    (tmp_path / "x.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + b"\0" * 100)
    with pytest.raises(Exception, match="no classic NetCDF"):
        spark.read.format("grid_files").load(str(tmp_path)).collect()
    write_cdf(tmp_path / "x.nc", DIMS, small())
    with pytest.raises(Exception, match="2950 rows"):
        spark.read.format("grid_files").option("production", "true").load(str(tmp_path)).collect()
    (tmp_path / "x.nc").write_bytes((tmp_path / "x.nc").read_bytes()[:90])
    with pytest.raises(Exception, match="cut off"):
        spark.read.format("grid_files").load(str(tmp_path)).collect()


def test_the_whole_grid_in_slabs(spark, tmp_path):
    values = np.arange(GRID_ROWS * GRID_COLS, dtype="f4").reshape(1, GRID_ROWS, GRID_COLS)
    lat, lon = (14.01 + 0.02 * np.arange(GRID_ROWS)).astype("f4"), (-167.99 + 0.02 * np.arange(GRID_COLS)).astype("f4")
    whole = {"latitude": (("y",), lat, {}), "longitude": (("x",), lon, {}), "vertical_column_troposphere": (("time", "y", "x"), values, {}), "main_data_quality_flag": (("time", "y", "x"), (values.astype("i4") % 3).astype("i2"), {})}
    write_cdf(tmp_path / "full.nc", {"time": 1, "y": GRID_ROWS, "x": GRID_COLS}, small(**whole), 2)
    read = lambda schema: spark.read.format("grid_files").option("production", "true").schema(schema).load(str(tmp_path))
    df = read("grid_row int, quality_flag int")
    assert df.rdd.getNumPartitions() == 12
    got = df.groupBy("quality_flag").agg(F.count("*").alias("n")).collect()
    assert sorted(r.n for r in got) == sorted(np.bincount(np.arange(GRID_ROWS * GRID_COLS) % 3).tolist())
    source = spark.read.format("grid_files").option("prune", "true").schema("grid_row int, grid_col int, no2 double, latitude double")
    few = source.load(str(tmp_path)).where("grid_row >= 300 and grid_row < 302")
    assert few.rdd.getNumPartitions() == 1
    first = few.orderBy("grid_row", "grid_col").first()
    assert few.count() == 2 * GRID_COLS and first.no2 == float(values[0, 300, 0]) and first.latitude == pytest.approx(20.01, abs=1e-5)


def write_shapes(path, shapes, fields):
    """Polygons of rings as they stand, with a table of strings."""
    records, index, at = b"", b"", 50
    for k, rings in enumerate(shapes):
        points = [p for r in rings for p in r]
        starts = np.cumsum([0, *[len(r) for r in rings[:-1]]]) if rings else []
        content = struct.pack("<i", 5 if rings else 0)
        if rings:
            box = [f(p[i] for p in points) for f in (min, max) for i in (0, 1)]
            content += struct.pack("<4dii", *box, len(rings), len(points)) + b"".join(struct.pack("<i", s) for s in starts) + b"".join(struct.pack("<2d", *p) for p in points)
        index += struct.pack(">ii", at, len(content) // 2)
        records += struct.pack(">ii", k + 1, len(content) // 2) + content
        at += 4 + len(content) // 2
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + n) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    path.with_suffix(".shp").write_bytes(head(len(records)) + records)
    path.with_suffix(".shx").write_bytes(head(len(index)) + index)
    names, width = list(fields[0]), 12
    body = b"".join(b" " + b"".join(str(row[n]).encode().ljust(width) for n in names) for row in fields)
    described = b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width]) + b"\0" * 15 for n in names)
    path.with_suffix(".dbf").write_bytes(struct.pack("<4BiHH20x", 3, 26, 1, 1, len(fields), 33 + 32 * len(names), 1 + width * len(names)) + described + b"\r" + body + b"\x1a")


def circle(x, y, r, n, clockwise=True):
    ring = [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [*(ring[::-1] if clockwise else ring), (ring[::-1] if clockwise else ring)[0]]


def test_a_shapefile_in_several_partitions(spark, tmp_path):
    rnd = random.Random(0)
    shapes = [[circle(k, 0, 0.4, rnd.randint(3, 60)), circle(k, 0, 0.2, 9, False)] if k % 7 else [] if k % 2 else [circle(k, 1, 0.1, 5)] for k in range(120)]
    write_shapes(tmp_path / "a", shapes, [{"GEOID": f"{k:05d}", "NAME": f"Nañe {k}"} for k in range(120)])
    df = spark.read.format("boundaries").option("part_bytes", 4000).load(str(tmp_path / "a.shp"))
    assert df.rdd.getNumPartitions() > 10
    got = {(r.record, r.ring): r for r in df.collect()}
    want = {(k, n): ring for k, rings in enumerate(shapes) for n, ring in enumerate(rings)}
    assert {k: [(p.x, p.y) for p in r.points] for k, r in got.items()} == want
    assert all(r.hole == (r.ring == 1) and r.properties == {"GEOID": f"{r.record:05d}", "NAME": f"Nañe {r.record}"} for r in got.values())
    few = spark.read.format("boundaries").schema("record bigint, hole boolean").load(str(tmp_path)).groupBy("hole").count().collect()
    assert {r.hole: r["count"] for r in few} == {h: sum(r.hole == h for r in got.values()) for h in (True, False)}


def test_lines_are_split_anywhere(spark, tmp_path):
    features = []
    for k in range(60):
        outer, inner = circle(k, 0, 0.4, 5 + k % 9, False), circle(k, 0, 0.1, 4)
        shape = {"type": "Polygon", "coordinates": [outer, inner]} if k % 3 else {"type": "MultiPolygon", "coordinates": [[outer], [circle(k, 5, 0.2, 4, False), inner]]}
        features.append({"type": "Feature", "properties": {"tzid": f"Zone/{k}é", "n": k, "none": None}, "geometry": shape if k != 7 else None})
    text = "\n".join(json.dumps(f) for f in features)
    for end in ("", "\n", "\r\n\n"):
        (tmp_path / "z.geojsonl").write_text(text + end)
        for size in (97, 1000, 1 << 20):
            df = spark.read.format("boundaries").option("part_bytes", size).load(str(tmp_path / "z.geojsonl"))
            if size == 97 and end:
                continue
            rows = df.collect()
            assert len(rows) == sum(2 if k % 3 else 3 for k in range(60) if k != 7)
            assert {r.properties["tzid"] for r in rows} == {f"Zone/{k}é" for k in range(60) if k != 7} and all(r.properties.keys() == {"tzid", "n"} for r in rows)
            assert sum(r.hole for r in rows) == 59 and len({(r.record, r.ring) for r in rows}) == len(rows)
    assert df.rdd.getNumPartitions() == 1


def test_broken_boundaries_name_their_place(spark, tmp_path):
    (tmp_path / "b.geojsonl").write_text('{"type": "Feature", "geometry": {"type": "Point", "coordinates": [0, 0]}}\n')
    with pytest.raises(Exception, match="b.geojsonl: the feature at byte 0"):
        spark.read.format("boundaries").load(str(tmp_path)).collect()
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("boundaries").load(str(tmp_path / "nowhere")).collect()
