import math
import random

import pytest
from pyspark.sql import functions as F

from skyloom.operators import geography
from skyloom.operators import polygons as pg

A, INVERSE = 6378137.0, 298.257223563
E2 = (2 - 1 / INVERSE) / INVERSE
E1, K0 = math.sqrt(E2), math.cos(math.radians(30)) / math.sqrt(1 - E2 / 4)


def project(lon, lat):
    s = math.sin(math.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))
    return A * K0 * math.radians(lon), A * q / (2 * K0)


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def km2(ring):
    x0, y0 = project(*ring[0]) if ring else (0, 0)
    return abs(shoelace([(x - x0, y - y0) for x, y in (project(*p) for p in ring)])) / 1e6 if ring else 0.0


def clip(ring, west, south, step):
    """The ring cut to a cell, side by side."""
    for axis, value, sign in ((0, west, 1), (0, west + step, -1), (1, south, 1), (1, south + step, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            a, b = sign * (p[axis] - value) >= 0, sign * (q[axis] - value) >= 0
            if a:
                out.append(p)
            if a != b:
                t = (value - p[axis]) / (q[axis] - p[axis])
                cut = [p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])]
                cut[axis] = value
                out.append(tuple(cut))
        ring = out
        if not ring:
            break
    return ring


def star(rnd, x, y, radius, n):
    turn = [(2 * math.pi * k / n, radius * rnd.uniform(0.3, 1)) for k in range(n)]
    return [(round(x + r * math.cos(t), 4), round(y + r * math.sin(t), 4)) for t, r in turn]


def box(west, south, east, north):
    west, south, east, north = map(float, (west, south, east, north))
    return [(west, south), (east, south), (east, north), (west, north)]


def test_overlay_equals_clipping_cell_by_cell(spark):
    rnd, grid = random.Random(4), pg.Grid()
    shapes = {f"s{k}": [star(rnd, rnd.uniform(-100, -99), rnd.uniform(30, 31), rnd.choice([0.004, 0.05, 0.25]), rnd.choice([3, 5, 12, 40]))] for k in range(8)}
    shapes |= {"box": [box(-100.0, 30.0, -99.8, 30.1)], "corner": [box(-168.1, 13.9, -167.9, 14.1)], "east": [box(-13.05, 20.0, -12.9, 20.05)]}
    shapes["holed"] = [box(-90.005, 40.0, -89.8, 40.1), box(-89.97, 40.033, -89.9, 40.07)]
    got = {(r.canonical_region_id, r.grid_row, r.grid_col): r.overlap_weight for r in pg.grid_overlay(pg.edges_of(spark, shapes)).collect()}
    want = {}
    for key, rings in shapes.items():
        low, high = (f(y for _, y in rings[0]) for f in (min, max))
        left, right = (f(x for x, _ in rings[0]) for f in (min, max))
        for r in range(max(0, int((low - grid.south) / grid.step) - 1), min(grid.rows, int((high - grid.south) / grid.step) + 2)):
            for c in range(max(0, int((left - grid.west) / grid.step) - 1), min(grid.cols, int((right - grid.west) / grid.step) + 2)):
                parts = [km2(clip(ring, grid.west + c * grid.step, grid.south + r * grid.step, grid.step)) for ring in rings]
                if parts[0] - sum(parts[1:]) > 1e-6:
                    want[key, r, c] = parts[0] - sum(parts[1:])
    assert {k for k, v in got.items() if v > 1e-6} == set(want)
    assert max(abs(got[k] - v) for k, v in want.items()) < 1e-6


def test_cells_add_up_to_the_shape(spark):
    rnd = random.Random(9)
    wide = {"US": [star(rnd, -100, 40, 8, 300), [(-100.2, 40), (-100, 39.7), (-99.8, 40), (-100, 40.3)]], "thin": [box(-120, 30.0001, -80, 30.0003)]}
    edges = pg.edges_of(spark, wide)
    cells = pg.grid_overlay(edges).groupBy("canonical_region_id").agg(F.sum("overlap_weight").alias("sum"), F.count("*").alias("n"))
    rows = cells.join(pg.areas(edges, pg.Grid()), "canonical_region_id").collect()
    assert len(rows) == 2 and all(r["sum"] == pytest.approx(r.area_km2, rel=1e-9) for r in rows)
    assert {r.canonical_region_id: r.n for r in rows}["US"] > 100_000
    sphere = pg.areas(pg.edges_of(spark, {"w": [box(-180, -90, 179.999999, 90)]})).first().area_km2
    assert sphere == pytest.approx(510_065_621.7, rel=1e-6)


def test_rings_of_any_direction_open_closed_or_broken(spark):
    ring = box(0, 0, 2, 1)
    rows = [("a", 0, False, ring), ("b", 0, False, ring[::-1]), ("c", 0, False, [*ring, ring[0]]), ("d", 0, None, [ring[0], *ring]), ("e", 0, False, ring[:2]), ("f", 0, False, [*ring, None])]
    rows += [("g", 0, False, None), ("h", 0, True, ring), ("i", 0, False, [(0.0, float("nan")), *ring])]
    df = spark.createDataFrame(rows, "id string, ring int, hole boolean, points array<struct<x:double,y:double>>")
    got = {r.id: r.area_km2 for r in pg.areas(pg.ring_edges(df), key="id").collect()}
    assert got.keys() == set("abcdh") and all(got[k] == pytest.approx(km2(ring), rel=1e-9) for k in "abcd") and got["h"] == -got["a"]
    assert pg.grid_overlay(pg.ring_edges(df.limit(0)), key="id").collect() == []


def meet(p, q):
    """Whether two simple polygons share a point."""
    cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    sides = lambda r: list(zip(r, r[1:] + r[:1], strict=True))
    for a, b in sides(p):
        for c, d in sides(q):
            near = all(max(a[k], b[k]) >= min(c[k], d[k]) and max(c[k], d[k]) >= min(a[k], b[k]) for k in (0, 1))
            if near and cross(a, b, c) * cross(a, b, d) <= 0 and cross(c, d, a) * cross(c, d, b) <= 0:
                return True
    inside = lambda pt, r: sum((a[1] <= pt[1]) != (b[1] <= pt[1]) and a[0] + (pt[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) > pt[0] for a, b in sides(r)) % 2
    return bool(inside(p[0], q) or inside(q[0], p))


def test_intersecting_equals_brute_force(spark):
    rnd = random.Random(11)
    some = lambda n: {f"s{k}": [star(rnd, rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.choice([0.05, 0.5, 3, 9]), rnd.choice([3, 7, 30]))] for k in range(n)}
    left, right = some(40), some(40)
    left |= {"box": [box(0, 0, 1, 1)], "far": [box(100, 50, 101, 51)], "whole": [box(-170, -80, 170, 80)], "speck": [box(0.01, 0.01, 0.02, 0.02)]}
    right |= {"side": [box(1, 0.25, 2, 0.5)], "point": [box(-1, -1, 0, 0)], "apart": [box(1.0001, 1.0001, 3, 3)], "in": [box(0.1, 0.1, 0.2, 0.2)]}
    a, b = (pg.edges_of(spark, s, k) for s, k in ((left, "a"), (right, "b")))
    got = [tuple(r) for r in pg.intersecting(a, b, hot=2).select("a", "b").collect()]
    want = {(x, y) for x, p in left.items() for y, q in right.items() if meet(p[0], q[0])}
    assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < 44 * 44
    assert {("box", "side"), ("box", "point"), ("box", "in")} <= want and ("box", "apart") not in want


def test_a_hole_is_outside_and_no_join_is_a_product(spark):
    a = pg.edges_of(spark, {"holed": [box(0, 0, 9, 9), box(3, 3, 6, 6)], "solid": [box(0, 0, 9, 9)]}, "a")
    b = pg.edges_of(spark, {"within": [box(4, 4, 5, 5)], "rim": [box(1, 1, 2, 2)], "speck": [box(4.41, 4.41, 4.42, 4.42)]}, "b")
    found = pg.intersecting(a, b)
    got = {tuple(r) for r in found.collect()}
    assert got == {("holed", "rim"), ("solid", "rim"), ("solid", "within"), ("solid", "speck")}
    plan = found._jdf.queryExecution()
    assert "Cross" not in plan.optimizedPlan().toString() and "NestedLoop" not in plan.executedPlan().toString()


def test_intersection_areas_and_dominant_zone(spark):
    rnd = random.Random(5)
    regions = {f"r{k}": [star(rnd, -100 + k, 35, 0.7, 25)] for k in range(5)}
    zones = {f"z{k}": [box(-101.3 + k, 33, -100.3 + k, 37)] for k in range(7)}
    a, b = pg.edges_of(spark, regions, "a"), pg.edges_of(spark, zones, "b")
    pairs = pg.intersecting(a, b)
    found = pg.intersection_areas(a, b, pairs)
    got = {(r.a, r.b): r.area_km2 for r in found.collect()}
    for (x, y), area in got.items():
        west = zones[y][0][0][0]
        ring = regions[x][0]
        for axis_cut in ((west, 1), (west + 1, -1)):
            ring = [p for p in clip(ring, axis_cut[0] if axis_cut[1] > 0 else axis_cut[0] - 60, 0, 60)]
        assert area == pytest.approx(km2(ring), rel=1e-3)  # their edges bend between rows, but for less than this
    whole = {r.a: r.area_km2 for r in pg.areas(a, key="a").collect()}
    for x, area in whole.items():
        assert sum(v for (r, _), v in got.items() if r == x) == pytest.approx(area, rel=1e-4)
    top = {r.a: r.b for r in geography.dominant(found, "a", "b", "area_km2").collect()}
    assert top == {x: max((v, z) for (r, z), v in got.items() if r == x)[1] for x in regions}


def squares(cells):
    return [(k, n, False, box(x, y, x + 1, y + 1)) for k, places in cells.items() for n, (x, y) in enumerate(places)]


def frame(spark, rows):
    return pg.ring_edges(spark.createDataFrame(rows, "id string, ring int, hole boolean, points array<struct<x:double,y:double>>"))


def test_dissolve_and_rings_equal_brute_force(spark):
    rnd = random.Random(2)
    cells = {k: sorted({(rnd.randrange(12), rnd.randrange(12)) for _ in range(70)}) for k in "pqr"}
    cells["ring"] = [(x, y) for x in range(5) for y in range(5) if (x, y) != (2, 2)]
    cells["touch"] = [(0, 0), (1, 1)]
    edges = pg.dissolve(frame(spark, squares(cells)), "id")
    got = pg.rings(edges, "id").collect()
    assert all(r.closed for r in got)
    for key, places in cells.items():
        sides = [s for x, y in places for s in (((x, y), (x + 1, y)), ((x + 1, y), (x + 1, y + 1)), ((x + 1, y + 1), (x, y + 1)), ((x, y + 1), (x, y)))]
        outer = {s for s in sides if s[::-1] not in sides}
        mine = [[(p.x, p.y) for p in r.points] for r in got if r.id == key]
        assert {s for ring in mine for s in zip(ring, ring[1:] + ring[:1], strict=True)} == outer
        assert sum(map(shoelace, mine)) == len(places) and sum(map(len, mine)) == len(outer)
        # As many outer rings as groups of squares that share a side.
        todo, groups = set(places), 0
        while todo:
            groups, front = groups + 1, [todo.pop()]
            while front:
                x, y = front.pop()
                near = {(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)} & todo
                todo -= near
                front += near
        assert sum(not r.hole for r in got if r.id == key) == groups
    assert [(r.hole, len(r.points)) for r in sorted((r for r in got if r.id == "ring"), key=lambda r: r.hole)] == [(False, 20), (True, 4)]
    assert [len(r.points) for r in got if r.id == "touch"] == [4, 4]


def test_dissolve_cuts_edges_at_vertices_and_removes_spikes(spark):
    rows = [("t", 0, False, box(0, 0, 4, 1)), ("t", 1, False, box(0, 1, 2, 2)), ("t", 2, False, box(2, 1, 4, 2))]
    rows += [("s", 0, False, [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (3.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])]
    got = {r.id: {(p.x, p.y) for p in r.points} for r in pg.rings(pg.dissolve(frame(spark, rows), "id"), "id").collect()}
    assert got["t"] == {(0, 0), (4, 0), (4, 1), (4, 2), (2, 2), (0, 2), (0, 1)} and got["s"] == set(box(0, 0, 1, 1))
    area = {r.id: r.area_km2 for r in pg.areas(pg.dissolve(frame(spark, rows), "id"), key="id").collect()}
    assert area["t"] == pytest.approx(km2(box(0, 0, 4, 2)), rel=1e-6)
    assert pg.rings(pg.dissolve(frame(spark, rows).limit(0), "id"), "id").collect() == []


def test_rings_report_open_chains(spark):
    edges = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 0.0), ("a", 1.0, 0.0, 1.0, 1.0)], "id string, x1 double, y1 double, x2 double, y2 double")
    assert {r.closed for r in pg.rings(edges, "id").collect()} == {False}


def test_equal_shapes_are_compared_once(spark):
    square = lambda x, y, d: [[(x - d, y - d), (x + d, y - d), (x + d, y + d), (x - d, y + d)]]
    a = pg.edges_of(spark, {f"a{k}": square(10.0 + 5 * (k % 2), 50.0, 1.0) for k in range(6)}, "a")
    b = pg.edges_of(spark, {f"b{k}": square(10.9, 50.2, 0.5 + 0.1 * (k % 3)) for k in range(9)}, "b")
    assert pg._classes(a, "a")[0].select("a").distinct().count() == 2 and pg._classes(b, "b")[0].select("b").distinct().count() == 3
    pairs = pg.intersecting(a, b)
    assert sorted(map(tuple, pairs.collect())) == sorted((f"a{i}", f"b{j}") for i in (0, 2, 4) for j in range(9))
    some = pairs.where("not (a = 'a0' and b = 'b0') and b <> 'b1'")
    found = {(r.a, r.b): round(r.area_km2, 6) for r in pg.intersection_areas(a, b, some).collect()}
    assert set(found) == {tuple(r) for r in some.collect()}
    assert len({v for (_, j), v in found.items() if int(j[1]) % 3 == 2}) == 1 and len(set(found.values())) == 3


def test_pieces_of_a_large_shape_are_dealt_to_parts(spark):
    a = spark.createDataFrame([("s", k % 2, k) for k in range(100)], "a string, grid_row int, x int")
    b = spark.createDataFrame([(f"d{k}", k % 2, k) for k in range(4)], "b string, grid_row int, y int")
    pairs = spark.createDataFrame([("s", "d0"), ("s", "d1"), ("s", "d2")], "a string, b string")
    got = pg._met(pairs, a, b, "grid_row", part=8)
    assert sorted((r.b, r.x, r.y) for r in got.collect()) == sorted((f"d{k}", x, k) for k in range(3) for x in range(100) if x % 2 == k % 2)
    assert sorted((r.b, r.x) for r in pg._met(pairs, a.limit(1), b, "grid_row", part=8).collect()) == [("d0", 0), ("d2", 0)]
