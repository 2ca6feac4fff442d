"""Polygons as tables of directed edges: areas on a grid, intersections, and unions by key.

An edge (id, ring, x1, y1, x2, y2) in degrees has the inside on its left, so outer rings run
counter-clockwise and holes clockwise.  No operator puts a shape together in one task: edges are cut at
the rows of a grid and summed up, and what lies east of an edge's crossing follows from running sums
along a row.  Areas are planar in an equal-area projection, in square kilometres.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.functions.exprs import GRID_COLS, GRID_LAT0, GRID_LON0, GRID_ROWS, GRID_STEP, equal_area_x, equal_area_y
from skyloom.operators.steps import settled

EDGE = ["x1", "y1", "x2", "y2"]
NANOMETRES = float(2**30)  # heights are whole numbers of about a nanometre, so that sums of them cancel out exactly
LEAST_SHARE = 1e-9  # smaller shares of a cell are slivers of rounding


@dataclass(frozen=True)
class Grid:
    """Cells of ``step`` degrees from the south-western corner on; row and column count up from 0."""

    west: float = GRID_LON0 - GRID_STEP / 2
    south: float = GRID_LAT0 - GRID_STEP / 2
    step: float = GRID_STEP
    rows: int = GRID_ROWS
    cols: int = GRID_COLS

    def line(self, k: Column, origin: float) -> Column:
        return F.lit(origin) + k * F.lit(self.step)

    def index(self, at: Column, origin: float) -> Column:
        """The cell that holds a position, by the same lines that cut the edges."""
        k = F.floor((at - F.lit(origin)) / F.lit(self.step))
        return (k - F.when(at < self.line(k, origin), 1).otherwise(0) + F.when(at >= self.line(k + 1, origin), 1).otherwise(0)).cast("int")


WORLD = Grid(-180.0, -90.0, 0.25, 720, 1440)


def ring_edges(rings: DataFrame, key: str = "id") -> DataFrame:
    """Edges (key, ring, x1, y1, x2, y2) of rings (key, ring, hole, points array<struct<x, y>>).

    Rings are closed where they are open, repeated points are left out, and the direction is set
    by ``hole`` whatever it was.  Rings with a null point or fewer than three different points give nothing.
    """
    named = F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    last = lambda a: F.element_at(a, -1)
    closed = F.when(F.element_at("p", 1) == last(F.col("p")), F.col("p")).otherwise(F.concat("p", F.slice("p", 1, 1)))
    usable = "size(points) >= 3 and not exists(points, q -> q is null or isnan(q.x) or isnan(q.y) or q.x is null or q.y is null)"
    r = rings.where(usable).select(key, "ring", "hole", named.alias("p")).withColumn("p", closed)
    pairs = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    r = r.select(key, "ring", "hole", pairs.alias("e")).withColumn("e", F.filter("e", lambda s: (s["x1"] != s["x2"]) | (s["y1"] != s["y2"])))
    r = r.where(F.size("e") >= 3)
    # Twice the area, from the first point so that small rings keep their digits.
    x0, y0 = F.col("e")[0]["x1"], F.col("e")[0]["y1"]
    twice = F.aggregate("e", F.lit(0.0), lambda t, s: t + (s["x1"] - x0) * (s["y2"] - y0) - (s["x2"] - x0) * (s["y1"] - y0))
    turn = (F.col("twice") > 0) == F.coalesce("hole", F.lit(False))
    e = r.withColumn("twice", twice).select(key, "ring", turn.alias("turn"), F.explode("e").alias("e"))
    end = lambda a, b: F.when(F.col("turn"), F.col(f"e.{b}")).otherwise(F.col(f"e.{a}"))
    return e.select(key, "ring", end("x1", "x2").alias("x1"), end("y1", "y2").alias("y1"), end("x2", "x1").alias("x2"), end("y2", "y1").alias("y2"))


def _spread(rows: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
    """A row for each number from first to last, none where these are out of order.

    The test stands within the generator: as a filter Catalyst would push it down with all that ``first`` and ``last`` are made of.
    """
    span = rows.withColumns({"_first": first.cast("int"), "_last": last.cast("int")})
    return span.withColumn(name, F.explode_outer(F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last")))).where(F.col(name).isNotNull()).drop("_first", "_last")


def row_pieces(edges: DataFrame, grid: Grid, level: bool = False) -> DataFrame:
    """The edges cut at the rows: grid_row, low, high (latitudes), x_low, x_high (longitudes there), sign (1: northwards).

    Horizontal edges have no height and are left out, or with ``level`` stay in their row.
    """
    e = edges.where(F.lit(True) if level else F.col("y1") != F.col("y2"))
    e = e.withColumns({"sign": F.when(F.col("y2") > F.col("y1"), 1).otherwise(-1), "_s": F.least("y1", "y2"), "_n": F.greatest("y1", "y2")})
    first, last = grid.index(F.col("_s"), grid.south), grid.index(F.col("_n"), grid.south)
    e = _spread(e, "grid_row", F.greatest(first, F.lit(0)), F.least(last, F.lit(grid.rows - 1)))
    e = e.withColumn("low", F.greatest("_s", grid.line(F.col("grid_row"), grid.south))).withColumn("high", F.least("_n", grid.line(F.col("grid_row") + 1, grid.south)))
    # The ends of an edge keep their longitudes; at a row's line both sides compute the same one.
    at = lambda c: F.when(F.col(c) == F.col("y1"), F.col("x1")).when(F.col(c) == F.col("y2"), F.col("x2")).otherwise(
        F.col("x1") + (F.col(c) - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    )
    flat = F.col("y1") == F.col("y2")
    e = e.withColumns({"x_low": F.when(flat, F.col("x1")).otherwise(at("low")), "x_high": F.when(flat, F.col("x2")).otherwise(at("high"))})
    return e.where("high >= low" if level else "high > low").drop("_s", "_n")


def _height(latitude: Column) -> Column:
    return F.round(equal_area_y(latitude) * NANOMETRES).cast("long")


def _cell_pieces(edges: DataFrame, grid: Grid) -> DataFrame:
    """The edges cut at rows and columns: grid_row, grid_col, middle (m) and rise (nm, signed); those east of the grid stand in one column after the last."""
    p = row_pieces(edges, grid).withColumns({"_w": F.least("x_low", "x_high"), "_e": F.greatest("x_low", "x_high")})
    first, last = (F.least(grid.index(F.col(c), grid.west), F.lit(grid.cols)) for c in ("_w", "_e"))
    p = _spread(p, "grid_col", F.greatest(first, F.lit(0)), last)
    west = F.greatest("_w", grid.line(F.col("grid_col"), grid.west))
    east = F.when(F.col("grid_col") == grid.cols, F.col("_e")).otherwise(F.least("_e", grid.line(F.col("grid_col") + 1, grid.west)))
    p = p.withColumns({"_a": west, "_b": F.greatest(west, east)})
    at = lambda c: F.when(F.col(c) == F.col("x_low"), F.col("low")).when(F.col(c) == F.col("x_high"), F.col("high")).otherwise(
        F.least(F.greatest(F.col("low") + (F.col(c) - F.col("x_low")) * (F.col("high") - F.col("low")) / (F.col("x_high") - F.col("x_low")), F.col("low")), F.col("high"))
    )
    upright = F.col("x_low") == F.col("x_high")
    from_, to = F.when(upright, F.col("low")).otherwise(at("_a")), F.when(upright, F.col("high")).otherwise(at("_b"))
    p = p.withColumn("rise", F.abs(_height(to) - _height(from_)) * F.col("sign"))
    return p.withColumn("middle", (equal_area_x(F.col("_a")) + equal_area_x(F.col("_b"))) / 2)


def _crossings(edges: DataFrame, grid: Grid, key: str) -> DataFrame:
    """key, grid_row, grid_col, part (m2), rise (nm): what the edges in a cell add up to.

    ``part`` is the signed area between the cell's western side and its edges, ``rise`` their signed height, which counts
    for every cell further west.
    """
    part = (F.col("middle") - equal_area_x(grid.line(F.col("grid_col"), grid.west))) * F.col("rise") / NANOMETRES
    sums = F.sum("part").alias("part"), F.sum("rise").alias("rise")
    return _cell_pieces(edges, grid).withColumn("part", part).groupBy(key, "grid_row", "grid_col").agg(*sums)


def _gaps(edges: DataFrame, grid: Grid, key: str) -> tuple[DataFrame, DataFrame]:
    """The crossings with the height east of them, and the cells inside without edges with theirs."""
    row = Window.partitionBy(key, "grid_row").orderBy(F.desc("grid_col"))
    c = _crossings(edges, grid, key).withColumn("east", F.coalesce(F.sum("rise").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    behind = F.col("rise") + F.col("east")
    c = c.withColumn("next", F.coalesce(F.lead("grid_col").over(row), F.when(behind != 0, F.lit(-1)).otherwise(F.col("grid_col") - 1)))
    open_ = c.where((F.col("next") < F.col("grid_col") - 1) & (behind != 0))
    return c, open_.select(key, "grid_row", F.explode(F.sequence(F.col("next") + 1, F.col("grid_col") - 1)).alias("grid_col"), behind.alias("rise"))


def grid_overlay(edges: DataFrame, grid: Grid | None = None, key: str = "canonical_region_id", least: float = LEAST_SHARE) -> DataFrame:
    """grid_row, grid_col, key, overlap_weight (km2): the area of every cell of the grid that each shape covers.

    Cells with edges get the area between these and the cell's western side, and the full width under what lies further
    east.  Between them stand cells without edges, which are inside or outside as a whole.  Work is shared out by row of a
    shape, so a continent is thousands of small groups, none wider than the grid.  Shares of a cell below ``least`` are left out.
    """
    grid = grid or Grid()
    c, gaps = _gaps(edges, grid, key)
    x = lambda k: equal_area_x(grid.line(k, grid.west))
    width = lambda k: x(k + 1) - x(k)
    own = c.select(key, "grid_row", "grid_col", (F.col("part") + F.col("east") / NANOMETRES * width(F.col("grid_col"))).alias("m2"))
    gaps = gaps.select(key, "grid_row", "grid_col", (F.col("rise") / NANOMETRES * width(F.col("grid_col"))).alias("m2"))
    whole = width(F.col("grid_col")) * (equal_area_y(grid.line(F.col("grid_row") + 1, grid.south)) - equal_area_y(grid.line(F.col("grid_row"), grid.south)))
    cells = own.unionByName(gaps).where((F.col("grid_col") < grid.cols) & (F.col("m2") > whole * least))
    return cells.select("grid_row", F.col("grid_col").cast("int").alias("grid_col"), key, (F.col("m2") / 1e6).alias("overlap_weight"))


def areas(edges: DataFrame, grid: Grid = WORLD, key: str = "canonical_region_id") -> DataFrame:
    """key, area_km2 of what lies within the grid's rows and west of its last column, with edges straight between the grid's lines."""
    return _cell_pieces(edges, grid).groupBy(key).agg((F.sum(F.col("middle") * F.col("rise") / NANOMETRES) / 1e6).alias("area_km2"))


# --- which shapes meet, and how much of one lies in the other --------------------------------

COARSE = 8  # cells of a coarse cell's side
HOT_CELL = 512  # shapes of one side that meet a part of a cell's others
TOUCH = 1e-9


def _edge_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """Every edge in each cell that it touches, its borders included."""
    p = row_pieces(edges, grid, level=True)
    side = lambda c: F.least(F.greatest(grid.index(c, grid.west), F.lit(0)), F.lit(grid.cols - 1))
    p = _spread(p, "grid_col", side(F.least("x_low", "x_high") - TOUCH), side(F.greatest("x_low", "x_high") + TOUCH))
    return p.drop("low", "high", "x_low", "x_high", "sign")


def cover(edges: DataFrame, key: str, grid: Grid = WORLD, coarse: int = COARSE) -> DataFrame:
    """key, top (coarse cell), cell (fine cell or null), full: cells of two levels that hold the shape.

    A cell without edges is full; where all fine cells of a coarse one are full that one stands for them.
    """
    met = _edge_cells(edges, grid).select(key, "grid_row", "grid_col", F.lit(False).alias("full")).distinct()
    cells = met.unionByName(_gaps(edges, grid, key)[1].select(key, "grid_row", F.col("grid_col").cast("int").alias("grid_col"), F.lit(True).alias("full")))
    tops = F.expr(f"(grid_row div {coarse}) * {grid.cols // coarse + 1} + grid_col div {coarse}").alias("top")
    cells = cells.groupBy(key, "grid_row", "grid_col").agg(F.bool_and("full").alias("full")).select(key, tops, (F.col("grid_row") * grid.cols + F.col("grid_col")).alias("cell"), "full")
    whole = cells.where("full").groupBy(key, "top").agg(F.count("*").alias("n")).where(F.col("n") == coarse**2).select(key, "top")
    return cells.join(whole, [key, "top"], "left_anti").unionByName(whole.select(key, "top", F.lit(None).cast("int").alias("cell"), F.lit(True).alias("full")))


def _classes(edges: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The edges of one shape (the one with the least key) of each set of equal ones, and (key, _as): which shape stands for which.

    Shapes are told apart by the number of their edges and 128 bits of hashes, summed up, so none is put together.
    """
    own = [c for c in ("ring", *EDGE) if c in edges.columns]
    e = F.xxhash64(F.lit(1), *own).cast("decimal(20,0)"), F.xxhash64(F.lit(2), *own)
    signs = settled(edges.groupBy(key).agg(F.count("*").alias("_n"), F.sum(e[0]).alias("_sum"), F.bit_xor(e[1]).alias("_xor")))
    same = ["_n", "_sum", "_xor"]
    stands = settled(signs.join(signs.groupBy(*same).agg(F.min(key).alias("_as")), same).select(key, "_as"))
    return edges.join(stands.where(F.col(key) == F.col("_as")).select(key), key, "left_semi"), stands


def _expanded(found: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """What was found for shapes that stand for others, for all of these; ``a`` and ``b`` are (key, _as)."""
    of = lambda c, key: c.select(F.col(key).alias(f"_{key}"), F.col("_as").alias(key))
    rest = [c for c in found.columns if c not in ("a", "b")]
    return found.join(of(a, "a"), "a").join(of(b, "b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"), *rest)


def _met(pairs: DataFrame, a: DataFrame, b: DataFrame, on: str, part: int = 4096) -> DataFrame:
    """Rows of a and b that a pair (a, b, and ``on`` where pairs have it) brings together in equal ``on``.

    The smaller side meets the pairs first.  The larger one is dealt to parts of some ``part`` rows where it has many in one
    place, and the pairs go to every part: rows of a large shape never stand in one task, and only the last join multiplies.
    """
    keys, sides = ["a", "b"], {"a": a, "b": b}
    if a.count() < b.count():
        keys.reverse()
    large, small = keys
    first = pairs.join(sides[small], [small, *({on} & {*pairs.columns})])
    places = sides[large].groupBy(large, on).agg(F.ceil(F.count("*") / part).cast("int").alias("_parts"))
    first = first.join(places, [large, on]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    many = sides[large].join(places, [large, on]).withColumn("_part", F.pmod(F.xxhash64(*sides[large].columns), F.col("_parts")).cast("int")).drop("_parts")
    tasks = 4 * sides[large].sparkSession.sparkContext.defaultParallelism  # as a number, so that parts that are small before they meet stay apart
    on_part = [large, on, "_part"]
    return first.repartition(tasks, *on_part).join(many.repartition(tasks, *on_part), on_part).drop("_part")


def _dealt(a: DataFrame, b: DataFrame, on: str, b_key: str, hot: int) -> DataFrame:
    """a and b joined on a cell; where many of b stand in one cell they are dealt to parts, and each of a goes to every part."""
    sizes = b.groupBy(on).agg(F.ceil(F.count("*") / hot).cast("int").alias("parts"))
    left = a.join(sizes, on).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = b.join(sizes, on).withColumn("part", F.pmod(F.xxhash64(b_key), F.col("parts")).cast("int")).drop("parts")
    return left.join(right, [on, "part"]).drop("part")


def _cross(px: str, py: str, qx: str, qy: str, x: str, y: str) -> Column:
    """Positive where (x, y) is left of the line from p to q."""
    c = F.col
    return F.signum((c(qx) - c(px)) * (c(y) - c(py)) - (c(qy) - c(py)) * (c(x) - c(px)))


def segments_meet() -> Column:
    """Whether the segments (x1, y1, x2, y2) and (u1, v1, u2, v2) share a point, their ends included."""
    apart = lambda p, q, r, s: (F.greatest(p, q) < F.least(r, s)) | (F.greatest(r, s) < F.least(p, q))
    near = ~apart("x1", "x2", "u1", "u2") & ~apart("y1", "y2", "v1", "v2")
    across = _cross("u1", "v1", "u2", "v2", "x1", "y1") * _cross("u1", "v1", "u2", "v2", "x2", "y2") <= 0
    back = _cross("x1", "y1", "x2", "y2", "u1", "v1") * _cross("x1", "y1", "x2", "y2", "u2", "v2") <= 0
    return near & across & back


def _ring_inside(pairs: DataFrame, inner: DataFrame, outer: DataFrame, inner_key: str, outer_key: str, grid: Grid) -> DataFrame:
    """The pairs where a point of one of inner's rings lies in outer."""
    point = inner.groupBy(inner_key, "ring").agg(F.min(F.struct("x1", "y1")).alias("p"))
    point = pairs.select(inner_key).distinct().join(point, inner_key).select(inner_key, "ring", F.col("p.x1").alias("px"), F.col("p.y1").alias("py"))
    at = F.least(F.greatest(grid.index(F.col("py"), grid.south), F.lit(0)), F.lit(grid.rows - 1))
    point = point.withColumn("grid_row", at)
    pieces = settled(row_pieces(outer, grid).drop("ring", *EDGE))
    points = settled(point)
    met = _met(pairs, *((points, pieces) if inner_key == "a" else (pieces, points)), "grid_row")
    x = F.col("x_low") + (F.col("py") - F.col("low")) * (F.col("x_high") - F.col("x_low")) / (F.col("high") - F.col("low"))
    met = met.where((F.col("low") <= F.col("py")) & (F.col("py") < F.col("high")) & (x > F.col("px")))
    return met.groupBy(inner_key, outer_key, "ring").agg(F.sum("sign").alias("turns")).where("turns <> 0").select("a", "b")


def intersecting(a: DataFrame, b: DataFrame, grid: Grid = WORLD, coarse: int = COARSE, hot: int = HOT_CELL) -> DataFrame:
    """Pairs (a, b) of shapes that share a point; ``a`` and ``b`` are edges with the keys a and b, ring, x1, y1, x2, y2.

    Cells of two levels are the join key.  Where one shape fills a cell that holds the other they meet; of shapes that
    only share cells of their borders the edges in those cells are compared; and where none cross, one point of each ring
    tells whether it lies within the other shape.  There is no product, and cells with many shapes are dealt to parts.
    Equal shapes are compared once.
    """
    (a, as_a), (b, as_b) = _classes(settled(a), "a"), _classes(settled(b), "b")
    a, b = settled(a), settled(b)
    ca, cb = settled(cover(a, "a", grid, coarse)), settled(cover(b, "b", grid, coarse))
    tops = lambda c, key: c.select(key, "top").distinct()
    wide = [_dealt(ca.where("cell is null").select("a", "top"), tops(cb, "b"), "top", "b", hot), _dealt(tops(ca, "a"), cb.where("cell is null").select("b", "top"), "top", "b", hot)]
    fine = lambda c, key, name: c.where("cell is not null").select(key, "cell", F.col("full").alias(name))
    met = settled(_dealt(fine(ca, "a", "fa"), fine(cb, "b", "fb"), "cell", "b", hot).select("a", "b", "cell", (F.col("fa") | F.col("fb")).alias("sure")))
    sure = met.where("sure").select("a", "b").unionByName(wide[0].select("a", "b")).unionByName(wide[1].select("a", "b")).distinct()
    sure = settled(sure)
    open_ = settled(met.where("not sure").join(sure, ["a", "b"], "left_anti").select("a", "b", "cell"))
    cell = (F.col("grid_row") * grid.cols + F.col("grid_col")).alias("cell")
    ea = settled(_edge_cells(a, grid).select("a", cell, *EDGE))
    eb = settled(_edge_cells(b, grid).select("b", cell, *[F.col(c).alias(n) for c, n in zip(EDGE, ("u1", "v1", "u2", "v2"), strict=True)]))
    crossed = settled(_met(open_, ea, eb, "cell").where(segments_meet()).select("a", "b").distinct())
    left = settled(open_.select("a", "b").distinct().join(crossed, ["a", "b"], "left_anti"))
    within = _ring_inside(left, a, b, "a", "b", grid).unionByName(_ring_inside(left, b, a, "b", "a", grid))
    return _expanded(settled(sure.unionByName(crossed).unionByName(within.distinct())), as_a, as_b)


def intersection_areas(a: DataFrame, b: DataFrame, pairs: DataFrame, grid: Grid = WORLD) -> DataFrame:
    """a, b, area_km2 of what both shapes of each pair hold; pairs without a common area have no row.

    A shape is what lies west of its northward edges less what lies west of its southward ones.  So the common area is a sum
    over two edges, one of each shape, of the area west of both: pieces of the same row meet, and the smaller longitude counts.
    """
    (a, as_a), (b, as_b) = _classes(settled(a), "a"), _classes(settled(b), "b")
    ends = {"y_low": equal_area_y(F.col("low")), "y_high": equal_area_y(F.col("high"))}
    names = ("low", "high", "x_low", "x_high", "y_low", "y_high", "sign")
    pa = settled(row_pieces(a, grid).withColumns(ends).select("a", "grid_row", *names))
    pb = settled(row_pieces(b, grid).withColumns(ends).select("b", "grid_row", *[F.col(c).alias(f"_{c}") for c in names]))
    of = lambda c, key: c.select(key, F.col("_as").alias(f"_{key}"))
    pairs = pairs.select("a", "b").join(of(as_a, "a"), "a").join(of(as_b, "b"), "b")
    # pairs may name some of the equal shapes only
    once = settled(pairs.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    p = _met(once, pa, pb, "grid_row").withColumns({"s": F.greatest("low", "_low"), "n": F.least("high", "_high")}).where("n > s")
    x = lambda at, m: equal_area_x(F.col(f"{m}x_low") + (F.col(at) - F.col(f"{m}low")) * (F.col(f"{m}x_high") - F.col(f"{m}x_low")) / (F.col(f"{m}high") - F.col(f"{m}low")))
    p = p.withColumns({"xs": x("s", ""), "xn": x("n", ""), "us": x("s", "_"), "un": x("n", "_"), "h": F.least("y_high", "_y_high") - F.greatest("y_low", "_y_low")})
    ds, dn = F.col("xs") - F.col("us"), F.col("xn") - F.col("un")
    t = F.when(ds * dn < 0, ds / (ds - dn)).otherwise(F.lit(0.0))
    middle = F.col("xs") + t * (F.col("xn") - F.col("xs"))
    low, high = F.least("xs", "us"), F.least("xn", "un")
    west = F.when(ds * dn < 0, (low + middle) / 2 * t + (middle + high) / 2 * (1 - t)).otherwise((low + high) / 2)
    out = p.groupBy("a", "b").agg((F.sum(west * F.col("h") * F.col("sign") * F.col("_sign")) / 1e6).alias("area_km2"))
    out = out.where(F.col("area_km2") > LEAST_SHARE).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "area_km2")
    return pairs.join(out, ["_a", "_b"]).select("a", "b", "area_km2")


# --- unions by key ----------------------------------------------------------------------------


def noded(edges: DataFrame, key: str, grid: Grid = WORLD) -> DataFrame:
    """Edges (key, x1, y1, x2, y2) cut at the vertices of the same key that lie on them.

    Vertex and edge meet by the cell that both touch; a vertex counts if it is exactly on the line.
    """
    e = settled(edges.select(key, *EDGE).withColumn("_id", F.monotonically_increasing_id()))
    point = e.select(key, F.col("x1").alias("px"), F.col("y1").alias("py")).union(e.select(key, "x2", "y2")).distinct()
    at = lambda c, origin, n: F.least(F.greatest(grid.index(F.col(c), origin), F.lit(0)), F.lit(n - 1))
    point = point.withColumns({"grid_row": at("py", grid.south, grid.rows), "grid_col": at("px", grid.west, grid.cols)})
    met = _edge_cells(e, grid).join(point, [key, "grid_row", "grid_col"])
    between = "px between least(x1, x2) and greatest(x1, x2) and py between least(y1, y2) and greatest(y1, y2)"
    met = met.where(between).where((_cross("x1", "y1", "x2", "y2", "px", "py") == 0) & ~F.expr("px = x1 and py = y1 or px = x2 and py = y2"))
    far = F.abs(F.col("px") - F.col("x1")) + F.abs(F.col("py") - F.col("y1"))
    cuts = met.groupBy("_id").agg(F.sort_array(F.collect_set(F.struct(far.alias("d"), F.col("px").alias("x"), F.col("py").alias("y")))).alias("cuts"))
    e = e.join(cuts, "_id", "left")
    way = F.concat(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))), F.transform(F.coalesce("cuts", F.array()), lambda c: F.struct(c["x"], c["y"])), F.array(F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    steps = e.select(key, way.alias("w")).select(key, F.explode(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))).alias("s"))
    return steps.select(key, F.col("s.p.x").alias("x1"), F.col("s.p.y").alias("y1"), F.col("s.q.x").alias("x2"), F.col("s.q.y").alias("y2"))


def dissolve(edges: DataFrame, key: str, grid: Grid = WORLD) -> DataFrame:
    """Edges (key, x1, y1, x2, y2) of the union of a key's parts, which may touch but not overlap.

    Borders of two parts run both ways and cancel out, after each was cut at the other's vertices; so do spikes, and edges
    without a length are left out.  What is left runs around the union, with the inside on its left.
    """
    e = noded(edges.where("x1 <> x2 or y1 <> y2"), key, grid)
    onward = F.struct("x1", "y1") < F.struct("x2", "y2")
    ends = [F.when(onward, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("x1", "x2", "xa"), ("y1", "y2", "ya"), ("x2", "x1", "xb"), ("y2", "y1", "yb"))]
    net = e.select(key, *ends, F.when(onward, 1).otherwise(-1).alias("way")).groupBy(key, "xa", "ya", "xb", "yb").agg(F.sum("way").alias("way")).where("way <> 0")
    turn = lambda a, b: F.when(F.col("way") > 0, F.col(a)).otherwise(F.col(b))
    return net.select(key, turn("xa", "xb").alias("x1"), turn("ya", "yb").alias("y1"), turn("xb", "xa").alias("x2"), turn("yb", "ya").alias("y2"))


def _jumped(rows: DataFrame, step, done, max_rounds: int) -> DataFrame:
    """Rounds of pointer jumping over (_edge, to, value): ``step(value, value there)`` until ``done(before, after)``."""
    now = settled(rows)
    for _ in range(max_rounds):
        there = now.select(F.col("_edge").alias("to"), F.col("to").alias("_to"), F.col("value").alias("_value"))
        moved = settled(now.join(there, "to", "left").select("_edge", F.col("_to").alias("to"), step(F.col("value"), F.col("_value")).alias("value")))
        if done(now, moved):
            return moved
        now = moved
    raise RuntimeError(f"pointers did not settle in {max_rounds} rounds")


def rings(edges: DataFrame, key: str, max_rounds: int = 40) -> DataFrame:
    """key, ring, hole, closed, points: edges put together by pointer jumping, in rounds that double what each edge knows.

    At a point with several ways on, the one that bounds the same wedge of the inside is taken, so rings that touch stay apart.
    The number of rounds is the logarithm of the longest ring.  Chains with an open end give rings with ``closed`` false.
    """
    e = edges.select(key, *EDGE).withColumn("dx", F.col("x2") - F.col("x1")).withColumn("dy", F.col("y2") - F.col("y1"))
    e = settled(e.withColumn("_edge", F.monotonically_increasing_id()))
    on = e.select(key, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("_edge").alias("to"), F.atan2("dy", "dx").alias("way"))
    clockwise = F.pmod(F.atan2(-F.col("dy"), -F.col("dx")) - F.col("way"), F.lit(6.283185307179586))
    clockwise = F.when(clockwise <= 0, clockwise + 6.283185307179586).otherwise(clockwise)
    follow = settled(e.join(on, [key, "x2", "y2"], "left").groupBy("_edge").agg(F.min_by("to", clockwise).alias("to")))
    same = lambda a, b: a.agg(F.sum("value")).first() == b.agg(F.sum("value")).first()
    labels = _jumped(follow.withColumn("value", F.col("_edge")), lambda v, w: F.least(v, w), same, max_rounds).select("_edge", F.col("value").alias("ring"))
    # Counting from each edge to the one before the ring's first: that one leads nowhere.
    way = follow.join(labels, "_edge").select("_edge", F.when(F.col("to") != F.col("ring"), F.col("to")).alias("to"), F.lit(1).cast("long").alias("value"))
    arrived = lambda _, b: b.where("to is not null").isEmpty()
    left = _jumped(way, lambda v, w: v + F.coalesce(w, F.lit(0)), arrived, max_rounds).select("_edge", F.col("value").alias("left"))
    rows = e.join(labels, "_edge").join(left, "_edge").groupBy(key, "ring").agg(F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), *EDGE))).alias("e"))
    x0, y0 = F.col("e")[0]["x1"], F.col("e")[0]["y1"]
    twice = F.aggregate("e", F.lit(0.0), lambda t, s: t + (s["x1"] - x0) * (s["y2"] - y0) - (s["x2"] - x0) * (s["y1"] - y0))
    last = F.element_at("e", -1)
    closed = (last["x2"] == x0) & (last["y2"] == y0)
    return rows.select(key, "ring", (twice < 0).alias("hole"), closed.alias("closed"), F.transform("e", lambda s: F.struct(s["x1"].alias("x"), s["y1"].alias("y"))).alias("points"))


def edges_of(spark: SparkSession, shapes: dict[str, list[list[tuple[float, float]]]], key: str = "canonical_region_id") -> DataFrame:
    """Edges of a few shapes given as rings (the first one outside, the others holes)."""
    rows = [(k, n, n > 0, [(float(x), float(y)) for x, y in ring]) for k, rings_ in shapes.items() for n, ring in enumerate(rings_)]
    return ring_edges(spark.createDataFrame(rows, f"{key} string, ring int, hole boolean, points array<struct<x:double,y:double>>"), key)
