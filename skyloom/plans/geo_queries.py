"""Registered queries on polygons that are derived from the driver's tables.

Stars: a nation's customers, in the order of their keys, are the corners of a star around the nation's place.
Diamonds: a supplier is a square on its corner.  Tiles: a customer is a square of one degree in its nation's pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.operators import geography, polygons
from skyloom.operators.steps import settled
from skyloom.plans.registry import query, table

STARS = """corners as (select 'N' || c_nationkey as a, c_nationkey as k, c_custkey % 97 as m, row_number() over (partition by c_nationkey order by c_custkey) - 1 as i, count(*) over (partition by c_nationkey) as n from customer),
    points as (select a, i, round(-120.0::double + (k % 5) * 9 + cos(2 * pi() * i / n) * (0.4::double + m * 0.005::double), 6) as x, round(25.0::double + (k // 5) * 7 + sin(2 * pi() * i / n) * 0.8::double * (0.4::double + m * 0.005::double), 6) as y from corners where n >= 3),
    stars as (select a, x as x1, y as y1, coalesce(lead(x) over o, first_value(x) over o) as x2, coalesce(lead(y) over o, first_value(y) over o) as y2 from points window o as (partition by a order by i rows between unbounded preceding and unbounded following))"""

DIAMONDS = """centres as (select 'S' || s_suppkey as b, -120.0::double + (s_suppkey % 5) * 9 + (s_suppkey * 37 % 41 - 20) * 0.08::double as x, 25.0::double + (s_suppkey % 25 // 5) * 7 + (s_suppkey * 53 % 41 - 20) * 0.06::double as y, 0.05::double + (s_suppkey % 7) * 0.1::double as d from supplier),
    tips as (select b, unnest([0, 1, 2, 3]) as i, unnest([x, x + d, x, x - d]) as x, unnest([y - d, y, y + d, y]) as y from centres),
    diamonds as (select t.b, t.x as u1, t.y as v1, s.x as u2, s.y as v2 from tips t join tips s on t.b = s.b and s.i = (t.i + 1) % 4)"""


def pieces_sql(edges: str, key: str, names: str, step: float, south: float, name: str) -> str:
    """Edges cut at the rows of a grid, as SQL."""
    x1, y1, x2, y2 = names.split()
    return f"""{name}_cut as (select *, greatest(least({y1}, {y2}), {south}::double + r * {step}::double) as lo, least(greatest({y1}, {y2}), {south}::double + (r + 1) * {step}::double) as hi
      from (select *, unnest(generate_series(cast(floor((least({y1}, {y2}) - {south}) / {step}) as bigint) - 1, cast(floor((greatest({y1}, {y2}) - {south}) / {step}) as bigint) + 1)) as r from {edges} where {y1} <> {y2})),
    {name} as (select {key}, r, lo, hi, case when {y2} > {y1} then 1 else -1 end as sgn,
      case when lo = {y1} then {x1} when lo = {y2} then {x2} else {x1} + (lo - {y1}) * ({x2} - {x1}) / ({y2} - {y1}) end as xl,
      case when hi = {y1} then {x1} when hi = {y2} then {x2} else {x1} + (hi - {y1}) * ({x2} - {x1}) / ({y2} - {y1}) end as xh from {name}_cut where hi > lo)"""


def x_sql(lon: str) -> str:
    return f"(radians({lon}) * 5528256.639292836::double)"


def y_sql(lat: str) -> str:
    s, e = f"sin(radians({lat}))", "0.08181919084262149::double"
    return f"(({s} / (1 - {s} * {s} * 0.0066943799901413165::double) - ln((1 - {s} * {e}) / (1 + {s} * {e})) / (2 * {e})) * 3654705.508555261::double)"


def star_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Window.partitionBy("c_nationkey")
    c = table(spark, sf_dir, "customer").select("c_nationkey", (F.col("c_custkey") % 97).alias("m"), (F.row_number().over(own.orderBy("c_custkey")) - 1).alias("i"), F.count("*").over(own).alias("n"))
    far, turn = 0.4 + F.col("m") * 0.005, F.pi() * 2 * F.col("i") / F.col("n")
    place = F.round(-120.0 + (F.col("c_nationkey") % 5) * 9 + F.cos(turn) * far, 6), F.round(25.0 + F.floor(F.col("c_nationkey") / 5) * 7 + F.sin(turn) * 0.8 * far, 6)
    corner = F.struct("i", place[0].alias("x"), place[1].alias("y"))
    rings = c.where("n >= 3").groupBy("c_nationkey").agg(F.sort_array(F.collect_list(corner)).alias("points"))
    return polygons.ring_edges(rings.select(F.concat(F.lit("N"), "c_nationkey").alias("a"), F.lit(0).alias("ring"), F.lit(False).alias("hole"), "points"), "a")


def diamond_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), k.cast("string")).alias("b"), (-120.0 + (k % 5) * 9 + (k * 37 % 41 - 20) * 0.08).alias("x"), (25.0 + F.floor(k % 25 / 5) * 7 + (k * 53 % 41 - 20) * 0.06).alias("y"), (0.05 + (k % 7) * 0.1).alias("d"))
    tip = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y, d = F.col("x"), F.col("y"), F.col("d")
    return polygons.ring_edges(s.select("b", F.lit(0).alias("ring"), F.lit(False).alias("hole"), F.array(tip(x, y - d), tip(x + d, y), tip(x, y + d), tip(x - d, y)).alias("points")), "b")


@query(
    f"""with {STARS},
    {pieces_sql("stars", "a", "x1 y1 x2 y2", 0.02, 14.0, "pieces")},
    cells as (select a, r, unnest(generate_series(west, east)) as c from (select a, r from pieces group by all) join (select a, cast(floor((min(x1) + 168.0) / 0.02) as bigint) - 1 as west, cast(floor((max(x1) + 168.0) / 0.02) as bigint) + 1 as east from stars group by 1) using (a)),
    met as (select a, r, c, lo, hi, xl, xh, sgn, -168.0::double + c * 0.02::double as w, -168.0::double + (c + 1) * 0.02::double as e from pieces join cells using (a, r)),
    sides as (select *, case when xl = xh then null else least(greatest(lo + (w - xl) * (hi - lo) / (xh - xl), lo), hi) end as yw, case when xl = xh then null else least(greatest(lo + (e - xl) * (hi - lo) / (xh - xl), lo), hi) end as ye from met),
    part as (select a, r, c, sgn, w, e, least(greatest(xl, w), e) as xa, least(greatest(xh, w), e) as xb,
      case when xl = xh then lo when xh > xl then yw else ye end as ya, case when xl = xh then hi when xh > xl then ye else yw end as yb,
      case when xl = xh and xl <= w then 'west' when xl = xh and xl >= e then 'east' else 'in' end as place, lo, hi, xl, xh from sides),
    sums as (select a, r, c, sum(sgn * case place when 'west' then 0 when 'east' then ({x_sql("e")} - {x_sql("w")}) * ({y_sql("hi")} - {y_sql("lo")})
      else (({x_sql("xa")} + {x_sql("xb")}) / 2 - {x_sql("w")}) * ({y_sql("yb")} - {y_sql("ya")})
        + ({x_sql("e")} - {x_sql("w")}) * case when xl = xh then 0 when xh > xl then {y_sql("hi")} - {y_sql("yb")} else {y_sql("ya")} - {y_sql("lo")} end end) / 1e6 as area from part group by all)
    select a as canonical_region_id, cast(r as integer) as grid_row, cast(c as integer) as grid_col, round(area, 4) as overlap_weight from sums where area > 1e-6"""
)
def polygon_overlay(spark, sf_dir):
    """The area of every grid cell under each nation's star.  The SQL meets every edge with every cell of its row."""
    cells = polygons.grid_overlay(star_edges(spark, sf_dir).withColumnRenamed("a", "canonical_region_id")).where("overlap_weight > 1e-6")
    return cells.select("canonical_region_id", "grid_row", "grid_col", F.round("overlap_weight", 4).alias("overlap_weight"))


def _cross(p: str, q: str, r: str) -> str:
    (px, py), (qx, qy), (rx, ry) = (s.split() for s in (p, q, r))
    return f"sign(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"


_MEET = f"""least(x1, x2) <= greatest(u1, u2) and least(u1, u2) <= greatest(x1, x2) and least(y1, y2) <= greatest(v1, v2) and least(v1, v2) <= greatest(y1, y2)
      and {_cross("u1 v1", "u2 v2", "x1 y1")} * {_cross("u1 v1", "u2 v2", "x2 y2")} <= 0 and {_cross("x1 y1", "x2 y2", "u1 v1")} * {_cross("x1 y1", "x2 y2", "u2 v2")} <= 0"""

INTERSECTS = f"""crossed as (select distinct a, b from stars, diamonds where {_MEET}),
    inner_b as (select a, b from stars, (select b, min(u1) as px, arg_min(v1, u1) as py from diamonds group by 1) where least(y1, y2) <= py and py < greatest(y1, y2) and x1 + (py - y1) * (x2 - x1) / (y2 - y1) > px group by all having count(*) % 2 = 1),
    inner_a as (select a, b from diamonds, (select a, min(x1) as px, arg_min(y1, x1) as py from stars group by 1) where least(v1, v2) <= py and py < greatest(v1, v2) and u1 + (py - v1) * (u2 - u1) / (v2 - v1) > px group by all having count(*) % 2 = 1),
    pairs as (select a, b from crossed union select a, b from inner_a union select a, b from inner_b)"""


@query(f"with {STARS}, {DIAMONDS}, {INTERSECTS} select a, b from pairs")
def spatial_intersects(spark, sf_dir):
    """The nations' stars and suppliers' diamonds that share a point.  The SQL compares all edges with all edges."""
    return polygons.intersecting(star_edges(spark, sf_dir), diamond_edges(spark, sf_dir))


_COMMON = f"""{pieces_sql("stars", "a", "x1 y1 x2 y2", 0.25, -90.0, "sp")}, {pieces_sql("diamonds", "b", "u1 v1 u2 v2", 0.25, -90.0, "dp")},
    both_ as (select a, b, sp.sgn * dp.sgn as sgn, greatest(sp.lo, dp.lo) as s, least(sp.hi, dp.hi) as n, sp.lo as alo, sp.hi as ahi, sp.xl as axl, sp.xh as axh, dp.lo as blo, dp.hi as bhi, dp.xl as bxl, dp.xh as bxh from pairs join sp using (a) join dp using (b, r)),
    ends_ as (select a, b, sgn, {y_sql("n")} - {y_sql("s")} as h, {x_sql("axl + (s - alo) * (axh - axl) / (ahi - alo)")} as xs, {x_sql("axl + (n - alo) * (axh - axl) / (ahi - alo)")} as xn,
      {x_sql("bxl + (s - blo) * (bxh - bxl) / (bhi - blo)")} as us, {x_sql("bxl + (n - blo) * (bxh - bxl) / (bhi - blo)")} as un from both_ where n > s),
    west as (select a, b, sgn * h * case when (xs - us) * (xn - un) < 0 then (least(xs, us) + xs + (xs - us) / ((xs - us) - (xn - un)) * (xn - xs)) / 2 * (xs - us) / ((xs - us) - (xn - un))
      + (xs + (xs - us) / ((xs - us) - (xn - un)) * (xn - xs) + least(xn, un)) / 2 * (1 - (xs - us) / ((xs - us) - (xn - un))) else (least(xs, us) + least(xn, un)) / 2 end as w from ends_),
    common as (select a, b, sum(w) / 1e6 as area_km2 from west group by all having sum(w) / 1e6 > 1e-3)"""


@query(f"with {STARS}, {DIAMONDS}, {INTERSECTS}, {_COMMON} select b, a, round(area_km2, 3) as area_km2 from common qualify row_number() over (partition by b order by area_km2 desc, a) = 1")
def dominant_zone(spark, sf_dir):
    """The star that holds most of each supplier's diamond, by the area of what both hold."""
    a, b = settled(star_edges(spark, sf_dir)), settled(diamond_edges(spark, sf_dir))
    found = polygons.intersection_areas(a, b, polygons.intersecting(a, b)).where("area_km2 > 1e-3")
    return geography.dominant(found, "b", "a", "area_km2").select("b", "a", F.round("area_km2", 3).alias("area_km2"))


@query(
    """with tiles as (select distinct c_nationkey as k, c_custkey % 40 as x, (c_custkey // 40) % 60 as y from customer),
    sides as (select k, 2 * x + 1 as x, 2 * y as y from tiles union all select k, 2 * x + 1, 2 * y + 2 from tiles union all select k, 2 * x, 2 * y + 1 from tiles union all select k, 2 * x + 2, 2 * y + 1 from tiles),
    outer_ as (select k, x, y from sides group by all having count(*) = 1)
    select 'T' || k as id, true as closed, cast(n as bigint) as edges, cast(area as double) as area from (select k, count(*) as n from outer_ group by 1) join (select k, count(*) as area from tiles group by 1) using (k)"""
)
def dissolved_tiles(spark, sf_dir):
    """The union of each nation's tiles, put together to rings; the SQL counts sides that only one tile has."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("T"), F.col("c_nationkey")).alias("id"), (F.col("c_custkey") % 40).cast("double").alias("x"), F.expr("cast((c_custkey div 40) % 60 as double)").alias("y")).distinct()
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    tiles = c.select("id", F.lit(0).alias("ring"), F.lit(False).alias("hole"), F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("points"))
    found = polygons.rings(polygons.dissolve(polygons.ring_edges(tiles), "id"), "id")
    turned = F.zip_with("points", F.concat(F.slice("points", 2, F.size("points")), F.slice("points", 1, 1)), lambda p, q: (p["x"] * q["y"] - q["x"] * p["y"]) / 2)
    sums = F.bool_and("closed").alias("closed"), F.sum(F.size("points").cast("long")).alias("edges"), F.sum(F.aggregate(turned, F.lit(0.0), lambda t, v: t + v)).alias("area")
    return found.groupBy("id").agg(*sums)
