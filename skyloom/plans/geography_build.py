"""Region registry and grid weights from boundary files: levels, parents, countries, zones, checksums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators import polygons
from skyloom.operators.geography import dominant
from skyloom.operators.steps import settled
from skyloom.sources.artifacts import WEIGHT_ORDER, publish_artifact

KEY = "canonical_region_id"
META = ["country_code", "region_type", "source_region_id", KEY, "region_name", "parent_region_id"]

# Official codes of provinces and states, and names of countries.
CA_CODES = {"10": "NL", "11": "PE", "12": "NS", "13": "NB", "24": "QC", "35": "ON", "46": "MB", "47": "SK", "48": "AB", "59": "BC", "60": "YT", "61": "NT", "62": "NU"}
MX_CODES = {
    "01": "AGU", "02": "BCN", "03": "BCS", "04": "CAM", "05": "COA", "06": "COL", "07": "CHP", "08": "CHH", "09": "CMX", "10": "DUR", "11": "GUA",
    "12": "GRO", "13": "HID", "14": "JAL", "15": "MEX", "16": "MIC", "17": "MOR", "18": "NAY", "19": "NLE", "20": "OAX", "21": "PUE", "22": "QUE",
    "23": "ROO", "24": "SLP", "25": "SIN", "26": "SON", "27": "TAB", "28": "TAM", "29": "TLA", "30": "VER", "31": "YUC", "32": "ZAC",
}
COUNTRIES = {"US": "United States", "CA": "Canada", "MX": "Mexico"}


def required(rings: DataFrame, fields: set[str], provider: str) -> DataFrame:
    """The rings; an error names the fields that some of them lack."""
    missing = [F.count_if(~F.coalesce(F.map_contains_key("properties", f), F.lit(False))).alias(f) for f in sorted(fields)]
    found = rings.agg(*missing).first().asDict()
    lacking = [f for f, n in found.items() if n]
    if lacking:
        raise ValueError(f"boundaries of {provider} lack the fields {', '.join(lacking)}")
    return rings


def _code(codes: dict[str, str], key: Column, what: str) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]), key)
    return F.coalesce(found, F.raise_error(F.concat(F.lit(f"no {what} has the code "), F.coalesce(key, F.lit("null")))))


def _level(rings: DataFrame, country: str, kind: str, source: Column, region: Column, name: Column, parent: Column, parent_name: Column | None = None) -> DataFrame:
    """One row a ring, with the region that it belongs to."""
    values = [F.lit(country), F.lit(kind), source, region, name, parent]
    part = F.concat_ws("/", "path", F.col("record").cast("string"), F.col("ring").cast("string")).alias("ring")
    return rings.select(*[v.alias(n) for v, n in zip(values, META, strict=True)], (parent_name if parent_name is not None else parent).alias("parent_name"), part, "hole", "points")


def us_states(rings: DataFrame) -> DataFrame:
    p = F.col("properties")
    rings = required(rings, {"STATEFP", "STUSPS", "NAME"}, "US states")
    return _level(rings, "US", "state", p["STATEFP"], F.concat(F.lit("US-"), p["STUSPS"]), p["NAME"], F.lit("US"))


def us_counties(rings: DataFrame, states: DataFrame) -> DataFrame:
    """A county's state comes from the states' own codes; one that isn't among them is an error."""
    p = F.col("properties")
    codes = required(states, {"STATEFP", "STUSPS"}, "US states").select(p["STATEFP"].alias("_fips"), p["STUSPS"].alias("_code")).distinct()  # some sixty rows
    rows = required(rings, {"STATEFP", "COUNTYFP", "GEOID", "NAME"}, "US counties").join(codes, p["STATEFP"] == F.col("_fips"), "left")
    state = F.concat(F.lit("US-"), F.coalesce("_code", F.raise_error(F.concat(F.lit("no state has the code "), p["STATEFP"]))))
    return _level(rows, "US", "county", p["GEOID"], F.concat(state, F.lit("-"), F.lpad(p["COUNTYFP"], 3, "0")), p["NAME"], state)


def ca_subdivisions(rings: DataFrame) -> DataFrame:
    p = F.col("properties")
    rings = required(rings, {"PRUID", "CSDUID", "CSDNAME", "PRNAME"}, "Canadian subdivisions")
    parent = F.concat(F.lit("CA-"), _code(CA_CODES, p["PRUID"], "province"))
    return _level(rings, "CA", "census_subdivision", p["CSDUID"], F.concat(parent, F.lit("-"), p["CSDUID"]), p["CSDNAME"], parent, p["PRNAME"])


def mx_states(rings: DataFrame) -> DataFrame:
    p = F.col("properties")
    rings = required(rings, {"CVE_ENT", "NOMGEO"}, "Mexican states")
    code = F.lpad(p["CVE_ENT"], 2, "0")
    return _level(rings, "MX", "state", code, F.concat(F.lit("MX-"), _code(MX_CODES, code, "state")), p["NOMGEO"], F.lit("MX"))


def mx_municipalities(rings: DataFrame) -> DataFrame:
    p = F.col("properties")
    rings = required(rings, {"CVE_ENT", "CVE_MUN", "NOMGEO"}, "Mexican municipalities")
    state, own = F.lpad(p["CVE_ENT"], 2, "0"), F.lpad(p["CVE_MUN"], 3, "0")
    parent = F.concat(F.lit("MX-"), _code(MX_CODES, state, "state"))
    return _level(rings, "MX", "municipality", F.concat(state, own), F.concat(parent, F.lit("-"), own), p["NOMGEO"], parent)


def parents(finest: DataFrame, country: str, kind: str) -> DataFrame:
    """The rings of a level under the region above it."""
    source = F.element_at(F.split("parent_region_id", "-"), -1)
    values = [F.lit(country), F.lit(kind), source, F.col("parent_region_id"), F.col("parent_name"), F.lit(country)]
    return finest.select(*[v.alias(n) for v, n in zip(values, META, strict=True)], F.lit(country).alias("parent_name"), "ring", "hole", "points")


def countries(first: DataFrame) -> DataFrame:
    """The rings of the first level under their countries."""
    code = F.col("country_code")
    values = [code, F.lit("country"), code, code, _code(COUNTRIES, code, "country"), F.lit(None).cast("string")]
    return first.select(*[v.alias(n) for v, n in zip(values, META, strict=True)], F.lit(None).cast("string").alias("parent_name"), "ring", "hole", "points")


@dataclass
class Geography:
    registry: DataFrame
    weights: DataFrame
    edges: DataFrame


def zones_of(regions: DataFrame, shapes: DataFrame, zones: DataFrame) -> DataFrame:
    """canonical_region_id, timezone: of the zones that a region meets the one with most of its area.

    ``regions``: edges with their rings; ``shapes``: the dissolved edges; ``zones``: rings of ``boundaries`` with a tzid.
    A region that meets no zone is an error.
    """
    rings = required(zones, {"tzid"}, "time zones").select(F.col("properties")["tzid"].alias("b"), F.concat_ws("/", "path", F.col("record").cast("string"), F.col("ring").cast("string")).alias("ring"), "hole", "points")
    b = settled(polygons.ring_edges(rings, "b"))
    pairs = settled(polygons.intersecting(regions.withColumnRenamed(KEY, "a"), b))
    found = polygons.intersection_areas(shapes.withColumnRenamed(KEY, "a"), b, pairs)
    # A region that only touches zones has no area with any, and takes the smallest name.
    area = pairs.join(found, ["a", "b"], "left").select("a", "b", F.coalesce("area_km2", F.lit(0.0)).alias("area_km2"))
    out = settled(dominant(area, "a", "b", "area_km2").select(F.col("a").alias(KEY), F.col("b").alias("timezone")))
    without = shapes.select(KEY).distinct().join(out, KEY, "left_anti").limit(5).collect()
    if without:
        raise ValueError(f"regions without a time zone: {', '.join(r[KEY] for r in without)}")
    return out


def checksums(shapes: DataFrame) -> DataFrame:
    """canonical_region_id, geometry_checksum: a digest of a region's edges whatever their order, from sums of their hashes."""
    row = F.sha2(F.concat_ws(",", *[F.col(c).cast("string") for c in polygons.EDGE]), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).cast("string")
    return shapes.groupBy(KEY).agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *[part(k) for k in range(4)]), 256).alias("geometry_checksum"))


def build(levels: list[DataFrame], zones: DataFrame, geometry_version: str, grid: polygons.Grid | None = None) -> Geography:
    """Registry, weights and dissolved edges of regions.

    ``levels``: rings with their regions, as the functions above give them (parents and countries too).  A region's parts are dissolved,
    so borders between them and broken rings don't count; weights are the areas of the grid's cells in it.
    """
    rings = levels[0]
    for more in levels[1:]:
        rings = rings.unionByName(more)
    rings = settled(rings)
    edges = settled(polygons.ring_edges(rings, KEY))
    shapes = settled(polygons.dissolve(edges, KEY))
    empty = rings.select(KEY).distinct().join(shapes, KEY, "left_anti").limit(5).collect()
    if empty:
        raise ValueError(f"regions without a shape: {', '.join(str(r[KEY]) for r in empty)}")
    meta = rings.groupBy(KEY).agg(F.min(F.struct(*[c for c in META if c != KEY])).alias("m"))
    registry = meta.join(zones_of(edges, shapes, zones), KEY).join(checksums(shapes), KEY)
    registry = registry.select(*[F.col(KEY) if c == KEY else F.col(f"m.{c}") for c in META], "timezone", F.lit(geometry_version).alias("geometry_version"), "geometry_checksum")
    weights = polygons.grid_overlay(shapes, grid, KEY).withColumn("geometry_version", F.lit(geometry_version))
    return Geography(registry, weights.select(*schemas.GRID_WEIGHTS.fieldNames()), shapes)


def north_america(spark: SparkSession, paths: dict[str, str]) -> list[DataFrame]:
    """All levels of the three countries from their boundary files (us_states, us_counties, ca_subdivisions, mx_states, mx_municipalities)."""
    rings = {k: spark.read.format("boundaries").load(p) for k, p in paths.items()}
    us, mx = us_states(rings["us_states"]), mx_states(rings["mx_states"])
    counties, subdivisions = us_counties(rings["us_counties"], rings["us_states"]), ca_subdivisions(rings["ca_subdivisions"])
    ca = parents(subdivisions, "CA", "province")
    first = us.unionByName(ca).unionByName(mx)
    return [countries(first), us, counties, ca, subdivisions, mx, mx_municipalities(rings["mx_municipalities"])]


def publish_geography(found: Geography, root: str, grid_version: str, sources_digest: str) -> tuple[str, str]:
    """Write registry and weights as generations in canonical order; their build ids."""
    notes = {"grid_version": grid_version, "geometry_version": found.registry.first().geometry_version, "source_manifest_sha256": sources_digest}
    return publish_artifact(found.registry, root, "registry", [KEY], notes), publish_artifact(found.weights, root, "weights", WEIGHT_ORDER, notes)
