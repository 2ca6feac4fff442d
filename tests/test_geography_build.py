import json

import pytest
from pyspark.sql import functions as F

from skyloom.plans import geography_build as gb
from skyloom.sources import boundaries
from skyloom.sources.artifacts import read_weights
from test_file_sources import write_shapes


def square(x, y, w=0.04, h=0.04):
    return [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]  # clockwise, as shapefiles have outer rings


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Two states of two counties each, two subdivisions of a province, a state of one municipality; three zones."""
    spark.dataSource.register(boundaries.Boundaries)
    at = tmp_path_factory.mktemp("world")
    name = lambda n: at / n
    write_shapes(name("us_states"), [[square(-100, 35, 0.08)], [square(-99.92, 35, 0.08)]], [{"STATEFP": "48", "STUSPS": "TX", "NAME": "Texas"}, {"STATEFP": "40", "STUSPS": "OK", "NAME": "Oklahoma"}])
    counties = [{"STATEFP": s, "COUNTYFP": c, "GEOID": s + c, "NAME": f"County {s}{c}"} for s, c in (("48", "1"), ("48", "003"), ("40", "001"), ("40", "003"))]
    write_shapes(name("us_counties"), [[square(-100 + 0.04 * k, 35)] for k in range(4)], counties)
    ca = [{"PRUID": "35", "CSDUID": "3501", "CSDNAME": "North", "PRNAME": "Ontario"}, {"PRUID": "35", "CSDUID": "3502", "CSDNAME": "South", "PRNAME": "Ontario"}]
    hole = square(-80.97, 45.01, 0.01, 0.01)[::-1]
    write_shapes(name("ca_subdivisions"), [[square(-81, 45), hole], [square(-81, 45.04)]], ca)
    write_shapes(name("mx_states"), [[square(-99, 20)]], [{"CVE_ENT": "9", "NOMGEO": "Capital"}])
    write_shapes(name("mx_municipalities"), [[square(-99, 20)]], [{"CVE_ENT": "09", "CVE_MUN": "2", "NOMGEO": "Centre"}])
    box = lambda w, s, e, n: [[[w, s], [e, s], [e, n], [w, n], [w, s]]]
    zones = {"America/West": box(-110, 10, -99.93, 50), "America/Mid": box(-99.93, 10, -90, 50), "America/East": box(-90, 10, -60, 60)}
    lines = [json.dumps({"type": "Feature", "properties": {"tzid": k}, "geometry": {"type": "Polygon", "coordinates": v}}) for k, v in zones.items()]
    name("zones.geojsonl").write_text("\n".join(lines))
    return {p.stem: str(p) for p in [*at.glob("*.shp"), name("zones.geojsonl")]}


def test_registry_and_weights_of_a_small_world(spark, world, tmp_path):
    paths = {k: v for k, v in world.items() if k != "zones"}
    zones = spark.read.format("boundaries").load(world["zones"])
    found = gb.build(gb.north_america(spark, paths), zones, "v1")
    rows = {r.canonical_region_id: r for r in found.registry.collect()}
    assert sorted(rows) == ["CA", "CA-ON", "CA-ON-3501", "CA-ON-3502", "MX", "MX-CMX", "MX-CMX-002", "US", "US-OK", "US-OK-001", "US-OK-003", "US-TX", "US-TX-001", "US-TX-003"]
    county = rows["US-TX-001"]
    assert (county.country_code, county.region_type, county.source_region_id, county.region_name, county.parent_region_id) == ("US", "county", "481", "County 481", "US-TX")
    assert (rows["CA-ON"].region_type, rows["CA-ON"].region_name, rows["CA-ON"].source_region_id, rows["CA-ON"].parent_region_id) == ("province", "Ontario", "ON", "CA")
    assert (rows["MX-CMX"].source_region_id, rows["US"].region_name, rows["US"].parent_region_id) == ("09", "United States", None)
    # Three of the four counties lie west of the line but for a quarter of the third.
    assert [rows[k].timezone.split("/")[1] for k in ("US-TX", "US-TX-003", "US-OK", "US-OK-001", "US", "CA", "MX")] == ["West", "West", "Mid", "Mid", "Mid", "East", "Mid"]
    assert rows["US-TX"].geometry_checksum != rows["US-OK"].geometry_checksum and rows["MX"].geometry_checksum == rows["MX-CMX-002"].geometry_checksum
    sums = {r[0]: r[1] for r in found.weights.groupBy("canonical_region_id").agg(F.sum("overlap_weight")).collect()}
    assert sums["US"] == pytest.approx(sums["US-TX"] + sums["US-OK"], rel=1e-9) and sums["US-TX"] == pytest.approx(sums["US-TX-001"] + sums["US-TX-003"], rel=1e-9)
    assert sums["CA-ON"] == pytest.approx(sums["CA-ON-3501"] + sums["CA-ON-3502"], rel=1e-9) and sums["CA-ON-3501"] < sums["CA-ON-3502"]
    gb.publish_geography(found, str(tmp_path), "grid-1", "0" * 64)
    weights, version = read_weights(spark, str(tmp_path))
    assert version == "grid-1" and weights.count() == found.weights.count() > 20


def test_fields_codes_and_zones_that_are_missing(spark, world):
    rings = spark.read.format("boundaries").load(world["us_states"])
    with pytest.raises(ValueError, match="Mexican states lack the fields CVE_ENT, NOMGEO"):
        gb.mx_states(rings)
    lost = rings.withColumn("properties", F.create_map(F.lit("PRUID"), F.lit("99"), F.lit("CSDUID"), F.lit("1"), F.lit("CSDNAME"), F.lit("x"), F.lit("PRNAME"), F.lit("y")))
    with pytest.raises(Exception, match="no province has the code 99"):
        gb.ca_subdivisions(lost).collect()
    counties = spark.read.format("boundaries").load(world["us_counties"])
    with pytest.raises(Exception, match="no state has the code 40"):
        gb.us_counties(counties, rings.where("properties['STUSPS'] = 'TX'")).collect()
    far = spark.read.format("boundaries").load(world["zones"]).where("properties['tzid'] = 'America/East'")
    with pytest.raises(ValueError, match="regions without a time zone: US"):
        gb.build([gb.us_states(rings)], far, "v1")
