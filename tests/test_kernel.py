import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators import geography, kernel

HOUR = dt.datetime(2026, 7, 12, 12)


def cells(spark, rows):
    """rows: granule, col, value, flag"""
    return spark.createDataFrame([(g, HOUR, HOUR, 0, c, v, q, 34.0, -118.0) for g, c, v, q in rows], schemas.GRID_CELLS)


def weights(spark, rows):
    return spark.createDataFrame([(0, c, r, w, "v1") for c, r, w in rows], schemas.GRID_WEIGHTS)


def regions(spark, rows):
    return spark.createDataFrame(rows, "canonical_region_id string, country_code string, region_type string")


@pytest.mark.parametrize("limit", [None, 1])
def test_unequal_weights(spark, limit):
    out = kernel.region_hours(cells(spark, [("g", 0, 10.0, 0), ("g", 1, 20.0, 0)]), weights(spark, [(0, "US", 1.0), (1, "US", 3.0)]), regions(spark, [("US", "US", "country")]), [0], limit).first()
    assert (out.no2_mean, out.no2_median, out.no2_p90) == (17.5, 20.0, 20.0)


@pytest.mark.parametrize("limit", [None, 1])
def test_pooled_scans(spark, limit):
    rows = [("g1", 0, 10.0, 0), ("g1", 1, 20.0, 0), ("g2", 0, 30.0, 0), ("g2", 1, 40.0, 2)]
    out = kernel.region_hours(cells(spark, rows), weights(spark, [(0, "US", 1.0), (1, "US", 3.0)]), regions(spark, [("US", "US", "country")]), [0], limit).first()
    assert (out.no2_mean, out.no2_median, out.no2_p90) == (20.0, 20.0, 30.0)
    assert (out.valid_pixel_count, out.total_pixel_count, out.valid_area_km2, out.total_area_km2, out.source_granule_count) == (3, 4, 5.0, 8.0, 2)


def test_coverage_and_regions_without_valid_cells(spark):
    w = weights(spark, [(0, "US", 1.0), (1, "US", 3.0), (0, "US-CA", 1.0), (1, "US-CA", 1.0), (1, "US-CA-037", 3.0)])
    r = regions(spark, [("US", "US", "country"), ("US-CA", "US", "state"), ("US-CA-037", "US", "county")])
    got = {x.canonical_region_id: x for x in kernel.region_hours(cells(spark, [("g", 0, 10.0, 0), ("g", 1, 20.0, 2)]), w, r, [0]).collect()}
    assert {k: x.coverage_fraction for k, x in got.items()} == {"US": 0.25, "US-CA": 0.5, "US-CA-037": 0.0}
    none = got["US-CA-037"]
    assert none.no2_mean is None and none.no2_median is None and not none.quality_flag_accepted


def test_zero_weight_keeps_counts(spark):
    out = kernel.region_hours(cells(spark, [("g", 0, 10.0, 0)]), weights(spark, [(0, "US", 0.0)]), regions(spark, [("US", "US", "country")]), [0]).first()
    assert out.valid_pixel_count == 1 and out.no2_mean is None and out.no2_median is None and out.coverage_fraction == 0.0


def test_unregistered_region_is_an_error(spark):
    with pytest.raises(Exception, match="without registry row"):
        kernel.region_hours(cells(spark, [("g", 0, 1.0, 0)]), weights(spark, [(0, "XX", 1.0)]), regions(spark, [("US", "US", "country")]), [0]).collect()


def test_latest_batch_masks(spark):
    rows = [("g", 0, float("nan"), 0), ("g", 1, float("nan"), -9999), ("g", 2, 5.0, 2), ("g", 3, 5.0, 0)]
    w = weights(spark, [(0, "US", 1.0), (1, "US", 1.0), (2, "US", 1.0), (3, "US-CA", 1.0)])
    out = kernel.latest_batch(cells(spark, rows), w, regions(spark, [("US", "US", "country"), ("US-CA", "US", "state")]), [0, 1], F.lit(HOUR).cast("timestamp_ntz"))
    got = {r.grid_col: (r.no2, r.quality_flag_accepted) for r in out.collect()}
    assert got == {0: (None, True), 2: (5.0, False)}


def test_newest_keeps_existing_on_ties(spark):
    schema = "k int, t int, i int, v string"
    old = spark.createDataFrame([(1, 5, 5, "old"), (2, 5, 5, "old"), (3, 5, 5, "old")], schema)
    new = spark.createDataFrame([(1, 5, 5, "new"), (2, 6, 1, "new"), (3, 4, 9, "new"), (4, 1, 1, "new")], schema)
    got = {r.k: r.v for r in kernel.newest(old, new, ["k"], ["t", "i"]).collect()}
    assert got == {1: "old", 2: "new", 3: "old", 4: "new"}


def test_rectangles(spark):
    box = spark.createDataFrame([("full", -168.0, 14.0, -167.98, 14.02), ("half", -168.0, 14.0, -167.99, 14.02)], "canonical_region_id string, west double, south double, east double, north double")
    got = {r.canonical_region_id: r for r in geography.rectangle_weights(box).where("overlap_weight > 1e-6").collect()}
    assert (got["full"].grid_row, got["full"].grid_col) == (0, 0)
    assert got["half"].overlap_weight == pytest.approx(got["full"].overlap_weight / 2)


def brute_quantiles(rows, q):
    rows, cum, total = sorted(rows), 0, sum(w for _, w in rows)
    for v, w in rows:
        cum += w
        if cum >= total * q:
            return v
    return rows[-1][0]


def test_narrowing_is_exact_under_outliers_and_ties(spark):
    import random

    rnd = random.Random(8)
    groups = {
        "outlier": [(rnd.gauss(0, 1), 1) for _ in range(4000)] + [(1e30, 1), (-1e30, 2)],
        "ties": [(rnd.randrange(5), rnd.randint(1, 9)) for _ in range(4000)],
        "heavy": [(rnd.random(), 1) for _ in range(3000)] + [(0.25, 10_000)],
        "one": [(7.0, 3)] * 2000,
        "small": [(rnd.random(), rnd.randint(1, 5)) for _ in range(40)],
        "nothing": [(1.0, 0)] * 700,
    }
    df = spark.createDataFrame([(g, float(v), w) for g, rows in groups.items() for v, w in rows], "g string, value double, weight int").repartition(5)
    got = {r.g: r for r in kernel.weighted_stats(df, ["g"], limit=60).collect()}
    want = {r.g: r for r in kernel.weighted_stats(df, ["g"]).collect()}
    for g, rows in groups.items():
        r = got[g]
        if g == "nothing":
            assert (r.no2_mean, r.no2_median, r.no2_p90, r.valid_pixel_count) == (None, None, None, 700)
            continue
        assert (r.no2_median, r.no2_p90) == (brute_quantiles(rows, 0.5), brute_quantiles(rows, 0.9)) == (want[g].no2_median, want[g].no2_p90)
        assert (r.valid_pixel_count, r.valid_area_km2) == (len(rows), sum(w for _, w in rows)) and r.no2_mean == pytest.approx(want[g].no2_mean)


def test_no_round_keeps_more_than_its_share(spark, monkeypatch):
    seen = []
    settled = kernel.settled

    def watched(df):
        out = settled(df)
        if "_base" in out.columns:
            seen.append(out.groupBy("g").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(kernel, "settled", watched)
    df = spark.range(200_000).selectExpr("'x' as g", "if(id = 0, 1e30, double(id)) as value", "1 as weight")
    row = kernel.narrowed(df, ["g"], limit=100).first()
    assert (row.no2_median, row.no2_p90) == (100_000.0, 180_000.0)
    assert len(seen) == 4 and all(n < 200_000 / 64 * 1.5 for n in seen) and min(seen) <= 100
