import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators.checks import relation_report, unequal
from skyloom.plans import models, pipeline
from skyloom.plans.state import Conflict, Store, merge_discovered, one_hour, prunable, upsert
from skyloom.sources import discovery
from skyloom.streaming.ingest import ingest_stream

NOW = dt.datetime(2026, 7, 13)
HOUR = dt.datetime(2026, 7, 12, 12)


def registry(spark):
    rows = [("US", t, i, i, i, None, "America/Los_Angeles", "v1", "x", NOW) for i, t in (("US", "country"), ("US-CA", "state"), ("US-CA-037", "county"))]
    return spark.createDataFrame(rows, schemas.REGION_REGISTRY)


def weights(spark):
    return spark.createDataFrame([(0, c, r, 1.0, "v1") for r in ("US", "US-CA", "US-CA-037") for c in (0, 1)], schemas.GRID_WEIGHTS)


def scan(spark, granule, day, *values, minute=0):
    at = HOUR + dt.timedelta(days=day)
    return spark.createDataFrame([(granule, at + dt.timedelta(minutes=minute), at, 0, c, v, 0, 34.0, -118.0) for c, v in enumerate(values)], schemas.GRID_CELLS)


def test_ingest_publish_and_late_data(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract(anomaly_min_baseline_samples=2)
    for day in range(4):
        pipeline.ingest(store, scan(spark, f"g{day}", day, 1.0 + day, 2.0 + day), weights(spark), registry(spark), contract, NOW)
    assert pipeline.publish(store, registry(spark), contract) == 12
    late = pipeline.ingest(store, scan(spark, "late", 1, 50.0, 60.0, minute=30), weights(spark), registry(spark), contract, NOW + dt.timedelta(hours=1))
    assert late == 5 and store.state["revision"] == 5
    hour = store.read("region_hour_aggregates", schemas.REGION_HOURS).where(F.col("revision") == 5).collect()
    assert len(hour) == 3 and {r.source_granule_count for r in hour} == {2}
    assert pipeline.publish(store, registry(spark), contract) == 3
    part = store.read("region_anomalies", pipeline.ANOMALIES)
    kept = spark.createDataFrame(part.collect(), part.schema)
    pipeline.publish(store, registry(spark), contract, full_refresh=True)
    assert unequal(kept, store.read("region_anomalies", pipeline.ANOMALIES)).count() == 0
    found = pipeline.views(spark, store, schemas.scope("no2"), registry(spark), NOW)
    assert found["grid_latest"].count() == 2 and found["country_hourly"].count() == 4
    assert all(r["ok"] for r in relation_report(found["region_hourly"], "region_hourly", models.KEY, models.KEY, "coverage_fraction"))


def test_replay_gives_the_same_hours(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract()
    for _ in range(2):
        pipeline.ingest(store, scan(spark, "g", 0, 1.0, 3.0), weights(spark), registry(spark), contract, NOW)
    rows = store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()
    assert len(rows) == 3 and {r.no2_mean for r in rows} == {2.0} and {r.revision for r in rows} == {2}


def test_failed_commit_leaves_old_state(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit({"a": spark.range(3)}, revision=1)
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.commit({"a": spark.range(5), "b": bad}, revision=2)
    assert store.read("a", "id long").count() == 3 and store.state["revision"] == 1
    with pytest.raises(ValueError, match="grow"):
        store.commit({"a": spark.range(1)}, revision=1)


def test_stream_takes_new_files_once(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path / "store")), schemas.Contract()
    land, mark = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    args = (spark, land, mark, store, weights(spark), registry(spark), contract, lambda: NOW)
    scan(spark, "g0", 0, 1.0, 3.0).write.mode("append").parquet(land)
    ingest_stream(*args)
    scan(spark, "g1", 0, 5.0, 7.0).write.mode("append").parquet(land)
    ingest_stream(*args)
    ingest_stream(*args)
    rows = store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()
    assert {r.no2_mean for r in rows} == {4.0} and store.state["revision"] == 2


def test_discovery_and_ledger(spark):
    records = [
        {"meta": {"native-id": "a", "revision-date": "2026-07-12T10:00:00Z"}, "umm": {"GranuleUR": "x", "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": "2026-07-12T08:00:00+02:00", "EndingDateTime": "bad"}}}, "data_links": [" ", "https://h/x.html", "https://h/x.NC?a=1"]},
        {"granule_ur": "b", "time_start": "2026-07-12T07:00:00Z", "data_links": []},
    ]
    found = discovery.discover(spark, lambda *_: records, "C1", lookback_hours=1, now=NOW)
    got = {r.granule_id: r for r in found.collect()}
    assert got["a"].download_url == "https://h/x.NC?a=1" and got["a"].acquisition_start == dt.datetime(2026, 7, 12, 6) and got["a"].acquisition_end is None
    assert got["b"].download_url is None and got["b"].acquisition_start == dt.datetime(2026, 7, 12, 7)
    at = F.lit(NOW).cast("timestamp_ntz")
    first, counts = merge_discovered(discovery.empty_inventory(spark), found, at)
    assert counts == {"found": 2, "inserted": 2, "refreshed": 0}
    again, counts = merge_discovered(first, found.where("granule_id = 'a'"), at)
    assert counts == {"found": 1, "inserted": 0, "refreshed": 1} and again.count() == 2
    assert [r.granule_id for r in discovery.pending(again, 1).collect()] == ["a"]
    with pytest.raises(ValueError, match="one day"):
        prunable(again, at, 0)
    with pytest.raises(Exception, match="identifier"):
        discovery.normalise(spark.createDataFrame([{"data_links": []}], discovery.RECORD), "C1").collect()


def test_upsert_rejects_repeated_keys(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        upsert(rows, rows.union(rows), ["k"]).collect()


def test_scopes_and_contracts(tmp_path):
    assert schemas.scope("NO2-STD").contract.stale_hours_error == 48 and schemas.scope("no2").database("marts") == "no2_marts"
    with pytest.raises(ValueError, match="unknown scope"):
        schemas.scope("x")
    with pytest.raises(ValueError, match="exceed"):
        schemas.Contract(stale_hours_warn=5, stale_hours_error=5)
    p = tmp_path / "c.csv"
    p.write_text("contract_key,contract_version,min_region_coverage,stale_hours_warn,stale_hours_error,anomaly_baseline_days,anomaly_min_baseline_samples,accepted_quality_flags\ndefault,0.4.0,0.25,6,12,28,7,0|1\n")
    assert discovery.read_contract(str(p)) == schemas.Contract()
    with pytest.raises(ValueError, match="both"):
        discovery.window(start=NOW)


def test_publish_reads_and_writes_only_what_changed(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract(anomaly_min_baseline_samples=2)
    rows = spark.range(12).selectExpr(
        "timestamp_ntz '2026-06-01 12:00:00' + make_dt_interval(cast(id as int)) as observation_hour", "'US-CA' as canonical_region_id", "'US' as country_code", "'state' as region_type",
        "cast(id * id as double) as no2_mean", "1D as no2_median", "1D as no2_p90", "1L as valid_pixel_count", "1L as total_pixel_count", "1D as valid_area_km2", "1D as total_area_km2",
        "1D as coverage_fraction", "true as quality_flag_accepted", "1 as source_granule_count", "true as all_granules_validated", "1L as revision", "'v1' as geometry_version", "timestamp_ntz '2026-07-01' as ingested_at",
    )
    store.commit({}, 1, {"region_hour_aggregates": store.stage("region_hour_aggregates", rows, None, 1)})
    assert pipeline.publish(store, registry(spark), contract) == 12 and pipeline.publish(store, registry(spark), contract) == 0
    before = store.parts("region_anomalies")
    late = rows.where("no2_mean = 81").withColumns({"no2_mean": F.lit(7.0), "revision": F.lit(2).cast("long")})
    store.commit({}, 2, {"region_hour_aggregates": store.stage("region_hour_aggregates", late, ["2026061012"], 2)})
    # One of three region-hours in reach: the window; with a tenth of them it would be the join.
    assert pipeline.publish(store, registry(spark), contract) == 1
    after = store.parts("region_anomalies")
    assert {k for k in after if after[k] != before[k]} == {"2026061012", "2026061112", "2026061212"}
    early = rows.where("no2_mean = 0").withColumns({"no2_mean": F.lit(9.0), "revision": F.lit(3).cast("long")})
    store.commit({}, 3, {"region_hour_aggregates": store.stage("region_hour_aggregates", early, ["2026060112"], 3)})
    assert pipeline.publish(store, registry(spark), contract) == 1
    part = store.read("region_anomalies", pipeline.ANOMALIES)
    kept = spark.createDataFrame(part.collect(), part.schema)
    assert store.vacuum() > 0
    pipeline.publish(store, registry(spark), contract, full_refresh=True)
    assert unequal(kept, store.read("region_anomalies", pipeline.ANOMALIES)).count() == 0 and kept.count() == 12


def test_a_scan_that_moves_leaves_its_old_hour(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract()
    pipeline.discover(store, discovery.discover(spark, lambda *_: [{"granule_ur": "g"}], "C1", now=NOW), NOW)
    for day in (0, 1):
        pipeline.ingest(store, scan(spark, "g", day, 1.0, 3.0), weights(spark), registry(spark), contract, NOW)
    assert {r.observation_hour for r in store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()} == {HOUR + dt.timedelta(days=1)}
    with pytest.raises(ValueError, match="several"):
        one_hour(scan(spark, "a", 0, 1.0).union(scan(spark, "b", 1, 1.0)))
    with pytest.raises(ValueError, match="needs rows"):
        one_hour(scan(spark, "a", 0, 1.0).limit(0))


def test_of_two_writers_the_second_gets_a_conflict(spark, tmp_path):
    first, second = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    first.commit({"a": spark.range(1)}, revision=1)
    hours = spark.createDataFrame([(HOUR, 1.0)], "observation_hour timestamp_ntz, v double")
    staged = second.stage("h", hours, None, 2)
    first.commit({"a": spark.range(2)}, revision=2)
    with pytest.raises(Conflict):
        second.commit({}, revision=3, staged={"h": staged})
    with pytest.raises(Conflict):
        second._point(first.state)  # the number that the other writer has just taken
    assert first.state["revision"] == second.state["revision"] == 2 and not second.parts("h")
    assert second.read("a", "id long").count() == 2
    second.commit({}, revision=3, staged={"h": second.stage("h", hours, None, 3)})
    assert first.read("h", hours.schema).count() == 1 and not [n for n in first._list(f"{tmp_path}/pointer") if n.startswith("_draft")]


def test_old_states_go_with_vacuum(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(13):
        store.commit({}, note=k)
    store.vacuum()
    assert len(store._pointers()) == 10 and Store(spark, str(tmp_path)).state["note"] == 12


def test_latest_cells_are_written_by_band(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract()
    rows = (0, 63, 64, 200)  # three bands
    grid = spark.createDataFrame([(r, 0, i, 1.0, "v1") for r in rows for i in ("US", "US-CA", "US-CA-037")], schemas.GRID_WEIGHTS)

    def take(granule, minute, *cells):
        at = HOUR + dt.timedelta(minutes=minute)
        batch = spark.createDataFrame([(granule, at, HOUR, r, 0, v, 0, 34.0, -118.0) for r, v in cells], schemas.GRID_CELLS)
        pipeline.ingest(store, batch, grid, registry(spark), contract, NOW)
        return store.parts("grid_latest")

    def latest():
        return {r.grid_row: (r.no2, r.granule_id) for r in store.read("grid_latest", schemas.GRID_LATEST).collect()}

    first = take("a", 10, *[(r, 1.0) for r in rows])
    assert sorted(first) == ["000000", "000001", "000003"]
    second = take("b", 20, (63, 2.0), (0, float("nan")), (500, 3.0))
    assert {k for k in second if second[k] != first[k]} == {"000000"} and set(second) == set(first)  # row 500 lies in no country
    assert latest() == {0: (None, "b"), 63: (2.0, "b"), 64: (1.0, "a"), 200: (1.0, "a")}
    take("c", 5, (64, 9.0))  # an older scan that comes late
    assert latest()[64] == (1.0, "a")
    # A table of a store that was written whole is split at the next scan.
    whole = store.read("grid_latest", schemas.GRID_LATEST)
    store.commit({"grid_latest": spark.createDataFrame(whole.collect(), schemas.GRID_LATEST)})
    assert store.is_whole("grid_latest") and not store.parts("grid_latest")
    assert sorted(take("d", 30, (200, 7.0))) == ["000000", "000001", "000003"]
    assert latest() == {0: (None, "b"), 63: (2.0, "b"), 64: (1.0, "a"), 200: (7.0, "d")} and not store.is_whole("grid_latest")


def test_parts_of_latest_cells_are_bounded(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract()
    rows = [64 * k for k in range(200)]
    grid = spark.createDataFrame([(r, 0, i, 1.0, "v1") for r in rows for i in ("US", "US-CA", "US-CA-037")], schemas.GRID_WEIGHTS)

    def take(granule, minute, value, some):
        at = HOUR + dt.timedelta(minutes=minute)
        batch = spark.createDataFrame([(granule, at, HOUR, r, 0, value, 0, 34.0, -118.0) for r in some], schemas.GRID_CELLS)
        pipeline.ingest(store, batch, grid, registry(spark), contract, NOW)
        return store.parts("grid_latest")

    first = take("a", 10, 1.0, rows)
    assert len(first) == 64
    second = take("b", 20, 2.0, [64 * 70])
    assert {k for k in second if second[k] != first[k]} == {"000006"} and set(second) == set(first)
    # A band that an earlier build named by its number alone is found again, and named anew.
    old = store.stage("grid_latest", store.read("grid_latest", schemas.GRID_LATEST), None, 3, F.lpad(F.floor(F.col("grid_row") / 64).cast("string"), 6, "0"))
    assert len(old) == 200
    store.commit({}, None, {"grid_latest": old})
    assert set(take("c", 30, 3.0, [64 * 71])) == set(first)
    values = {r.grid_row: r.no2 for r in store.read("grid_latest", schemas.GRID_LATEST).collect()}
    assert values == {r: 1.0 for r in rows} | {64 * 70: 2.0, 64 * 71: 3.0}
