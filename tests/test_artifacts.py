import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from test_state import HOUR, NOW, registry, scan, weights

from skyloom import schemas
from skyloom.functions import exprs
from skyloom.plans import pipeline, relations
from skyloom.plans.state import Store
from skyloom.sources import artifacts, discovery


def test_generations_are_checked_and_content_addressed(spark, tmp_path):
    root, w = str(tmp_path / "art"), weights(spark)
    build = artifacts.publish_artifact(w, root, "weights", artifacts.WEIGHT_ORDER, {"grid_version": "g1"})
    assert artifacts.publish_artifact(w.repartition(3), root, "weights", artifacts.WEIGHT_ORDER, {"grid_version": "g1"}) == build
    other = artifacts.publish_artifact(w.where("grid_col = 0"), root, "weights", artifacts.WEIGHT_ORDER, {"grid_version": "g1"})
    assert other != build
    back, version = artifacts.read_weights(spark, root)
    assert version == "g1" and back.count() == 3 and len(list((tmp_path / "art/weights").glob("manifest/*.json"))) == 2
    artifacts.publish_artifact(registry(spark), root, "registry", ["canonical_region_id"])
    assert {r.loaded_at for r in artifacts.read_registry(spark, root, F.lit(HOUR).cast("timestamp_ntz")).collect()} == {HOUR}
    with pytest.raises(ValueError, match="no generation"):
        artifacts.read_artifact(spark, root, "nothing", "a int")
    artifacts.publish_artifact(w.withColumn("overlap_weight", F.lit(-1.0)), root, "weights", artifacts.WEIGHT_ORDER)
    with pytest.raises(Exception, match="positive"):
        artifacts.read_weights(spark, root)[0].collect()


def test_file_digests(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    got = artifacts.file_digests(spark, str(tmp_path)).collect()
    assert [(r.length, r.sha256) for r in got] == [(3, hashlib.sha256(b"abc").hexdigest())]


def test_registry_replace_refuses_another_geometry(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert pipeline.replace_registry(store, registry(spark)) == 3
    pipeline.ingest(store, scan(spark, "g", 0, 1.0, 2.0), weights(spark), registry(spark), schemas.Contract(), NOW)
    assert pipeline.replace_registry(store, registry(spark)) == 3
    with pytest.raises(ValueError, match="another geometry"):
        pipeline.replace_registry(store, registry(spark).withColumn("geometry_version", F.lit("v2")))
    with pytest.raises(ValueError, match="one a region"):
        pipeline.replace_registry(store, registry(spark).union(registry(spark)))
    with pytest.raises(ValueError, match="load them first"):
        pipeline.require_geography(registry(spark), weights(spark).limit(0))
    with pytest.raises(ValueError, match="versions"):
        pipeline.require_geography(registry(spark), weights(spark).withColumn("geometry_version", F.lit("v9")))


def test_failures_are_recorded_and_the_others_go_on(spark, tmp_path):
    store, contract = Store(spark, str(tmp_path)), schemas.Contract()
    pipeline.discover(store, discovery.discover(spark, lambda *_: [{"id": g} for g in ("a", "b", "c")], "C1", now=NOW), NOW)

    def broken():
        raise OSError("no such scan")

    batch = [("a", broken), ("b", lambda: scan(spark, "b", 0, 1.0, 3.0)), ("c", lambda: scan(spark, "x", 0, 1.0, 3.0))]
    with pytest.raises(RuntimeError, match="2 of 3 granules failed"):
        pipeline.ingest_each(store, batch, weights(spark), registry(spark), contract, NOW)
    ledger = {r.granule_id: r for r in store.read("granule_inventory", schemas.GRANULE_INVENTORY).collect()}
    assert ledger["a"].processing_status == "failed" and "no such scan" in ledger["a"].error_message
    assert ledger["b"].processing_status == "processed" and ledger["b"].observation_hour == HOUR and "another granule" in ledger["c"].error_message
    assert pipeline.ingest_each(store, [("a", lambda: scan(spark, "a", 0, 5.0, 7.0))], weights(spark), registry(spark), contract, NOW) == ["a"]
    rows = store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()
    assert {r.no2_mean for r in rows} == {4.0} and {r.source_granule_count for r in rows} == {2}


def test_restored_siblings(spark):
    one, other, late = scan(spark, "a", 0, 1.0), scan(spark, "b", 0, 2.0), scan(spark, "c", 1, 2.0)
    assert pipeline.siblings_restored(one, other, "d", "d").count() == 2
    for sibling, digest, expected, what in ((other, "d", None, "checksum"), (other, "d", "e", "checksum"), (late, "d", "d", "several")):
        with pytest.raises(ValueError, match=what):
            pipeline.siblings_restored(one, sibling, digest, expected)


def test_record_variants(spark):
    records = [
        {"id": "top", "updated": "2026-07-12T10:00:00Z", "links": [{"href": " https://h/a.txt "}, {"href": "https://h/b.nc"}], "umm": {"TemporalExtent": {"SingleDateTime": {"Time": "2026-07-12T08:00:00Z"}}}},
        {"GranuleUR": "ur", "links": ["https://h/c.nc4"], "umm": {"TemporalExtent": {"SingleDateTime": "2026-07-12T09:00:00+01:00"}}, "meta": {"updated": "2020-01-01T00:00:00Z"}},
    ]
    got = {r.granule_id: r for r in discovery.discover(spark, lambda *_: records, "C", now=NOW).collect()}
    assert got["top"].download_url == "https://h/b.nc" and got["top"].cmr_revision_at == dt.datetime(2026, 7, 12, 10)
    assert got["top"].acquisition_start == got["top"].acquisition_end == dt.datetime(2026, 7, 12, 8)
    assert got["ur"].download_url == "https://h/c.nc4" and got["ur"].acquisition_start == dt.datetime(2026, 7, 12, 8) and got["ur"].cmr_revision_at is None


def test_times_of_files(spark):
    df = spark.createDataFrame([(1.5, "hours since 1970-01-01 00:00:00"), (2.0, "days since 2000-01-01T00:00:00Z"), (1.0, "fortnights since 1970-01-01"), (None, "hours since 1970-01-01")], "v double, u string")
    got = [r.t for r in df.select(exprs.cf_time(F.col("v"), F.col("u")).alias("t")).collect()]
    assert got == [dt.datetime(1970, 1, 1, 1, 30), dt.datetime(2000, 1, 3), None, None]
    with pytest.raises(Exception, match="units"):
        spark.range(1).select(exprs.cf_time(F.lit(1.0), F.lit(None).cast("string"))).collect()


def test_staging_and_exports(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    pipeline.replace_registry(store, registry(spark))
    pipeline.ingest(store, scan(spark, "g", 0, 1.0, 2.0), weights(spark), registry(spark), schemas.Contract(), NOW)
    pipeline.publish(store, registry(spark), schemas.Contract())
    found = relations.staging_views(store, schemas.scope("no2"))
    assert found["region_hour_aggregates"].count() == 3 and found["region_registry"].count() == 3 and found["grid_latest"].count() == 2
    assert relations.relation_columns(spark, ["no2_stg_region_registry", "absent"]).count() == 10
    marts = pipeline.views(spark, store, schemas.scope("no2"), registry(spark), NOW)
    history = relations.country_history(marts["country_hourly"], "US")
    assert [(r.observation_hour, r.region_count) for r in history.collect()] == [(HOUR, 1)]
    relations.export_csv(history, str(tmp_path / "csv"), one_file=True)
    lines = next((tmp_path / "csv").glob("part-*")).read_text().splitlines()
    assert lines[0].startswith("country_code,observation_hour") and lines[1].startswith("US,2026-07-12 12:00:00")
    relations.export_parquet(marts["region_hourly"], str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2
    assert json.loads(marts["region_registry"].limit(1).toJSON().first())["geometry_version"] == "v1"
