import datetime as dt
import hashlib
import json

import numpy as np
import pytest
from test_file_sources import DIMS, small, write_cdf
from test_state import NOW, registry

from skyloom import schemas
from skyloom.plans import pipeline
from skyloom.plans.state import Store
from skyloom.sources import artifacts, grid_files
from skyloom.streaming import ingest as stream


def weights(spark):
    return spark.createDataFrame([(r, c, k, 1.0, "v1") for r in (0, 1) for c in (0, 1) for k in ("US", "US-CA", "US-CA-037")], schemas.GRID_WEIGHTS)


def ledger(store):
    return {r.granule_id: r for r in store.read("granule_inventory", schemas.GRANULE_INVENTORY).collect()}


def test_a_broken_file_among_three(spark, tmp_path):
    spark.dataSource.register(grid_files.GridFiles)
    landing, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    landing.mkdir()
    write_cdf(landing / "a.nc", DIMS, small())
    write_cdf(landing / "c.nc", DIMS, small(vertical_column_troposphere=(("time", "y", "x"), np.full((1, 2, 2), 7e15, "f4"), {})))
    (landing / "b.nc").write_bytes(b"broken")
    (landing / "note.txt").write_text("no scan")
    decode = lambda path: spark.read.format("grid_files").load(path)
    args = (weights(spark), registry(spark), schemas.Contract())
    run = lambda: stream.ingest_files_stream(spark, str(landing), str(tmp_path / "check"), store, decode, *args, clock=lambda: NOW)
    with pytest.raises(RuntimeError, match="1 of 3 granules failed: b"):
        run()
    rows = ledger(store)
    assert {k: r.processing_status for k, r in rows.items()} == {"a": "processed", "b": "failed", "c": "processed"}
    assert "b.nc" in rows["b"].local_path and rows["b"].error_message and rows["a"].error_message is None
    hours = store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()
    assert {r.source_granule_count for r in hours} == {2} and {r.valid_pixel_count for r in hours} == {6}
    assert run() == []
    with pytest.raises(RuntimeError, match="1 of 1"):
        stream.retry_failed(store, decode, *args, NOW)
    write_cdf(landing / "b.nc", DIMS, small())
    assert stream.retry_failed(store, decode, *args, NOW) == ["b"] and ledger(store)["b"].error_message is None
    assert {r.source_granule_count for r in store.read("region_hour_aggregates", schemas.REGION_HOURS).collect()} == {3}
    # Retention: only below the root, and once.
    later = NOW + dt.timedelta(days=40)
    with pytest.raises(ValueError, match="outside"):
        pipeline.prune_files(store, str(landing / "deeper"), later, 30)
    assert len(list(landing.glob("*.nc"))) == 3
    assert pipeline.prune_files(store, str(landing), NOW, 30) == []
    assert sorted(pipeline.prune_files(store, str(landing), later, 30)) == ["a", "b", "c"]
    assert list(landing.glob("*.nc")) == [] and (landing / "note.txt").exists() and all(r.local_path is None for r in ledger(store).values())


def test_pinned_sources(spark, tmp_path):
    data = {"a.bin": b"abc" * 5_000_000, "b.bin": b"x"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    digest = {k: hashlib.sha256(v).hexdigest() for k, v in data.items()}
    for limit in (1 << 30, 10, 0):
        assert {r.path.rsplit("/", 1)[-1]: r.sha256 for r in artifacts.file_digests(spark, str(tmp_path), "*.bin", limit).collect()} == digest
    source = lambda k: {"id": k[0], "version": "1", "url": "u", "filename": k, "sha256": digest[k], "attribution": "x", "license": "y"}
    manifest = {"manifest_version": "1", "geometry_version": "v1", "sources": [source(k) for k in data]}
    at = tmp_path / "m.json"
    at.write_text(json.dumps(manifest))
    assert artifacts.verify_sources(spark, artifacts.source_manifest(str(at)), str(tmp_path)).keys() == {"a", "b"}
    (tmp_path / "b.bin").write_bytes(b"y")
    manifest["sources"].append(source("a.bin") | {"id": "c", "filename": "c.bin"})
    with pytest.raises(ValueError, match="b has the digest .*c is missing"):
        artifacts.verify_sources(spark, manifest, str(tmp_path))
    for change, what in (({"sha256": "00"}, "no valid"), ({"license": None}, "lacks license")):
        bad = source("a.bin") | change
        at.write_text(json.dumps(manifest | {"sources": [{k: v for k, v in bad.items() if v is not None}]}))
        with pytest.raises(ValueError, match=what):
            artifacts.source_manifest(str(at))


def test_weights_that_are_refused(spark, tmp_path):
    root, w = str(tmp_path), weights(spark)
    publish = lambda df, **notes: artifacts.publish_artifact(df, root, "weights", artifacts.WEIGHT_ORDER, notes)
    publish(w, grid_version="g1")
    assert artifacts.read_weights(spark, root, "g1")[0].count() == 12
    with pytest.raises(ValueError, match="not g2"):
        artifacts.read_weights(spark, root, "g2")
    publish(w.unionByName(w.limit(1)))
    with pytest.raises(ValueError, match="repeat the cell"):
        artifacts.read_weights(spark, root)
    publish(w.drop("geometry_version"))
    with pytest.raises(ValueError, match="lack the columns geometry_version"):
        artifacts.read_weights(spark, root)
    for bad in ("0D", "double('nan')", "double('infinity')", "cast(null as double)"):
        publish(w.selectExpr("grid_row", "grid_col", "canonical_region_id", f"if(grid_row = 0 and grid_col = 0, {bad}, 1D) as overlap_weight", "geometry_version"))
        with pytest.raises(Exception, match="positive"):
            artifacts.read_weights(spark, root)[0].collect()
