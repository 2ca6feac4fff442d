"""Discover, ingest and publish for a scope, on a ``Store``."""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators.kernel import LIMIT, latest_batch, newest, region_hours
from skyloom.plans import models
from skyloom.plans.state import BANDS, Store, band_key, hour_key, mark, merge_discovered, one_hour, prunable, upsert
from skyloom.sources.files import locate

HOURLY = "canonical_region_id string, country_code string, region_type string, observation_hour timestamp_ntz, timezone string, no2_mean double, no2_median double, no2_p90 double, valid_pixel_count bigint, total_pixel_count bigint, valid_area_km2 double, total_area_km2 double, coverage_fraction double, quality_flag_accepted boolean, source_granule_count int, all_granules_validated boolean, revision bigint, geometry_version string, ingested_at timestamp_ntz, contract_version string, local_observation_hour timestamp_ntz, is_analysis_ready boolean"
ANOMALIES = "canonical_region_id string, observation_hour timestamp_ntz, timezone string, local_observation_hour timestamp_ntz, no2_mean double, baseline_sample_count bigint, baseline_median double, baseline_mad double, is_analysis_ready boolean, source_revision bigint, contract_version string, no2_difference double, robust_z_score double"


def discover(store: Store, found: DataFrame, now: dt.datetime) -> dict[str, int]:
    """Merge discovered granules into the ledger."""
    merged, counts = merge_discovered(store.read("granule_inventory", schemas.GRANULE_INVENTORY), found, F.lit(now).cast("timestamp_ntz"))
    store.commit({"granule_inventory": merged})
    return counts


def ingest(store: Store, cells: DataFrame, weights: DataFrame, registry: DataFrame, contract: schemas.Contract, now: dt.datetime, limit: int | None = LIMIT) -> int:
    """Take newly decoded scans in: their whole hours are recomputed from all scans of the hour.

    Raw cells are kept by hour, so a late scan pools with its siblings, and only touched hours are
    read and written (also the hour that an earlier version of a scan stood in).  Latest cells are kept by
    band of grid rows, and only bands with cells of the scans are read and written.  Region-hours, latest
    cells and the ledger move in one commit.  Replaying a scan gives the same hours again.
    ``limit``: rows of a region's hour that one task sorts, see ``weighted_stats``.
    """
    at, flags = F.lit(now).cast("timestamp_ntz"), list(contract.accepted_quality_flags)
    # cells without an hour can't be placed
    cells = cells.where("observation_hour is not null")
    scans = cells.groupBy("granule_id").agg(F.max("observation_time").alias("observation_time"), F.max("observation_hour").alias("observation_hour"))
    inventory = store.read("granule_inventory", schemas.GRANULE_INVENTORY)
    before = inventory.join(scans.select("granule_id"), "granule_id", "left_semi").where("observation_hour is not null").select("observation_hour")
    # One entry an hour of the micro-batch, and one a band of the grid.
    met = cells.agg(F.collect_set(hour_key(F.col("observation_hour"))).alias("hours"), F.collect_set(band_key(F.col("grid_row"))).alias("bands")).first()
    touched = sorted({*met.hours, *(r.k for r in before.select(hour_key(F.col("observation_hour")).alias("k")).distinct().collect())})
    # Bands that an earlier build didn't count anew are written once in whole, as one version for all of the table is.
    bands = None if store.is_whole("grid_latest") or any(int(k) >= BANDS for k in store.parts("grid_latest")) else sorted(met.bands)
    old = store.read("cells", schemas.GRID_CELLS, touched)
    siblings = old.join(scans.select("granule_id"), "granule_id", "left_anti")
    revision = store.state["revision"] + 1
    kept = store.stage("cells", siblings.unionByName(cells.select(*old.columns)), touched, revision)
    hours = store.read("cells", schemas.GRID_CELLS, touched, kept)
    version = registry.agg(F.max("geometry_version").alias("v")).first().v
    batch = region_hours(hours, weights, registry, flags, limit).withColumns({"geometry_version": F.lit(version), "ingested_at": at, "revision": F.lit(revision).cast("long")})
    columns = store.read("region_hour_aggregates", schemas.REGION_HOURS, []).columns
    aggregates = store.stage("region_hour_aggregates", batch.select(*columns), touched, revision)
    newer = newest(store.read("grid_latest", schemas.GRID_LATEST, bands), latest_batch(cells, weights, registry, flags, at), ["grid_row", "grid_col"], ["observation_time", "ingested_at"])
    latest = store.stage("grid_latest", newer, bands, revision, band_key(F.col("grid_row")))
    ledger = mark(inventory, scans, at, clear_error=True, download_status="downloaded", validation_status="validated", processing_status="processed")
    store.commit({"granule_inventory": ledger}, revision, {"cells": kept, "region_hour_aggregates": aggregates, "grid_latest": latest})
    return revision


def replace_registry(store: Store, registry: DataFrame) -> int:
    """Put a whole registry in place of the last one; returns its rows.

    It must have rows of one geometry version, with regions that are not repeated.  Another version than that of
    the region-hours that are there is refused: they would belong to other shapes.
    """
    found = registry.agg(F.count("*").alias("n"), F.countDistinct("canonical_region_id").alias("ids"), F.min("geometry_version").alias("low"), F.max("geometry_version").alias("high")).first()
    if not found.n or found.low != found.high or found.ids != found.n:
        raise ValueError("a registry needs rows of one geometry version, one a region")
    there = store.read("region_hour_aggregates", schemas.REGION_HOURS).where(F.col("geometry_version") != found.low)
    if not there.isEmpty():
        raise ValueError(f"region-hours of another geometry version than {found.low} are there")
    store.commit({"region_registry": registry.select(*[f.name for f in schemas.REGION_REGISTRY.fields])})
    return found.n


def require_geography(registry: DataFrame, weights: DataFrame) -> str:
    """The geometry version that registry and weights share; an error if one is empty or they differ."""
    low, high = F.min("geometry_version"), F.max("geometry_version")
    ours, theirs = tuple(registry.agg(low, high).first()), tuple(weights.agg(low, high).first())
    if None in ours or None in theirs:
        raise ValueError("scans need a region registry and grid weights; load them first")
    if len({*ours, *theirs}) > 1:
        raise ValueError(f"registry and weights have geometry versions {sorted({*ours, *theirs})}")
    return ours[0]


def ingest_some(store: Store, granules: Iterable[tuple[str, Callable[[], DataFrame]]], weights: DataFrame, registry: DataFrame, contract: schemas.Contract, now: dt.datetime) -> tuple[list[str], dict[str, str]]:
    """Decode and ingest one granule after the other: the ids of those that are in, and the errors of the others.

    A granule that fails is recorded in the ledger with its error (also one that the ledger didn't know), its part of
    the state stays as it was, and the others go on.
    """
    require_geography(registry, weights)
    done, failed = [], {}
    for granule_id, decode in granules:
        try:
            cells = decode()
            strange = cells.where(F.col("granule_id") != granule_id)
            if not strange.isEmpty():
                raise ValueError("the scan holds cells of another granule")
            ingest(store, one_hour(cells), weights, registry, contract, now)
            done.append(granule_id)
        except Exception as e:  # recorded, and told by the caller
            failed[granule_id] = f"{type(e).__name__}: {e}"[:2000]
            ledger = store.read("granule_inventory", schemas.GRANULE_INVENTORY)
            one = store.spark.createDataFrame([(granule_id,)], "granule_id string")
            store.commit({"granule_inventory": mark(ledger, one, F.lit(now).cast("timestamp_ntz"), processing_status="failed", error_message=failed[granule_id])})
    return done, failed


def tell_failures(done: list[str], failed: dict[str, str]) -> None:
    """An error that names what failed, so that a scheduler runs it again; nothing if all went well."""
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(failed) + len(done)} granules failed: " + "; ".join(f"{k}: {v[:200]}" for k, v in list(failed.items())[:20]))


def ingest_each(store: Store, granules: Iterable[tuple[str, Callable[[], DataFrame]]], weights: DataFrame, registry: DataFrame, contract: schemas.Contract, now: dt.datetime) -> list[str]:
    """``ingest_some`` that raises an error at the end if any granule failed; returns the ids of those that are in."""
    done, failed = ingest_some(store, granules, weights, registry, contract, now)
    tell_failures(done, failed)
    return done


def prune_files(store: Store, root: str, now: dt.datetime, days: int) -> list[str]:
    """Delete the files of granules that were processed more than ``days`` ago; their ids.

    Only files below ``root`` are touched, whatever the ledger says; others, and ``root`` itself, are an error before any is deleted.
    The ledger then knows no local path of them; a file that is gone already counts as deleted.
    """
    ledger = store.read("granule_inventory", schemas.GRANULE_INVENTORY)
    at = F.lit(now).cast("timestamp_ntz")
    old = prunable(ledger, at, days).select("granule_id", "local_path").collect()  # one row a file
    base = posixpath.normpath(locate(root)[1])
    outside = [r.local_path for r in old if not posixpath.normpath(locate(r.local_path)[1]).startswith(base.rstrip("/") + "/")]
    if outside:
        raise ValueError(f"files outside {root} are not deleted: {', '.join(outside[:5])}")
    for row in old:
        system, path = locate(row.local_path)
        if system.get_file_info(path).is_file:
            system.delete_file(path)
    if old:
        gone = store.spark.createDataFrame([(r.granule_id,) for r in old], "granule_id string")
        joined = ledger.join(gone.withColumn("_gone", F.lit(True)), "granule_id", "left")
        change = {"local_path": F.lit(None).cast("string"), "updated_at": at}
        store.commit({"granule_inventory": joined.select(*[F.when(F.col("_gone"), change[c]).otherwise(F.col(c)).alias(c) if c in change else c for c in ledger.columns])})
    return [r.granule_id for r in old]


def siblings_restored(cells: DataFrame, sibling: DataFrame, digest: str, expected: str | None) -> DataFrame:
    """A scan with a sibling of its hour that was read back from an archive.

    The sibling's file digest must be known and equal, and it must be of the same hour.
    """
    if not expected or digest != expected:
        raise ValueError("a restored scan needs the checksum that the ledger has")
    return one_hour(cells.unionByName(sibling))


def publish(store: Store, registry: DataFrame, contract: schemas.Contract, full_refresh: bool = False) -> int:
    """Bring hourly history and anomalies up to date; returns the number of region-hours recomputed.

    An incremental run takes hours above the published revision (all after a change of the
    contract) and the anomalies within the baseline days behind them; other hours are neither read nor
    written.  Where a fifth or more of the region-hours in reach changed, all of those hours are
    computed by the window of a full refresh, else only what is affected, by a join; the result is the
    same.  As in any keyed merge, rows that vanished from a replaced hour stay until a full refresh.
    """
    state, days = store.state, dt.timedelta(days=contract.anomaly_baseline_days)
    done = state.get("published_revision", 0) if contract.contract_version == state.get("contract_version") and not full_refresh else 0
    news = [k for k, (_, revision) in store.parts("region_hour_aggregates").items() if revision > done]
    notes = {"published_revision": state["revision"], "contract_version": contract.contract_version}
    if not news and not full_refresh:
        store.commit({}, **notes)
        return 0
    fresh = models.region_hourly(store.read("region_hour_aggregates", schemas.REGION_HOURS, news), registry, contract)
    old = store.read("region_hourly", HOURLY, [] if full_refresh else news)
    hourly = store.stage("region_hourly", upsert(old, fresh.select(*old.columns), models.KEY), None if full_refresh else news, state["revision"])
    changed = store.read("region_hourly", HOURLY, news, hourly).where(F.col("revision") > done)
    first, last = (dt.datetime.strptime(f(news, default="2000010100"), "%Y%m%d%H") for f in (min, max))
    key = lambda t: t.strftime("%Y%m%d%H")
    reach = [k for k in hourly if key(first) <= k <= key(last + days)]
    rows = store.read("region_hourly", HOURLY, [k for k in hourly if key(first - days) <= k <= key(last + days)], hourly)
    count = changed.count()
    if done == 0 or count * 5 >= store.read("region_hourly", HOURLY, reach, hourly).count():
        updates = models.region_anomalies(rows, contract).where(F.col("observation_hour") >= F.lit(first).cast("timestamp_ntz"))
    else:
        redo = models.affected(store.read("region_hourly", HOURLY, reach, hourly), changed, contract)
        reach = [r.k for r in redo.select(hour_key(F.col("observation_hour")).alias("k")).distinct().collect()]  # one row an hour
        updates = models.region_anomalies(rows, contract, redo)
    before = store.read("region_anomalies", ANOMALIES, [] if full_refresh else reach)
    anomalies = store.stage("region_anomalies", upsert(before, updates.select(*before.columns), models.KEY), None if full_refresh else reach, state["revision"])
    store.commit({}, None, {"region_hourly": hourly, "region_anomalies": anomalies}, **notes)
    return count


def views(spark: SparkSession, store: Store, scope: schemas.Scope, registry: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The marts as temp views named ``<scope>_<relation>``; lazy DataFrames over the state."""
    hourly, contract = store.read("region_hourly", HOURLY), scope.contract
    found = {
        "region_hourly": models.mart_region_hourly(hourly),
        "region_latest": models.mart_region_latest(hourly, as_of),
        "country_hourly": models.mart_country_hourly(hourly),
        "region_anomalies": models.mart_region_anomalies(store.read("region_anomalies", ANOMALIES)),
        "grid_latest": models.mart_grid_latest(store.read("grid_latest", schemas.GRID_LATEST)),
        "region_registry": models.mart_region_registry(registry),
        "data_quality": models.data_quality(hourly, contract, as_of),
        "granule_observability": models.granule_observability(store.read("granule_inventory", schemas.GRANULE_INVENTORY)),
    }
    for name, df in found.items():
        df.createOrReplaceTempView(f"{scope.name}_{name}")
    return found
