"""Micro-batches of landed scan files into the store, with Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.plans.pipeline import discover, ingest, ingest_some, tell_failures
from skyloom.plans.state import Store, mark


def ingest_stream(spark: SparkSession, landing: str, checkpoint: str, store: Store, weights: DataFrame, registry: DataFrame, contract: schemas.Contract, clock: Callable[[], dt.datetime] | None = None, max_files: int = 200):
    """Take in all scan files that have landed since the last run, then stop.

    Late scans are not dropped by a watermark: a scan for an old hour recomputes that hour.  The
    checkpoint makes delivery at-least-once, and a replayed batch gives the same state.  A
    micro-batch takes ``max_files`` files at most, so a backlog is worked off in bounded steps.
    """
    clock = clock or (lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None))

    def take(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ingest(store, batch, weights, registry, contract, clock())

    cells = spark.readStream.schema(schemas.GRID_CELLS).option("maxFilesPerTrigger", max_files).parquet(landing)
    query = cells.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def granule_of(path: str) -> str:
    """The name of a file without its last ending."""
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def _take_files(store: Store, paths: list[str], decode: Callable[[str], DataFrame], weights: DataFrame, registry: DataFrame, contract: schemas.Contract, now: dt.datetime) -> tuple[list[str], dict[str, str]]:
    named = store.spark.createDataFrame([(granule_of(p), p) for p in sorted(paths)], "granule_id string, local_path string")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("acquisition_start", "timestamp_ntz"), ("acquisition_end", "timestamp_ntz"), ("download_url", "string"), ("cmr_revision_at", "timestamp_ntz"))]
    discover(store, named.select("granule_id", F.lit("landed").alias("concept_id"), *blank), now)
    ledger = store.read("granule_inventory", schemas.GRANULE_INVENTORY)
    store.commit({"granule_inventory": mark(ledger, named, F.lit(now).cast("timestamp_ntz"), download_status="downloaded")})
    return ingest_some(store, [(granule_of(p), lambda p=p: decode(p)) for p in sorted(paths)], weights, registry, contract, now)


def ingest_files_stream(spark: SparkSession, landing: str, checkpoint: str, store: Store, decode: Callable[[str], DataFrame], weights: DataFrame, registry: DataFrame, contract: schemas.Contract, clock: Callable[[], dt.datetime] | None = None, pattern: str = "*.nc", max_files: int = 20) -> list[str]:
    """Take in all files that have landed since the last run, each by ``decode(path)``; the ids of those that are in.

    A file that can't be decoded or ingested doesn't hold up its micro-batch: it stands in the ledger as failed, with its
    error and its path, and the others go on.  When all files have been tried, an error names the failures.  The stream
    is past them then; ``retry_failed`` takes them up from the ledger.  A batch is a list of ``max_files`` paths at most.
    """
    clock = clock or (lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None))
    done: list[str] = []
    failed: dict[str, str] = {}

    def take(batch: DataFrame, _: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]
        if paths:
            good, bad = _take_files(store, paths, decode, weights, registry, contract, clock())
            done.extend(good)
            failed.update(bad)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).load(landing)
    query = files.select("path").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    tell_failures(done, failed)
    return done


def retry_failed(store: Store, decode: Callable[[str], DataFrame], weights: DataFrame, registry: DataFrame, contract: schemas.Contract, now: dt.datetime, most: int = 1000) -> list[str]:
    """Try the ledger's failed files again, the oldest first; the ids of those that are in, and an error for those that still fail."""
    ledger = store.read("granule_inventory", schemas.GRANULE_INVENTORY)
    rows = ledger.where("processing_status = 'failed' and local_path is not null").orderBy("discovered_at", "granule_id").limit(most).select("granule_id", "local_path").collect()
    done, failed = ingest_some(store, [(r.granule_id, lambda p=r.local_path: decode(p)) for r in rows], weights, registry, contract, now)
    tell_failures(done, failed)
    return done
