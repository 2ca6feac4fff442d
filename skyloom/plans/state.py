"""Durable state without a table format: versioned Parquet snapshots behind one pointer.

A commit writes new versions of all changed tables and then one pointer file with the next number,
so several tables move together or not at all.  Tables with hours are kept by hour, that of the latest
cells by band of grid rows: the pointer names the version and revision of each such part, and a commit
writes only the parts that it touches.  Of
two writers that start from one state the second to commit gets a ``Conflict``, and its state stays unseen.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA_VERSION = "2"
KEPT_STATES = 10  # pointer files that ``vacuum`` leaves
BAND_ROWS = 64  # rows of the grid in a part of the latest cells: half a million cells where the grid has 7,750 columns
BANDS = 64  # parts of the latest cells at most: bands of a grid of more than 4,096 rows share them, so that files don't grow in number


class Conflict(RuntimeError):
    """Another writer has committed since the state was read that this commit builds on."""


class Store:
    """Tables under ``root`` (any path that Spark can write); ``pointer`` tells their versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._seen, self._last, self._based = None, None, {}
        state = self._load()
        if state.get("schema_version", SCHEMA_VERSION) != SCHEMA_VERSION:
            raise ValueError(f"{root} has schema version {state['schema_version']}; this build writes {SCHEMA_VERSION}")

    def _pointers(self) -> list[str]:
        return sorted(name for name in self._list(f"{self.root}/pointer") if name.startswith("state-"))

    def _load(self) -> dict:
        """The state of the last pointer file, which alone is read, once (after that a listing, no job)."""
        last = max(self._pointers(), default=None)
        if last != self._seen:
            rows = self.spark.read.schema("version long, state string").json(f"{self.root}/pointer/{last}")
            self._last, self._seen = rows.first().state, last
        return json.loads(self._last) if self._last else {"tables": {}, "revision": 0, "schema_version": SCHEMA_VERSION, "version": 0}

    def _point(self, state: dict) -> None:
        """The commit: a whole file is renamed to the next number, which fails if another writer has taken that."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        line = json.dumps({"version": state["version"], "state": json.dumps(state, sort_keys=True)}) + "\n"
        fs, draft = self._fs(f"{self.root}/pointer/_draft-{uuid.uuid4().hex}")
        _, target = self._fs(f"{self.root}/pointer/state-{state['version']:012d}.json")
        with_line = fs.create(draft, False)
        try:
            with_line.write(bytearray(line.encode()))
        finally:
            with_line.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {state['version']} of {self.root} has been taken by another writer") from e
            raise

    @property
    def state(self) -> dict:
        return self._load()

    def parts(self, table: str) -> dict[str, list]:
        """Part (an hour as yyyyMMddHH, or a band) -> [version, revision] of a table that is kept in parts; one entry a part, no data.

        Empty for a table that is kept whole.
        """
        found = self._load()["tables"].get(table)
        return found if isinstance(found, dict) else {}

    def is_whole(self, table: str) -> bool:
        """Whether the pointer names one version for all of the table, so that parts of it can't be told apart yet."""
        return isinstance(self._load()["tables"].get(table), str)

    def read(self, table: str, schema: StructType | str, parts: list[str] | None = None, staged: dict | None = None) -> DataFrame:
        """The current version of a table, or of some of its parts; empty if it was never written.

        ``staged`` (of ``stage``) takes the place of what the pointer names.
        """
        version = self._load()["tables"].get(table) if staged is None else staged
        if isinstance(version, dict):
            wanted = sorted(version if parts is None else set(parts) & set(version))
            paths = [f"{self.root}/{table}/{version[k][0]}/part={k}" for k in wanted]
            return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return self.spark.createDataFrame([], schema) if version is None else self.spark.read.schema(schema).parquet(f"{self.root}/{table}/{version}")

    def stage(self, table: str, df: DataFrame, touched: list[str] | None, revision: int, part: Column | None = None) -> dict[str, list]:
        """Write the parts ``touched`` (all: None) anew; the table's parts as they are once committed.

        ``part`` names the part of a row, by default its hour.  A part that has no rows in ``df`` goes.  Nothing is
        visible before ``commit``, which fails if another writer commits in between.
        """
        current = self._load()
        self._based[table] = current["version"]
        version = f"v={uuid.uuid4().hex}"
        folder = f"{self.root}/{table}/{version}"
        named = df.withColumn("part", hour_key(F.col("observation_hour")) if part is None else part)
        named.hint("rebalance", "part").write.option("compression", "zstd").partitionBy("part").parquet(folder)
        written = [name.removeprefix("part=") for name in self._list(folder) if name.startswith("part=")]
        before = self.parts(table)
        kept = {} if touched is None else {k: v for k, v in before.items() if k not in set(touched)}
        return kept | {k: [version, revision] for k in written}

    def _fs(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _list(self, folder: str) -> list[str]:
        fs, path = self._fs(folder)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def commit(self, changes: dict[str, DataFrame], revision: int | None = None, staged: dict[str, dict] | None = None, **notes) -> dict:
        """Write new versions of all ``changes``, then move the pointer to them and to what is staged.

        On failure the old state stays visible.
        """
        state = self._load()
        for table in staged or {}:
            if self._based.get(table, state["version"]) != state["version"]:
                raise Conflict(f"{table} was staged on version {self._based[table]}, {self.root} is at {state['version']}")
        if revision is not None and revision <= state["revision"]:
            raise ValueError("revisions must grow")
        for table, df in changes.items():
            version = f"v={uuid.uuid4().hex}"
            df.write.option("compression", "zstd").parquet(f"{self.root}/{table}/{version}")
            state["tables"][table] = version
        state["tables"] |= staged or {}
        state |= notes | {"version": state["version"] + 1}
        if revision is not None:
            state["revision"] = revision
        self._point(state)
        return state

    def vacuum(self) -> int:
        """Delete versions that the pointer no longer names; their number.  Readers of older states must have ended."""
        gone = 0
        for table, current in self._load()["tables"].items():
            named = {v[0] for v in current.values()} if isinstance(current, dict) else {current}
            for name in self._list(f"{self.root}/{table}"):
                if name.startswith("v=") and name not in named:
                    fs, path = self._fs(f"{self.root}/{table}/{name}")
                    gone += bool(fs.delete(path, True))
        for name in self._pointers()[:-KEPT_STATES]:
            fs, path = self._fs(f"{self.root}/pointer/{name}")
            fs.delete(path, False)
        return gone


def hour_key(hour: Column) -> Column:
    return F.date_format(hour, "yyyyMMddHH")


def band_key(row: Column) -> Column:
    """The band of ``BAND_ROWS`` grid rows that a row is in, counted anew after ``BANDS`` of them."""
    return F.lpad(F.pmod(F.floor(row / BAND_ROWS), F.lit(BANDS)).cast("string"), 6, "0")


def one_hour(batch: DataFrame) -> DataFrame:
    """The batch, if it has rows and all are of one hour; else an error."""
    first, last = batch.agg(F.min("observation_hour"), F.max("observation_hour")).first()
    if first is None:
        raise ValueError("a replacement of an hour needs rows")
    if first != last:
        raise ValueError("a replacement of an hour holds several hours")
    return batch


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` in place of rows with their keys; a key that updates repeats raises an error."""
    once = updates.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*updates.columns)).alias("_r"))
    checked = once.select(F.when(F.col("_n") > 1, F.raise_error(F.lit("an update repeats a key"))).otherwise(F.lit(0)).alias("_ok"), "_r.*").where("_ok = 0").drop("_ok")
    return existing.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(checked.select(*existing.columns))


def merge_discovered(inventory: DataFrame, found: DataFrame, now: Column) -> tuple[DataFrame, dict[str, int]]:
    """(ledger with the discovered granules, counts found / inserted / refreshed).

    Known granules take the newer facts but keep their processing state; new ones start as
    discovered and pending.
    """
    total, inserted = found.count(), found.join(inventory, "granule_id", "left_anti").count()
    batch = found.dropDuplicates(["granule_id"]).select([F.col(c).alias(c if c == "granule_id" else f"_{c}") for c in found.columns])
    joined = inventory.join(batch, "granule_id", "full")
    new, hit = F.col("discovery_status").isNull(), F.col("_concept_id").isNotNull()
    columns = {c: F.coalesce(f"_{c}", c) for c in ("concept_id", "acquisition_start", "acquisition_end", "cmr_revision_at", "download_url")}
    columns |= {c: F.when(hit, now).otherwise(F.col(c)) for c in ("last_seen_at", "updated_at")}
    columns |= {c: F.coalesce(c, F.lit("pending")) for c in ("download_status", "validation_status", "processing_status")}
    columns |= {"discovery_status": F.coalesce("discovery_status", F.lit("discovered")), "discovered_at": F.when(new, now).otherwise(F.col("discovered_at"))}
    merged = joined.select(*[columns.get(c, F.col(c)).alias(c) for c in inventory.columns])
    return merged, {"found": total, "inserted": inserted, "refreshed": total - inserted}


def mark(inventory: DataFrame, granules: DataFrame, now: Column, clear_error: bool = False, **values) -> DataFrame:
    """Set the given values of some granules (granule_id, and any columns to take over) and stamp the steps they complete."""
    own = [c for c in granules.columns if c != "granule_id"]
    batch = granules.dropDuplicates(["granule_id"]).select("granule_id", *[F.col(c).alias(f"_{c}") for c in own], F.lit(True).alias("_here"))
    here, kinds = F.coalesce("_here", F.lit(False)), dict(inventory.dtypes)
    changes = {c: F.lit(v) for c, v in values.items() if v is not None} | {c: F.col(f"_{c}") for c in own} | {"updated_at": now}
    for step, done in (("download", "downloaded"), ("validation", "validated"), ("processing", "processed")):
        if values.get(f"{step}_status") == done:
            changes[f"{done}_at"] = now
    if values.get("error_message") is None and clear_error:
        changes["error_message"] = F.lit(None).cast("string")
    joined = inventory.join(batch, "granule_id", "left")
    return joined.select(*[F.when(here, changes[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in inventory.columns])


def replace_hours(existing: DataFrame, batch: DataFrame, revision: int) -> DataFrame:
    """The table with all rows of the batch's hours replaced by the batch, stamped with ``revision``."""
    kept = existing.join(batch.select("observation_hour").distinct(), "observation_hour", "left_anti")
    return kept.unionByName(batch.withColumn("revision", F.lit(revision).cast("long")).select(*existing.columns))


def prunable(inventory: DataFrame, now: Column, days: int) -> DataFrame:
    """Processed granules older than ``days`` whose file is still there."""
    if days < 1:
        raise ValueError("retention needs one day or more")
    return inventory.where(F.col("local_path").isNotNull() & (F.col("processed_at") < now - F.expr(f"interval {days} days")))


def changed_since(aggregates: DataFrame, revision: int, contract_version: str, published_version: str | None) -> DataFrame:
    """Rows newer than the published revision; all rows after a change of the contract."""
    return aggregates if contract_version != (published_version or "") else aggregates.where(F.col("revision") > revision)
