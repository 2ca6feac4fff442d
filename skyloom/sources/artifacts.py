"""Registry and weight artifacts: checked, content-addressed generations behind a manifest, and file digests."""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.operators.checks import unsorted
from skyloom.sources.files import Part, locate

WEIGHT_ORDER = ["canonical_region_id", "grid_row", "grid_col"]
VALUE_LIMIT, CHUNK = 256 << 20, 8 << 20
MANIFEST = "number long, build_id string, name string, rows long, metadata string"


def _streamed(batches):
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with Part(path) as part:
                for at in range(0, part.size, CHUNK):
                    digest.update(part.read(at, min(CHUNK, part.size - at)))
            out.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(out)], names=["path", "length", "sha256"])


def file_digests(spark: SparkSession, path: str, pattern: str = "*", value_limit: int = VALUE_LIMIT) -> DataFrame:
    """path, length and SHA-256 of the files under ``path``.

    Files up to ``value_limit`` bytes are hashed as values; larger ones, which no value could hold, are read in
    chunks by the task that hashes them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    small = files.where(F.col("length") <= value_limit).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > value_limit).select("path", "length").repartition("path")
    return small.unionByName(large.mapInArrow(_streamed, "path string, length long, sha256 string"))


def source_manifest(path: str) -> dict:
    """A manifest of pinned sources; an error if it is incomplete or a digest isn't one."""
    system, at = locate(path)
    with system.open_input_stream(at) as f:
        found = json.loads(f.read())
    if not {"manifest_version", "geometry_version", "sources"} <= found.keys():
        raise ValueError("the manifest of sources is incomplete")
    for source in found["sources"]:
        lacking = [k for k in ("id", "version", "url", "filename", "sha256", "attribution", "license") if k not in source]
        if lacking:
            raise ValueError(f"the source {source.get('id', 'without an id')} lacks {', '.join(lacking)}")
        if not re.fullmatch(r"[0-9a-f]{64}", source["sha256"]):
            raise ValueError(f"the source {source['id']} has no valid SHA-256")
    return found


def verify_sources(spark: SparkSession, manifest: dict, folder: str, value_limit: int = VALUE_LIMIT) -> dict[str, str]:
    """id -> path of a manifest's sources in ``folder``; an error names those that are missing or have another digest."""
    there = {r.path.rsplit("/", 1)[-1]: r for r in file_digests(spark, folder, value_limit=value_limit).collect()}  # one row a pinned file
    bad = []
    for source in manifest["sources"]:
        row = there.get(source["filename"])
        if row is None:
            bad.append(f"{source['id']} is missing")
        elif row.sha256 != source["sha256"]:
            bad.append(f"{source['id']} has the digest {row.sha256}")
    if bad:
        raise ValueError("sources can't be used: " + "; ".join(bad))
    return {s["id"]: there[s["filename"]].path for s in manifest["sources"]}


def canonical(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in total order over all files: ranges of the keys, each sorted in its task."""
    return df.orderBy(*order)


def row_digest(df: DataFrame) -> str:
    """A digest of the rows as a set with repeats, whatever their order: a sum of row hashes in two parts, and the count."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)"))
    found = df.agg(F.count("*"), part(0), part(1), part(2), part(3)).first()
    return hashlib.sha256("|".join(map(str, found)).encode()).hexdigest()


def publish_artifact(df: DataFrame, root: str, name: str, order: list[str], metadata: dict | None = None) -> str:
    """Write an immutable generation of ``df`` in canonical order and point the manifest to it; its build id.

    The id comes from name, columns, rows and metadata, so equal content is written once.  The
    generation is read back (count and order) before the manifest names it; the manifest's highest number counts.
    """
    spark, rows = df.sparkSession, df.count()
    identity = {"name": name, "columns": df.dtypes, "rows": rows, "digest": row_digest(df), "metadata": metadata or {}}
    build = hashlib.sha256(json.dumps(identity, sort_keys=True).encode()).hexdigest()[:20]
    folder = f"{root.rstrip('/')}/{name}"
    known = _manifest(spark, folder)
    if known is None or known.build_id != build:
        canonical(df, order).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{build}")
        back = spark.read.parquet(f"{folder}/{build}")
        if back.count() != rows:
            raise ValueError(f"{name}: {rows} rows were to be written, {back.count()} are there")
        if not unsorted(back, order[:1]).isEmpty():
            raise ValueError(f"{name} is not in the order of {order[0]}")
        number = 1 + (known.number if known else 0)
        entry = spark.createDataFrame([(number, build, name, rows, json.dumps(metadata or {}, sort_keys=True))], MANIFEST)
        entry.coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return build


def _manifest(spark: SparkSession, folder: str):
    try:
        return spark.read.schema(MANIFEST).json(f"{folder}/manifest").agg(F.max_by(F.struct("*"), "number").alias("m")).first().m
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def read_artifact(spark: SparkSession, root: str, name: str, schema=None) -> tuple[DataFrame, dict]:
    """(rows, metadata) of the current generation; an error if there is none."""
    folder = f"{root.rstrip('/')}/{name}"
    found = _manifest(spark, folder)
    if found is None:
        raise ValueError(f"no generation of {name} has been published under {root}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{found.build_id}"), json.loads(found.metadata)


def read_weights(spark: SparkSession, root: str, grid_version: str | None = None) -> tuple[DataFrame, str]:
    """(weights, grid version); an error if columns are missing, the grid is another one than ``grid_version``, or cells repeat within a region.

    A weight that isn't positive and finite, or has no region or cell, raises an error where it is read.
    """
    rows, metadata = read_artifact(spark, root, "weights")
    lacking = set(schemas.GRID_WEIGHTS.fieldNames()) - set(rows.columns)
    if lacking:
        raise ValueError(f"weights lack the columns {', '.join(sorted(lacking))}")
    version = metadata.get("grid_version", "synthetic")
    if grid_version not in (None, version):
        raise ValueError(f"weights are of the grid {version}, not {grid_version}")
    twice = rows.groupBy(*WEIGHT_ORDER).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"weights repeat the cell {tuple(twice[0])[:3]}")
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.GRID_WEIGHTS.fields])
    w = F.col("overlap_weight")
    bad = ~F.coalesce((w > 0) & (w < float("inf")) & F.col("canonical_region_id").isNotNull() & F.col("grid_row").isNotNull() & F.col("grid_col").isNotNull(), F.lit(False))
    checked = F.when(bad | F.isnan(w), F.raise_error(F.lit("a weight must be positive and have a region"))).otherwise(w)
    return rows.withColumn("overlap_weight", checked), version


def read_registry(spark: SparkSession, root: str, loaded_at: Column) -> DataFrame:
    rows, _ = read_artifact(spark, root, "registry", schemas.REGION_REGISTRY)
    return rows.withColumn("loaded_at", loaded_at)
