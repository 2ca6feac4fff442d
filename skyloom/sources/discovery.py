"""Catalog records to granule rows, contracts from CSV, and simple table scans."""

from __future__ import annotations

import csv
import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.schemas import GRANULE_INVENTORY, Contract

# The layout of a catalog record; every field may be missing.
RECORD = (
    "meta struct<`native-id`:string,`concept-id`:string,GranuleUR:string,granule_ur:string,`revision-date`:string,revision_date:string>,"
    "umm struct<GranuleUR:string,TemporalExtent:struct<RangeDateTime:struct<BeginningDateTime:string,EndingDateTime:string>,SingleDateTime:string>>,"
    "GranuleUR string, granule_ur string, id string, time_start string, time_end string, updated string, links array<string>, data_links array<string>"
)


def window(lookback_hours: int | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None, now: dt.datetime | None = None) -> tuple[str, str]:
    """The search window as ISO strings: an explicit pair, or the hours before now."""
    if (start is None) != (end is None):
        raise ValueError("a window needs both its start and its end")
    if start is None:
        now = now or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        start, end = now - dt.timedelta(hours=lookback_hours or 24), now
    if end <= start:
        raise ValueError("a window must end after its start")
    return start.strftime("%Y-%m-%dT%H:%M:%SZ"), end.strftime("%Y-%m-%dT%H:%M:%SZ")


def utc(text: Column) -> Column:
    """An ISO-8601 string as naive UTC; null if it can't be read."""
    return F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz"))


def preferred_url(urls: Column) -> Column:
    """The first link to a gridded file, else the first link."""
    clean = F.filter(F.transform(F.coalesce(urls, F.array()), F.trim), lambda u: u != "")
    gridded = F.filter(clean, lambda u: F.lower(F.get(F.split(u, r"[?#]"), F.lit(0))).rlike(r"\.(nc|nc4|netcdf)$"))
    return F.coalesce(F.get(gridded, F.lit(0)), F.get(clean, F.lit(0)))


def normalise(records: DataFrame, concept_id: str) -> DataFrame:
    """granule_id, concept_id, acquisition_start, acquisition_end, download_url, cmr_revision_at.

    A record without any identifier raises an error.
    """
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    name = F.coalesce(*[text(c) for c in ("meta.native-id", "meta.concept-id", "meta.GranuleUR", "meta.granule_ur", "umm.GranuleUR", "GranuleUR", "granule_ur", "id")])
    extent = "umm.TemporalExtent"
    # A string or an object; an object that is read as a string is its JSON text.
    inner = lambda c, path: F.when(c.startswith("{"), F.get_json_object(c, path)).otherwise(c)
    single = utc(inner(F.col(f"{extent}.SingleDateTime"), "$.Time"))
    own = lambda c: F.when(F.size(c) > 0, F.col(c))
    links = F.transform(F.coalesce(own("links"), own("data_links")), lambda x: inner(x, "$.href"))
    return records.select(
        F.coalesce(name, F.raise_error(F.lit("catalog record without an identifier"))).alias("granule_id"),
        F.lit(concept_id).alias("concept_id"),
        F.coalesce(*[utc(F.col(c)) for c in (f"{extent}.RangeDateTime.BeginningDateTime",)], single, utc(F.col("time_start"))).alias("acquisition_start"),
        F.coalesce(*[utc(F.col(c)) for c in (f"{extent}.RangeDateTime.EndingDateTime",)], single, utc(F.col("time_end"))).alias("acquisition_end"),
        preferred_url(links).alias("download_url"),
        F.coalesce(*[utc(F.col(c)) for c in ("meta.revision-date", "meta.revision_date", "updated")]).alias("cmr_revision_at"),
    )


def as_records(spark: SparkSession, found: list[dict]) -> DataFrame:
    """Records of a search as rows; a page of a search is small."""
    rows = spark.createDataFrame([(json.dumps(r, default=str),) for r in found], "value string")
    return rows.select(F.from_json("value", RECORD).alias("r")).select("r.*")


def discover(spark: SparkSession, search: Callable[[str, str, str], list[dict]], concept_id: str, **bounds) -> DataFrame:
    """Runs the injected search for a window and normalises what it finds."""
    return normalise(as_records(spark, search(concept_id, *window(**bounds))), concept_id)


def discover_manifest(spark: SparkSession, path: str, concept_id: str) -> DataFrame:
    """The same from a JSON-lines manifest, without a network."""
    return normalise(spark.read.schema(RECORD).json(path), concept_id)


def read_contract(path: str) -> Contract:
    """The one ``default`` row of a contract CSV; missing columns and bad values raise an error."""
    with open(path, newline="") as f:
        rows = [r for r in csv.DictReader(f) if r.get("contract_key") == "default"]
    if len(rows) != 1:
        raise ValueError("a contract needs exactly one default row")
    row = rows[0]
    numbers = ("stale_hours_warn", "stale_hours_error", "anomaly_baseline_days", "anomaly_min_baseline_samples")
    flags = tuple(int(x) for x in row["accepted_quality_flags"].replace(",", "|").split("|"))
    return Contract(row["contract_version"], float(row["min_region_coverage"]), *[int(row[c]) for c in numbers], flags)


def pending(inventory: DataFrame, most: int | None = None) -> DataFrame:
    """Granules with a pending or failed step, oldest discovery first."""
    open_steps = [F.col(c).isin("pending", "failed") for c in ("download_status", "validation_status", "processing_status")]
    rows = inventory.where(open_steps[0] | open_steps[1] | open_steps[2]).select("granule_id", "download_url", "discovered_at")
    rows = rows.orderBy("discovered_at", "granule_id")
    return rows if most is None else rows.limit(most)


def empty_inventory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], GRANULE_INVENTORY)
