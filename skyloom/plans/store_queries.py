"""Registered queries over the whole path: a ``Store``, ``discover``, ``ingest``, ``publish`` and the published views.

The scans are events of customers, one scan an event type and day.  They come in two deliveries: days up to 20 without the
clicks of day 10, then the later days with those clicks, late.  Every query builds a store of its own in the shared folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.functions import exprs
from skyloom.operators.steps import shared_folder
from skyloom.plans import models, pipeline, relations
from skyloom.plans.registry import AS_OF, DIGITS, LOW, ZONES, hierarchy, query, rounded, table
from skyloom.plans.registry import _ANOMALY_DIGITS, _PIXELS, _STATS, _TREE
from skyloom.plans.state import Store

NOON = "date_trunc('day', ts) + interval 12 hour"
LATE = "day(ts) > 20 or (day(ts) = 10 and event_type = 'click')"
DELIVERED = dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 31)


def scans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The cells of the two deliveries."""
    cells = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.date_format("ts", "-yyyyMMdd")).alias("granule_id"),
        F.col("ts").cast("timestamp_ntz").alias("observation_time"),
        F.expr(NOON).cast("timestamp_ntz").alias("observation_hour"),
        F.col("user_id").cast("int").alias("grid_row"),
        F.lit(0).alias("grid_col"),
        F.col("value").alias("no2"),
        F.when(F.col("event_type") == "error", 2).otherwise(0).alias("quality_flag"),
        exprs.cell_latitude(F.col("user_id") % exprs.GRID_ROWS).alias("latitude"),
        F.lit(exprs.GRID_LON0).alias("longitude"),
        F.coalesce(F.expr(LATE), F.lit(False)).alias("_late"),
    )
    return cells.where("not _late").drop("_late"), cells.where("_late").drop("_late")


def geography_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Weights and registry of customers in counties, states and countries."""
    _, weights, regions = hierarchy(spark, sf_dir)
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.crc32(F.col("country_code").cast("binary")) % 4 + 1).cast("int"))
    parent = F.when(F.col("region_type") != "country", F.col("country_code"))
    registry = regions.select(
        "country_code", "region_type", F.expr("substr(canonical_region_id, 2)").alias("source_region_id"), "canonical_region_id", F.concat(F.lit("Region "), "canonical_region_id").alias("region_name"), parent.alias("parent_region_id"),
        zone.alias("timezone"), F.lit("v1").alias("geometry_version"), F.sha2("canonical_region_id", 256).alias("geometry_checksum"), F.lit(AS_OF).cast("timestamp_ntz").alias("loaded_at"),
    )
    return weights, registry


def filled(spark: SparkSession, sf_dir: str, published: bool = True) -> tuple[Store, dict[str, DataFrame]]:
    """A store after both deliveries, each discovered, ingested and (if ``published``) published; its views."""
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    weights, registry = geography_tables(spark, sf_dir)
    pipeline.replace_registry(store, registry)
    registry = store.read("region_registry", schemas.REGION_REGISTRY)
    null = lambda t: F.lit(None).cast(t)
    for cells, at in zip(scans(spark, sf_dir), DELIVERED):
        found = cells.groupBy("granule_id").agg(F.min("observation_time").alias("acquisition_start"), F.max("observation_time").alias("acquisition_end"))
        pipeline.discover(store, found.withColumns({"concept_id": F.lit("events"), "download_url": null("string"), "cmr_revision_at": null("timestamp_ntz")}), at - dt.timedelta(minutes=90))
        pipeline.ingest(store, cells, weights, registry, LOW, at)
        if published:
            pipeline.publish(store, registry, LOW)
    return store, pipeline.views(spark, store, schemas.scope("no2"), registry, AS_OF)


_DAILY = _TREE.replace("date_trunc('hour', ts)", NOON)
_OF_STORE = f"{_DAILY}, first as (select distinct observation_hour from (select {NOON} as observation_hour from events where {LATE}))"


@query(
    f"""with {_OF_STORE} select observation_hour, canonical_region_id, country_code, region_type, {_STATS}, {_PIXELS}, cast(case when first.observation_hour is null then 1 else 2 end as bigint) as revision, is_analysis_ready
    from hourly left join first using (observation_hour) where region_type <> 'country'"""
)
def store_region_hourly(spark, sf_dir):
    """Deliveries with a late scan, published one after the other, in the view of region-hours."""
    _, found = filled(spark, sf_dir)
    columns = ["observation_hour", "canonical_region_id", "country_code", "region_type", *DIGITS, "valid_pixel_count", "total_pixel_count", "valid_area_km2", "total_area_km2", "quality_flag_accepted", "source_granule_count", "revision", "is_analysis_ready"]
    return rounded(found["region_hourly"].select(*columns), **DIGITS)


_SHIFT = 1.23e-8  # medians of daily means often end in an exact half of the last digit, which not every engine rounds alike
_PRIOR = "p.canonical_region_id = c.canonical_region_id and p.is_analysis_ready and p.observation_hour >= c.observation_hour - interval 28 day and p.observation_hour < c.observation_hour"


@query(
    f"""with {_DAILY}, base as (select c.canonical_region_id, c.observation_hour, c.no2_mean, c.is_analysis_ready, count(p.no2_mean) as n, median(p.no2_mean) as mid, mad(p.no2_mean) as mad from hourly c left join hourly p on {_PRIOR} group by all)
    select canonical_region_id, observation_hour, round(no2_mean + {_SHIFT}, 6) as no2_mean, n as baseline_sample_count, round(mid + {_SHIFT}, 6) as baseline_median, round(mad + {_SHIFT}, 6) as baseline_mad, is_analysis_ready,
      round(no2_mean - mid + {_SHIFT}, 6) as no2_difference, round(case when is_analysis_ready and n >= 7 and mad <> 0 then (no2_mean - mid) / (1.4826 * mad) end + {_SHIFT}, 6) as robust_z_score from base"""
)
def store_anomalies(spark, sf_dir):
    """Anomalies of an incremental publish on a store; a late scan changes the days behind it too."""
    _, found = filled(spark, sf_dir)
    shifted = found["region_anomalies"].drop("timezone", "local_observation_hour").withColumns({c: F.col(c) + _SHIFT for c in _ANOMALY_DIGITS})
    return rounded(shifted, **_ANOMALY_DIGITS)


@query(
    """with seen as (select *, row_number() over (partition by user_id order by ts desc) as rn from events where exists (select 1 from customer where c_custkey = user_id))
    select cast(user_id as integer) as grid_row, ts as observation_time, case when isfinite(value) then value end as no2, event_type || strftime(ts, '-%Y%m%d') as granule_id, event_type <> 'error' as quality_flag_accepted,
      event_type <> 'error' and coalesce(isfinite(value), false) as is_analysis_ready,
      round(power(6371.0088::double, 2) * radians(0.02::double) * abs(sin(radians(14.02::double + (user_id % 2950) * 0.02::double)) - sin(radians(14.0::double + (user_id % 2950) * 0.02::double))), 6) as cell_area_km2
    from seen where rn = 1"""
)
def store_grid_latest(spark, sf_dir):
    """The newest cell values of a store after both deliveries, kept by band of grid rows."""
    _, found = filled(spark, sf_dir, published=False)
    return rounded(found["grid_latest"].select("grid_row", "observation_time", "no2", "granule_id", "quality_flag_accepted", "is_analysis_ready", "cell_area_km2"), cell_area_km2=6)


@query(
    f"""select event_type || strftime(ts, '-%Y%m%d') as granule_id, min(ts) as acquisition_start, max(ts) as acquisition_end, max(ts) as observation_time, any_value({NOON}) as observation_hour, 'processed' as processing_status,
      case when bool_or({LATE}) then timestamp '2024-01-30 22:30:00' else timestamp '2024-01-20 22:30:00' end as discovered_at, cast(90 as bigint) as processing_latency_minutes from events group by 1"""
)
def store_granules(spark, sf_dir):
    """The ledger of both deliveries with the minutes from discovery to processing."""
    _, found = filled(spark, sf_dir, published=False)
    return found["granule_observability"].select("granule_id", "acquisition_start", "acquisition_end", "observation_time", "observation_hour", "processing_status", "discovered_at", "processing_latency_minutes")


@query(
    """with p as (select c_mktsegment, n_nationkey, r_regionkey, 'C' || r_regionkey as c from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
    ids as (select distinct c as country_code, 'country' as region_type, c as canonical_region_id from p union select distinct c, 'state', 'S' || n_nationkey from p union select distinct c, 'county', 'M' || n_nationkey || '-' || c_mktsegment from p)
    select country_code, region_type, substr(canonical_region_id, 2) as source_region_id, canonical_region_id, 'Region ' || canonical_region_id as region_name, case when region_type <> 'country' then country_code end as parent_region_id,
      'v1' as geometry_version, sha256(canonical_region_id) as geometry_checksum, timestamp '2024-01-31 00:00:00' as loaded_at from ids"""
)
def store_registry(spark, sf_dir):
    """The registry that a store took in whole, through its staging relation."""
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    pipeline.replace_registry(store, geography_tables(spark, sf_dir)[1])
    staged = relations.staging_views(store, schemas.scope("no2"))["region_registry"]
    return models.mart_region_registry(staged).drop("timezone")


@query(
    """with c as (select c_nationkey, (c_custkey * 7) % 2950 as r, (c_custkey * 13) % 7750 as k from customer),
    placed as (select c_nationkey, 14.01::double + r * 0.02::double as lat, -167.99::double + k * 0.02::double as lon from c),
    sized as (select *, round(power(6371.0088::double, 2) * radians(0.02::double) * abs(sin(radians(lat + 0.01::double)) - sin(radians(lat - 0.01::double))), 6) as area from placed)
    select n_name, count(*) as cells, round(sum(area), 3) as area_km2, round(min(lat), 9) as south, round(max(lat), 9) as north, round(min(lon), 9) as west, round(max(lon), 9) as east from sized join nation on c_nationkey = n_nationkey group by 1"""
)
def cells_of_customers(spark, sf_dir):
    """Grid cells of customers, their centres and areas, by nation."""
    key, lat = F.col("c_custkey"), exprs.cell_latitude(F.col("r"))
    c = table(spark, sf_dir, "customer").select("c_nationkey", (key * 7 % exprs.GRID_ROWS).alias("r"), (key * 13 % exprs.GRID_COLS).alias("k"))
    cells = c.select("c_nationkey", lat.alias("lat"), exprs.cell_longitude(F.col("k")).alias("lon"), F.round(exprs.cell_area_km2(lat), 6).alias("area"))
    box = [F.round(f(c), 9).alias(n) for f, c, n in ((F.min, "lat", "south"), (F.max, "lat", "north"), (F.min, "lon", "west"), (F.max, "lon", "east"))]
    named = cells.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.groupBy("n_name").agg(F.count("*").alias("cells"), F.round(F.sum("area"), 3).alias("area_km2"), *box)
