"""The registered queries on the driver's tables, each with its DuckDB oracle where SQL can express it.

Two adapters give the shapes of gridded observations: ``simple`` (events in eight regions) and
``hierarchy`` (events of customers in counties, states and countries).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import exprs
from skyloom.operators import checks, geography, kernel
from skyloom.plans import models, relations
from skyloom.plans.state import changed_since, merge_discovered, replace_hours, upsert
from skyloom.schemas import Contract
from skyloom.sources.discovery import pending

AS_OF = dt.datetime(2024, 1, 31)
CONTRACT = Contract(min_region_coverage=0.25, anomaly_min_baseline_samples=7)
LOW = Contract(min_region_coverage=0.01)
ZONES = ["America/Los_Angeles", "America/Toronto", "America/Mexico_City", "America/St_Johns"]

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- adapters -------------------------------------------------------------------------------


def simple_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        exprs.hour_of(F.col("ts")).alias("observation_hour"),
        F.concat(F.lit("R"), (F.col("user_id") % 8).cast("string")).alias("canonical_region_id"),
        F.col("event_type").alias("granule_id"),
        F.col("value"),
        (1 + F.col("event_id") % 4).alias("weight"),
        ((F.col("event_type") != "error") & exprs.finite(F.col("value"))).alias("ok"),
        F.col("event_id"),
    )


def simple_hours(cells: DataFrame) -> DataFrame:
    keys = ["observation_hour", "canonical_region_id"]
    total = cells.groupBy(*keys).agg(F.count("*").alias("total_pixel_count"), F.sum("weight").cast("double").alias("total_area_km2"), F.countDistinct("granule_id").cast("int").alias("source_granule_count"))
    out = total.join(kernel.weighted_stats(cells.where("ok"), keys), keys, "left")
    n, area = F.coalesce("valid_pixel_count", F.lit(0)).cast("long"), F.coalesce("valid_area_km2", F.lit(0.0))
    return out.withColumns({"valid_pixel_count": n, "valid_area_km2": area}).withColumns(
        {"coverage_fraction": F.coalesce(F.try_divide("valid_area_km2", "total_area_km2"), F.lit(0.0)), "quality_flag_accepted": F.col("valid_pixel_count") > 0}
    )


def simple_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple region-hours with a registry's and a ledger's columns; revision = day of the month."""
    hours = simple_hours(simple_cells(spark, sf_dir))
    return hours.withColumns({"country_code": F.lit("XX"), "region_type": F.lit("county"), "all_granules_validated": F.lit(True), "revision": F.dayofmonth("observation_hour").cast("long")})


def simple_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"R{k}", ZONES[k % 4]) for k in range(8)], "canonical_region_id string, timezone string")


def simple_hourly(spark: SparkSession, sf_dir: str, contract: Contract = CONTRACT) -> DataFrame:
    return models.region_hourly(simple_aggregates(spark, sf_dir), simple_registry(spark), contract)


def hierarchy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cells, weights and regions of events by customer, in three levels."""
    e = table(spark, sf_dir, "events")
    flag = F.when(F.col("event_type") == "error", 2).otherwise(0)
    cells = e.select(F.col("event_type").alias("granule_id"), exprs.hour_of(F.col("ts")).alias("observation_hour"), F.col("user_id").alias("grid_row"), F.lit(0).alias("grid_col"), F.col("value").alias("no2"), flag.alias("quality_flag"))
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    people = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    country, state = F.concat(F.lit("C"), F.col("r_regionkey").cast("string")), F.concat(F.lit("S"), F.col("n_nationkey").cast("string"))
    county = F.concat(F.lit("M"), F.col("n_nationkey").cast("string"), F.lit("-"), F.col("c_mktsegment"))
    levels = F.array(*[F.struct(i.alias("id"), F.lit(t).alias("kind")) for i, t in ((country, "country"), (state, "state"), (county, "county"))])
    flat = people.select("c_custkey", country.alias("country_code"), F.explode(levels).alias("l"))
    weights = flat.select(F.col("c_custkey").alias("grid_row"), F.lit(0).alias("grid_col"), F.col("l.id").alias("canonical_region_id"), (1 + F.col("c_custkey") % 4).cast("double").alias("overlap_weight"))
    regions = flat.select(F.col("l.id").alias("canonical_region_id"), "country_code", F.col("l.kind").alias("region_type")).distinct()
    return cells, weights, regions


def hierarchy_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, weights, regions = hierarchy(spark, sf_dir)
    hours = kernel.region_hours(cells, weights, regions, [0, 1]).withColumn("revision", F.lit(1).cast("long"))
    zones = regions.select("canonical_region_id", F.element_at(F.array(*map(F.lit, ZONES)), (F.crc32(F.col("country_code").cast("binary")) % 4 + 1).cast("int")).alias("timezone"))
    return models.region_hourly(hours, zones, LOW)


_CELLS = """cells as (
  select date_trunc('hour', ts) as observation_hour, 'R' || cast(user_id % 8 as varchar) as canonical_region_id, event_type as granule_id,
         value, 1 + event_id % 4 as weight, event_id, (event_type <> 'error' and coalesce(isfinite(value), false)) as ok from events)"""
_HOURS = (
    _CELLS
    + """, ranked as (
  select *, sum(weight) over (partition by observation_hour, canonical_region_id order by value) as cum, sum(weight) over (partition by observation_hour, canonical_region_id) as tot
  from cells where ok),
stats as (
  select observation_hour, canonical_region_id, sum(value * weight) / sum(weight) as no2_mean, min(value) filter (where cum >= tot * 0.5) as no2_median,
         min(value) filter (where cum >= tot * 0.9) as no2_p90, count(*) as n, sum(weight) as area from ranked group by 1, 2),
totals as (
  select observation_hour, canonical_region_id, count(*) as total_pixel_count, cast(sum(weight) as double) as total_area_km2, cast(count(distinct granule_id) as integer) as source_granule_count
  from cells group by 1, 2),
hours as (
  select observation_hour, canonical_region_id, total_pixel_count, total_area_km2, source_granule_count, no2_mean, no2_median, no2_p90, coalesce(n, 0) as valid_pixel_count,
         cast(coalesce(area, 0) as double) as valid_area_km2, coalesce(area, 0) / total_area_km2 as coverage_fraction, coalesce(n, 0) > 0 as quality_flag_accepted
  from totals left join stats using (observation_hour, canonical_region_id))"""
)
_HOURLY = (
    _HOURS
    + """, registry as (
  select 'R' || cast(k as varchar) as canonical_region_id, ['America/Los_Angeles', 'America/Toronto', 'America/Mexico_City', 'America/St_Johns'][k % 4 + 1] as timezone from range(8) t(k)),
hourly as (
  select hours.*, timezone, 'XX' as country_code, 'county' as region_type, cast(day(observation_hour) as bigint) as revision,
         timezone(registry.timezone, timezone('UTC', observation_hour)) as local_observation_hour, (quality_flag_accepted and coverage_fraction >= 0.25) as is_analysis_ready
  from hours join registry using (canonical_region_id))"""
)
_ANOMALIES = (
    _HOURLY
    + """, base as (
  select c.canonical_region_id, c.observation_hour, c.timezone, c.local_observation_hour, c.no2_mean, c.is_analysis_ready, count(p.no2_mean) as baseline_sample_count,
         median(p.no2_mean) as baseline_median, mad(p.no2_mean) as baseline_mad
  from hourly c left join hourly p on c.canonical_region_id = p.canonical_region_id and p.is_analysis_ready and p.observation_hour >= c.observation_hour - interval 28 day
    and p.observation_hour < c.observation_hour and extract(hour from p.local_observation_hour) = extract(hour from c.local_observation_hour)
  group by all),
anomalies as (
  select *, no2_mean - baseline_median as no2_difference,
         case when is_analysis_ready and baseline_sample_count >= 7 and baseline_mad <> 0 then (no2_mean - baseline_median) / (1.4826 * baseline_mad) end as robust_z_score from base)"""
)
_TREE = """cells as (
  select event_type as granule_id, date_trunc('hour', ts) as observation_hour, user_id as grid_row, value, (event_type <> 'error' and coalesce(isfinite(value), false)) as ok from events),
people as (
  select c_custkey, c_mktsegment, n_nationkey, r_regionkey, 'C' || r_regionkey as country_code, cast(1 + c_custkey % 4 as double) as w
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
weights as (
  select c_custkey as grid_row, 'C' || r_regionkey as canonical_region_id, country_code, 'country' as region_type, w from people
  union all select c_custkey, 'S' || n_nationkey, country_code, 'state', w from people
  union all select c_custkey, 'M' || n_nationkey || '-' || c_mktsegment, country_code, 'county', w from people),
scans as (select observation_hour, count(distinct granule_id) as scans from cells group by 1),
totals as (select canonical_region_id, any_value(country_code) as country_code, any_value(region_type) as region_type, count(*) as cells, sum(w) as area from weights group by 1),
ranked as (
  select observation_hour, canonical_region_id, value, w, sum(w) over (partition by observation_hour, canonical_region_id order by value) as cum,
         sum(w) over (partition by observation_hour, canonical_region_id) as tot from cells join weights using (grid_row) where ok),
stats as (
  select observation_hour, canonical_region_id, sum(value * w) / sum(w) as no2_mean, min(value) filter (where cum >= tot * 0.5) as no2_median, min(value) filter (where cum >= tot * 0.9) as no2_p90,
         count(*) as n, sum(w) as valid from ranked group by 1, 2),
hours as (
  select observation_hour, canonical_region_id, country_code, region_type, no2_mean, no2_median, no2_p90, coalesce(n, 0) as valid_pixel_count, cells * scans as total_pixel_count,
         coalesce(valid, 0) as valid_area_km2, area * scans as total_area_km2, coalesce(valid, 0) / (area * scans) as coverage_fraction, coalesce(n, 0) > 0 as quality_flag_accepted,
         cast(scans as integer) as source_granule_count, true as all_granules_validated
  from totals cross join scans left join stats using (observation_hour, canonical_region_id)),
hourly as (select *, (quality_flag_accepted and coverage_fraction >= 0.01) as is_analysis_ready from hours)"""
_STATS = "round(no2_mean, 6) as no2_mean, round(no2_median, 6) as no2_median, round(no2_p90, 6) as no2_p90"
_PIXELS = "valid_pixel_count, total_pixel_count, valid_area_km2, total_area_km2, round(coverage_fraction, 9) as coverage_fraction, quality_flag_accepted, source_granule_count"
DIGITS = {"no2_mean": 6, "no2_median": 6, "no2_p90": 6, "coverage_fraction": 9}

# --- region-hours ---------------------------------------------------------------------------


@query(f"with {_HOURS} select observation_hour, canonical_region_id, {_STATS}, {_PIXELS} from hours")
def region_hour_weighted(spark, sf_dir):
    """Area-weighted statistics of every region-hour."""
    return rounded(simple_hours(simple_cells(spark, sf_dir)), **DIGITS)


@query(ORACLES["region_hour_weighted"])
def region_hour_weighted_bucketed(spark, sf_dir):
    """The same by value ranges, the plan for groups too large to sort in one task."""
    cells, keys = simple_cells(spark, sf_dir), ["observation_hour", "canonical_region_id"]
    whole = simple_hours(cells).drop("no2_mean", "no2_median", "no2_p90")
    return rounded(whole.join(kernel.weighted_stats(cells.where("ok"), keys).select(*keys, "no2_mean", "no2_median", "no2_p90"), keys, "left"), **DIGITS)


@query(f"with {_TREE} select observation_hour, canonical_region_id, country_code, region_type, {_STATS}, {_PIXELS}, all_granules_validated from hours")
def region_hour_pooled_cells(spark, sf_dir):
    """Scans of an hour pooled over the weights of three region levels."""
    return rounded(kernel.region_hours(*hierarchy(spark, sf_dir), [0, 1]), **DIGITS)


@query(f"with {_HOURLY} select canonical_region_id, observation_hour, timezone, local_observation_hour, {_STATS}, {_PIXELS}, revision, is_analysis_ready from hourly")
def region_hourly_ready(spark, sf_dir):
    """R1, J1, J2, P4, F1."""
    h = rounded(simple_hourly(spark, sf_dir), **DIGITS)
    return h.drop("country_code", "region_type", "all_granules_validated", "contract_version")


@query(f"with {_HOURLY} select distinct observation_hour, timezone, local_observation_hour, extract(hour from local_observation_hour) as local_hour from hourly")
def local_hour_conversion(spark, sf_dir):
    """naive UTC to naive local time, zone by row."""
    hours = table(spark, sf_dir, "events").select(exprs.hour_of(F.col("ts")).alias("observation_hour"), (F.col("user_id") % 8).alias("k")).distinct()
    zones = hours.withColumn("timezone", F.element_at(F.array(*map(F.lit, ZONES)), (F.col("k") % 4 + 1).cast("int")))
    local = zones.withColumn("local_observation_hour", exprs.local_time(F.col("observation_hour"), F.col("timezone")))
    return local.withColumn("local_hour", F.hour("local_observation_hour").cast("long")).drop("k").distinct()


_ANOMALY = "canonical_region_id, observation_hour, timezone, local_observation_hour, round(no2_mean, 6) as no2_mean, baseline_sample_count, round(baseline_median, 6) as baseline_median, round(baseline_mad, 6) as baseline_mad, is_analysis_ready, round(no2_difference, 6) as no2_difference, round(robust_z_score, 6) as robust_z_score"
_ANOMALY_DIGITS = {c: 6 for c in ("no2_mean", "baseline_median", "baseline_mad", "no2_difference", "robust_z_score")}


@query(f"with {_ANOMALIES} select {_ANOMALY} from anomalies")
def anomalies_robust(spark, sf_dir):
    """Median and MAD of the same local hour over 28 days."""
    found = models.region_anomalies(simple_hourly(spark, sf_dir), CONTRACT).drop("source_revision", "contract_version")
    return rounded(found, **_ANOMALY_DIGITS)


@query(f"with {_ANOMALIES} select {_ANOMALY} from anomalies where canonical_region_id not in ('US', 'CA', 'MX')")
def anomalies_mart(spark, sf_dir):
    """R6, P7."""
    return rounded(models.mart_region_anomalies(models.region_anomalies(simple_hourly(spark, sf_dir), CONTRACT)), **_ANOMALY_DIGITS)


_PICK = ", ".join(
    f"round(max({c}) filter (where region_type = 'country'), {DIGITS[c]}) as {c}" if c in DIGITS else f"max({c}) filter (where region_type = 'country') as {c}"
    for c in ("no2_mean", "no2_median", "no2_p90", "coverage_fraction", "valid_pixel_count", "total_pixel_count", "valid_area_km2", "total_area_km2", "quality_flag_accepted", "source_granule_count", "all_granules_validated", "is_analysis_ready")
)


@query(
    f"""with {_TREE} select country_code, observation_hour, {_PICK}, count(*) filter (where region_type = 'county' and is_analysis_ready) as analysis_ready_region_count,
    count(*) filter (where region_type = 'county') as region_count from hourly group by 1, 2 having count(*) filter (where region_type = 'country') = 1"""
)
def country_hourly_filter_agg(spark, sf_dir):
    """R5, A11, A12, P20."""
    return rounded(models.mart_country_hourly(hierarchy_hourly(spark, sf_dir)), **DIGITS)


@query(
    f"""with {_HOURLY} select canonical_region_id, country_code, region_type, observation_hour as latest_observation_hour, round(no2_mean, 6) as latest_no2_mean, valid_area_km2 as latest_valid_area_km2,
    total_area_km2 as latest_total_area_km2, round(coverage_fraction, 9) as latest_coverage_fraction, date_diff('hour', observation_hour, timestamp '2024-01-31 00:00:00') as data_age_hours
    from hourly where is_analysis_ready qualify row_number() over (partition by canonical_region_id order by observation_hour desc) = 1"""
)
def region_latest(spark, sf_dir):
    """R4, W1, F2."""
    return rounded(models.mart_region_latest(simple_hourly(spark, sf_dir), AS_OF), latest_no2_mean=6, latest_coverage_fraction=9)


_ISSUE = "canonical_region_id, observation_hour, valid_area_km2, total_area_km2, round(coverage_fraction, 9) as coverage_fraction"


@query(
    f"""with {_HOURLY}, latest as (select *, date_diff('hour', observation_hour, timestamp '2024-01-31 00:00:00') as age from hourly
      qualify row_number() over (partition by canonical_region_id order by observation_hour desc) = 1)
    select {_ISSUE}, 'zero_valid' as issue_type, 'error' as severity, 'No valid accepted-area observations' as message from hourly where valid_pixel_count = 0
    union all select {_ISSUE}, 'low_coverage', 'warn', 'Regional coverage below contract floor' from hourly where valid_pixel_count > 0 and coverage_fraction < 0.25
    union all select {_ISSUE}, 'stale', case when age >= 12 then 'error' else 'warn' end, 'Observation older than freshness contract' from latest where age >= 6"""
)
def data_quality_union(spark, sf_dir):
    """R9, W2, U1, P12, P13."""
    return rounded(models.data_quality(simple_hourly(spark, sf_dir), CONTRACT, AS_OF), coverage_fraction=9)


@query(f"with {_TREE} select observation_hour, canonical_region_id, {_STATS}, is_analysis_ready from hourly where region_type <> 'country'")
def mart_region_hourly(spark, sf_dir):
    """R3, P6."""
    out = rounded(models.mart_region_hourly(hierarchy_hourly(spark, sf_dir)), **DIGITS)
    return out.select("observation_hour", "canonical_region_id", "no2_mean", "no2_median", "no2_p90", "is_analysis_ready")


# --- granules, latest cells, state ----------------------------------------------------------


@query("select o_orderkey as granule_id, l_linenumber, l_shipdate, l_partkey, date_diff('minute', o_orderdate, l_shipdate) as processing_latency_minutes from orders join lineitem on o_orderkey = l_orderkey")
def granule_latency(spark, sf_dir):
    """R10, F3."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    both = o.join(li, o.o_orderkey == li.l_orderkey)
    return both.select(F.col("o_orderkey").alias("granule_id"), "l_linenumber", "l_shipdate", "l_partkey", exprs.boundaries("minute", F.col("o_orderdate"), F.col("l_shipdate")).alias("processing_latency_minutes"))


@query(
    """with e as (select *, case when event_type = 'error' then -9999 else 0 end as flag, user_id as grid_row from events where coalesce(isfinite(value), false) or event_type <> 'error'),
    r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from e)
    select cast(user_id as bigint) as grid_row, ts as observation_time, value as no2, event_id as granule_number, flag >= 0 as quality_flag_accepted, flag >= 0 and value is not null as is_analysis_ready from r where rn = 1"""
)
def grid_latest_upsert(spark, sf_dir):
    """The newest value of every cell, batch after batch."""
    e = table(spark, sf_dir, "events").withColumn("flag", F.when(F.col("event_type") == "error", -9999).otherwise(0))
    seen = e.where(exprs.finite(F.col("value")) | (F.col("flag") != -9999))
    rows = seen.select(F.col("user_id").alias("grid_row"), F.col("ts").alias("observation_time"), F.col("value").alias("no2"), F.col("event_id").alias("granule_number"), (F.col("flag") >= 0).alias("quality_flag_accepted"))
    old, new = rows.where(F.dayofmonth("observation_time") <= 15), rows.where(F.dayofmonth("observation_time") > 15)
    order = ["observation_time", "granule_number"]
    return models.mart_grid_latest(kernel.newest(kernel.newest(rows.limit(0), old, ["grid_row"], order), new, ["grid_row"], order))


def _ledger(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    null = lambda t: F.lit(None).cast(t)
    old = o.where("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").cast("string").alias("granule_id"), F.col("o_orderstatus").alias("concept_id"), F.col("o_orderdate").alias("acquisition_start"), null("timestamp_ntz").alias("acquisition_end"),
        null("timestamp_ntz").alias("cmr_revision_at"), F.col("o_orderpriority").alias("download_url"), F.lit("discovered").alias("discovery_status"), F.lit("downloaded").alias("download_status"),
        F.when(F.col("o_orderkey") % 5 == 0, "failed").otherwise("validated").alias("validation_status"), F.lit("processed").alias("processing_status"), F.col("o_orderdate").alias("discovered_at"), F.col("o_orderdate").alias("last_seen_at"), F.col("o_orderdate").alias("updated_at"),
    )
    new = o.where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("string").alias("granule_id"), F.lit("concept").alias("concept_id"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderdate")).alias("acquisition_start"),
        F.col("o_orderdate").alias("acquisition_end"), null("timestamp_ntz").alias("cmr_revision_at"), null("string").alias("download_url"),
    )
    return old, new


@query(
    """with o as (select * from orders), old as (select * from o where o_orderkey % 3 <> 0), new as (select * from o where o_orderkey % 2 = 0)
    select cast(coalesce(old.o_orderkey, new.o_orderkey) as varchar) as granule_id, case when new.o_orderkey is not null then 'concept' else old.o_orderstatus end as concept_id,
      coalesce(case when new.o_orderkey % 4 = 0 then new.o_orderdate end, old.o_orderdate) as acquisition_start, new.o_orderdate as acquisition_end, old.o_orderpriority as download_url,
      case when old.o_orderkey is null then 'pending' else 'processed' end as processing_status, case when new.o_orderkey is not null then timestamp '2024-01-31 00:00:00' else old.o_orderdate end as last_seen_at,
      case when old.o_orderkey is null then timestamp '2024-01-31 00:00:00' else old.o_orderdate end as discovered_at
    from old full join new on old.o_orderkey = new.o_orderkey"""
)
def ledger_merge(spark, sf_dir):
    """K2, J5, J12."""
    merged, _ = merge_discovered(*_ledger(spark, sf_dir), F.lit(AS_OF).cast("timestamp_ntz"))
    return merged.select("granule_id", "concept_id", "acquisition_start", "acquisition_end", "download_url", "processing_status", "last_seen_at", "discovered_at")


@query(
    """select cast(o_orderkey as varchar) as granule_id, o_orderpriority as download_url, o_orderdate as discovered_at from orders where o_orderkey % 3 <> 0 and o_orderkey % 5 = 0
    order by discovered_at, granule_id limit 25"""
)
def pending_topn(spark, sf_dir):
    """The oldest open granules."""
    return pending(_ledger(spark, sf_dir)[0], 25)


@query(
    f"""with {_HOURS} select observation_hour, canonical_region_id, case when day(observation_hour) = 10 then 999.0 else round(no2_mean, 6) end as no2_mean,
    cast(case when day(observation_hour) = 10 then 100 else day(observation_hour) end as bigint) as revision from hours where day(observation_hour) <> 10 or canonical_region_id <> 'R0'"""
)
def hour_replace(spark, sf_dir):
    """The hours of day 10 come again without region R0."""
    rows = simple_aggregates(spark, sf_dir).select("observation_hour", "canonical_region_id", "no2_mean", "revision")
    again = rows.where("day(observation_hour) = 10")
    # An hour that held R0 only has no rows in the new batch, so its touched hours are given by it whole.
    batch = again.where("canonical_region_id <> 'R0'").withColumn("no2_mean", F.lit(999.0))
    kept = rows.join(again.select("observation_hour").distinct(), "observation_hour", "left_anti")
    return rounded(replace_hours(kept, batch, 100), no2_mean=6)


def _incremental(spark, sf_dir, contract, published_version):
    """Publish days up to 20 in full, then the rest (or all, after a contract change) incrementally."""
    aggregates, registry = simple_aggregates(spark, sf_dir), simple_registry(spark)
    first = models.region_hourly(aggregates.where("revision <= 20"), registry, CONTRACT)
    anomalies = models.region_anomalies(first, CONTRACT)
    changed = models.region_hourly(changed_since(aggregates, 20, contract.contract_version, published_version), registry, contract)
    merged = upsert(first, changed.select(*first.columns), models.KEY)
    redo = models.affected(merged, changed, contract)
    updates = models.region_anomalies(merged, contract, redo)
    return rounded(upsert(anomalies, updates, models.KEY).drop("source_revision"), **_ANOMALY_DIGITS)


@query(f"with {_ANOMALIES} select {_ANOMALY}, '0.4.0' as contract_version from anomalies")
def incremental_equals_full(spark, sf_dir):
    """An incremental publish equals a full one."""
    return _incremental(spark, sf_dir, CONTRACT, CONTRACT.contract_version)


@query(f"with {_ANOMALIES} select {_ANOMALY}, '0.5.0' as contract_version from anomalies")
def contract_invalidation(spark, sf_dir):
    """T4: a new contract version recomputes every row."""
    return _incremental(spark, sf_dir, Contract("0.5.0", CONTRACT.min_region_coverage), CONTRACT.contract_version)


@query(
    """with e as (select event_type, value, 1 + event_id % 4 as w, sum(1 + event_id % 4) over (partition by event_type order by value) as cum, sum(1 + event_id % 4) over (partition by event_type) as tot from events where value is not null)
    select event_type, round(sum(value * w) / sum(w), 6) as no2_mean, min(value) filter (where cum >= tot * 0.5) as no2_median, min(value) filter (where cum >= tot * 0.9) as no2_p90,
      count(*) as valid_pixel_count, cast(sum(w) as double) as valid_area_km2 from e group by 1"""
)
def quantiles_narrowed(spark, sf_dir):
    """Weighted quantiles of large groups, without sorting one in a task."""
    e = table(spark, sf_dir, "events").where("value is not null").select("event_type", "value", (1 + F.col("event_id") % 4).alias("weight"))
    return rounded(kernel.weighted_stats(e, ["event_type"], limit=100), no2_mean=6)


# --- checks, filters, sorts, sets -----------------------------------------------------------


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_grain(spark, sf_dir):
    """A15, X2."""
    return checks.duplicate_grain(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select 'customer' as relation, count(*) filter (where c_custkey is null) as null_keys, count(*) - count(distinct c_custkey) as repeated from customer union all select 'orders', count(*) filter (where o_orderkey is null), count(*) - count(distinct o_orderkey) from orders")
def not_null_unique(spark, sf_dir):
    """X3."""
    one = lambda t, k: table(spark, sf_dir, t).agg(F.lit(t).alias("relation"), F.count_if(F.col(k).isNull()).alias("null_keys"), (F.count("*") - F.countDistinct(k)).alias("repeated"))
    return one("customer", "c_custkey").unionByName(one("orders", "o_orderkey"))


@query("select l_orderkey, l_linenumber, l_discount * 12 as coverage_fraction from lineitem where l_discount * 12 < 0 or l_discount * 12 > 1")
def coverage_range(spark, sf_dir):
    """X2, A16."""
    return checks.outside_unit_interval(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 12).alias("coverage_fraction")))


@query("select c_custkey, c_acctbal as no2_mean from customer where c_acctbal < 0")
def non_negative(spark, sf_dir):
    """X2."""
    return checks.negative(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("no2_mean")))


@query("select max(ts) as newest, date_diff('hour', max(ts), timestamp '2024-01-31 00:00:00') as age_hours, case when date_diff('hour', max(ts), timestamp '2024-01-31 00:00:00') >= 12 then 'error' when date_diff('hour', max(ts), timestamp '2024-01-31 00:00:00') >= 6 then 'warn' else 'pass' end as state from events")
def freshness(spark, sf_dir):
    """T10."""
    return checks.freshness(table(spark, sf_dir, "events"), "ts", AS_OF, 6, 12)


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier where s_acctbal between 0 and 5000 and s_nationkey between 5 and 15")
def bbox_filter(spark, sf_dir):
    """P8."""
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal").between(0, 5000) & F.col("s_nationkey").between(5, 15))


@query("select p_partkey, p_name, p_brand from part where p_brand like 'Brand#1%'")
def like_prefix(spark, sf_dir):
    """P9."""
    return table(spark, sf_dir, "part").where(F.col("p_brand").like("Brand#1%")).select("p_partkey", "p_name", "p_brand")


@query("with c as (select c_custkey, case when c_custkey % 7 <> 0 then c_acctbal end as z from customer) select c_custkey, z from c order by abs(z) desc nulls last, c_custkey limit 20")
def topk_nulls_last(spark, sf_dir):
    """O1-O3."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("z"))
    return c.orderBy(F.abs("z").desc_nulls_last(), "c_custkey").limit(20)


@query("(select n_nationkey, n_name, 'left' as side from nation where n_regionkey <> 1 except select n_nationkey, n_name, 'left' from nation where n_regionkey <> 2) union all (select n_nationkey, n_name, 'right' from nation where n_regionkey <> 2 except select n_nationkey, n_name, 'right' from nation where n_regionkey <> 1)")
def symmetric_except(spark, sf_dir):
    """U2."""
    n = table(spark, sf_dir, "nation")
    return checks.unequal(n.where("n_regionkey <> 1").select("n_nationkey", "n_name"), n.where("n_regionkey <> 2").select("n_nationkey", "n_name"))


@query("with s as (select c_nationkey, c_mktsegment, count(*) as area from customer group by 1, 2) select c_nationkey, c_mktsegment, cast(area as bigint) as area from s qualify row_number() over (partition by c_nationkey order by area desc, c_mktsegment) = 1")
def dominant_argmax(spark, sf_dir):
    """A18."""
    c = table(spark, sf_dir, "customer").withColumn("area", F.lit(1))
    return geography.dominant(c, "c_nationkey", "c_mktsegment", "area")


@query("with r as (select n_regionkey, lag(n_regionkey) over () as last from nation) select n_regionkey from r where last > n_regionkey")
def sortedness_check(spark, sf_dir):
    """W3."""
    return checks.unsorted(table(spark, sf_dir, "nation"), ["n_regionkey"])


@query("with r as (select o_custkey, lag(o_custkey) over () as last from orders) select o_custkey from r where last > o_custkey")
def sortedness_check_orders(spark, sf_dir):
    """W3, on a large table."""
    return checks.unsorted(table(spark, sf_dir, "orders"), ["o_custkey"])


@query(
    """with g as (select r, c, 14.01::double + r * 0.02::double as lat, -167.99::double + c * 0.02::double as lon from range(2950) a(r), range(7750) b(c)),
    cells as (select r, lat, lon, round(power(6371.0088::double, 2) * radians(0.02::double) * abs(sin(radians(lat + 0.01::double)) - sin(radians(lat - 0.01::double))), 9) as area from g)
    select cast(r as bigint) as grid_row, count(*) as cells, round(min(lat), 9) as latitude, round(min(lon), 9) as west, round(max(lon), 9) as east,
      cast(sum(cast(round(lon * 100) as bigint)) as bigint) as centres, min(area) as smallest_km2, max(area) as largest_km2 from cells group by 1"""
)
def cell_area(spark, sf_dir):
    """Areas and centres of all 22.9 million cells of the grid, summed up by row (``centres``: in hundredths of a degree)."""
    grid = spark.range(exprs.GRID_ROWS * exprs.GRID_COLS).select(F.expr(f"id div {exprs.GRID_COLS}").alias("grid_row"), F.expr(f"id % {exprs.GRID_COLS}").alias("grid_col"))
    lat = exprs.cell_latitude(F.col("grid_row"))
    cells = grid.select("grid_row", lat.alias("lat"), exprs.cell_longitude(F.col("grid_col")).alias("lon"), F.round(exprs.cell_area_km2(lat), 9).alias("area"))
    return cells.groupBy("grid_row").agg(
        F.count("*").alias("cells"),
        F.round(F.min("lat"), 9).alias("latitude"),
        F.round(F.min("lon"), 9).alias("west"),
        F.round(F.max("lon"), 9).alias("east"),
        F.sum(F.round(F.col("lon") * 100).cast("long")).alias("centres"),
        F.min("area").alias("smallest_km2"),
        F.max("area").alias("largest_km2"),
    )


@query(
    """with k as (select s_suppkey as id, -120.0::double + (s_suppkey % 50) * 0.013::double as west, 20.0::double + (s_suppkey % 30) * 0.017::double as south from supplier),
    b as (select id, west, south, west + 0.07::double as east, south + 0.05::double as north from k),
    cells as (select b.*, r, c, 14.01::double + r * 0.02::double - 0.01::double as la, -167.99::double + c * 0.02::double - 0.01::double as lo from b, range(2950) t(r), range(7750) u(c)
      where r between floor((south - 14.0) / 0.02) - 1 and floor((north - 14.0) / 0.02) + 1 and c between floor((west + 168.0) / 0.02) - 1 and floor((east + 168.0) / 0.02) + 1),
    clip as (select id, r, c, greatest(south, la) as s, least(north, la + 0.02::double) as n, greatest(west, lo) as w, least(east, lo + 0.02::double) as e from cells)
    select 'K' || id as canonical_region_id, count(*) as cells, round(sum(power(6371.0088::double, 2) * radians(e - w) * (sin(radians(n)) - sin(radians(s)))), 5) as overlap_weight
    from clip where n - s > 1e-9 and e - w > 1e-9 group by 1"""
)
def rect_overlap_weights(spark, sf_dir):
    """Cells under rectangles and their clipped areas, summed by region."""
    s = table(spark, sf_dir, "supplier")
    box = s.select(F.concat(F.lit("K"), F.col("s_suppkey").cast("string")).alias("canonical_region_id"), (-120.0 + (F.col("s_suppkey") % 50) * 0.013).alias("west"), (20.0 + (F.col("s_suppkey") % 30) * 0.017).alias("south"))
    weights = geography.rectangle_weights(box.withColumns({"east": F.col("west") + 0.07, "north": F.col("south") + 0.05}))
    # slivers of rounding are no cells
    return weights.where("overlap_weight > 1e-7").groupBy("canonical_region_id").agg(F.count("*").alias("cells"), F.round(F.sum("overlap_weight"), 5).alias("overlap_weight"))


@query("select source, lang, count(*) as n, count(distinct doc_id) as documents, count(quality) as labelled from documents left join labels using (doc_id) group by 1, 2")
def category_counts(spark, sf_dir):
    """A17."""
    d, la = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", "source", "lang").join(la, "doc_id", "left").groupBy("source", "lang").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents"), F.count("quality").alias("labelled"))


@query("select c_mktsegment, p_flags from (select distinct c_mktsegment from customer) cross join (select unnest([[0, 1], [2, 3]]) as f) t, lateral (select array_to_string(f, ',') as p_flags)")
def flag_parsing(spark, sf_dir):
    """'0|1' and '2,3' as arrays of flags."""
    flags = spark.createDataFrame([("0|1",), ("2,3",)], "text string").select(F.array_join(exprs.parse_flags(F.col("text")).cast("array<string>"), ",").alias("p_flags"))
    return table(spark, sf_dir, "customer").select("c_mktsegment").distinct().crossJoin(flags)


@query("select c_custkey, 'US-PC-' || lpad(cast(c_custkey as varchar), 5, '0') as code, repeat('x', c_nationkey % 4) as mark from customer")
def padded_codes(spark, sf_dir):
    """F9."""
    code = F.concat(F.lit("US-PC-"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"))
    return table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"), F.expr("repeat('x', c_nationkey % 4)").alias("mark"))


@query("select o_orderpriority, o_orderstatus, count(*) as n from orders group by all order by all")
def order_by_all(spark, sf_dir):
    """O4."""
    return spark.sql("select o_orderpriority, o_orderstatus, count(*) as n from {orders} group by all order by all", orders=table(spark, sf_dir, "orders"))


@query("select o_orderkey, o_totalprice from orders where o_totalprice >= 1000.5 and o_orderstatus = 'F' and o_orderdate < timestamp '1997-01-01'")
def parameterised_predicates(spark, sf_dir):
    """Values reach the plan as parameters, never as text."""
    sql = "select o_orderkey, o_totalprice from {orders} where o_totalprice >= :least and o_orderstatus = :status and o_orderdate < :before"
    return spark.sql(sql, args={"least": 1000.5, "status": "F", "before": dt.datetime(1997, 1, 1)}, orders=table(spark, sf_dir, "orders"))


@query("select n_nationkey, n_name, case n_regionkey when 0 then 'AF' when 1 then 'AM' when 2 then 'AS' when 3 then 'EU' end as code from nation")
def code_lookup(spark, sf_dir):
    """A fixed list of codes as a literal map; what isn't in it has none."""
    codes = F.create_map(*[F.lit(x) for pair in enumerate(["AF", "AM", "AS", "EU"]) for x in pair])
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.try_element_at(codes, F.col("n_regionkey")).alias("code"))


@query("select event_id, date_trunc('hour', timestamp '2023-12-01 00:00:00' + to_minutes(cast(event_id % 90000 as bigint))) as observation_hour, timestamp '2023-12-01 00:00:00' + to_minutes(cast(event_id % 90000 as bigint)) as observation_time from events")
def decoded_times(spark, sf_dir):
    """Numbers in 'minutes since' as times and their hours."""
    e = table(spark, sf_dir, "events")
    at = exprs.cf_time((F.col("event_id") % 90000).cast("double"), F.lit("minutes since 2023-12-01 00:00:00"))
    return e.select("event_id", at.alias("observation_time"), exprs.hour_of(at).alias("observation_hour"))


@query("select doc_id, sha256(text) as sha256 from documents where text is not null")
def text_digests(spark, sf_dir):
    """A20."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))


_SORTED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem order by all")
def canonical_order(spark, sf_dir):
    """Total order over several keys."""
    from skyloom.sources.artifacts import canonical

    return canonical(table(spark, sf_dir, "lineitem").select(*_SORTED), _SORTED)


@query("select table_name, column_name, cast(ordinal_position as integer) as position from information_schema.columns where table_name in ('region', 'nation', 'orders', 'events', 'documents')")
def catalog_columns(spark, sf_dir):
    """S22."""
    names = ["region", "nation", "orders", "events", "documents"]
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return relations.relation_columns(spark, [*names, "no_such_table"])


_WIDE = ORACLES["country_hourly_filter_agg"].replace("coverage_fraction >= 0.01)", "coverage_fraction >= 0.001)")


@query(f"select country_code, observation_hour, no2_mean, coverage_fraction, analysis_ready_region_count, region_count from ({_WIDE}) where country_code = 'C1' and is_analysis_ready")
def country_history(spark, sf_dir):
    """The ready hours of a country whose contract asks for a thousandth of its area."""
    hourly = hierarchy_hourly(spark, sf_dir).withColumn("is_analysis_ready", F.col("quality_flag_accepted") & (F.col("coverage_fraction") >= 0.001))
    return relations.country_history(rounded(models.mart_country_hourly(hourly), **DIGITS), "C1")


from skyloom.plans import geo_queries, store_queries  # noqa: E402, F401  (register their queries)
