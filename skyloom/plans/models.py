"""The published relations as functions of DataFrames, a contract and a point in time.

Full refresh and incremental runs call the same functions on other rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.exprs import array_mad, array_median, boundaries, local_time, robust_z
from skyloom.schemas import COUNTRIES, FINEST_TYPES, Contract

KEY = ["canonical_region_id", "observation_hour"]


def region_hourly(aggregates: DataFrame, registry: DataFrame, contract: Contract) -> DataFrame:
    """Region-hours of registered regions with local time and readiness."""
    zones = registry.select("canonical_region_id", "timezone")
    ready = F.col("quality_flag_accepted") & F.col("all_granules_validated") & (F.col("coverage_fraction") >= contract.min_region_coverage)
    return aggregates.join(zones, "canonical_region_id").withColumns(
        {"contract_version": F.lit(contract.contract_version), "local_observation_hour": local_time(F.col("observation_hour"), F.col("timezone")), "is_analysis_ready": ready}
    )


def region_anomalies(hourly: DataFrame, contract: Contract, current: DataFrame | None = None) -> DataFrame:
    """Each region-hour against the ready hours of the same local hour in the days before.

    All rows: one range window per (region, local hour) instead of a self-join; a group holds
    one value a day, two at most.  With ``current`` only the rows of its keys are computed, by joining them
    to their own baselines, so the work follows the change and not the history.
    """
    days = contract.anomaly_baseline_days
    rows = hourly.withColumns({"_hour": F.hour("local_observation_hour"), "_at": F.unix_seconds(F.col("observation_hour").cast("timestamp"))})
    if current is None:
        frame = f"partition by canonical_region_id, _hour order by _at range between {days * 86400} preceding and 1 preceding"
        rows = rows.withColumn("_prior", F.expr(f"collect_list(case when is_analysis_ready then no2_mean end) over ({frame})"))
    else:
        prior = rows.where("is_analysis_ready and no2_mean is not null").select("canonical_region_id", "_hour", F.col("_at").alias("_then"), F.col("no2_mean").alias("_value"))
        rows = rows.join(current.select(*KEY), KEY, "left_semi")
        near = rows.select(*KEY, "_hour", "_at").join(prior, ["canonical_region_id", "_hour"]).where(f"_then < _at and _then >= _at - {days * 86400}")
        rows = rows.join(near.groupBy(*KEY).agg(F.collect_list("_value").alias("_prior")), KEY, "left")
        rows = rows.withColumn("_prior", F.coalesce("_prior", F.array().cast("array<double>")))
    rows = rows.withColumn("baseline_median", array_median(F.col("_prior"))).withColumn("baseline_sample_count", F.size("_prior").cast("long"))
    rows = rows.withColumn("baseline_mad", array_mad(F.col("_prior"), F.col("baseline_median")))
    z = robust_z(F.col("no2_mean"), F.col("is_analysis_ready"), F.col("baseline_sample_count"), F.col("baseline_median"), F.col("baseline_mad"), contract.anomaly_min_baseline_samples)
    return rows.select(
        *KEY,
        "timezone",
        "local_observation_hour",
        "no2_mean",
        "baseline_sample_count",
        "baseline_median",
        "baseline_mad",
        "is_analysis_ready",
        F.col("revision").alias("source_revision"),
        F.lit(contract.contract_version).alias("contract_version"),
        (F.col("no2_mean") - F.col("baseline_median")).alias("no2_difference"),
        z.alias("robust_z_score"),
    )


def affected(hourly: DataFrame, changed: DataFrame, contract: Contract) -> DataFrame:
    """The region-hours whose baseline or own value a changed region-hour can touch: those of the same local hour."""
    first, last = changed.agg(F.min("observation_hour"), F.max("observation_hour")).first()
    if first is None:
        return hourly.limit(0)
    # Literal bounds reach the scan, so untouched hours (partitions) are never read.
    span = [F.lit(t).cast("timestamp_ntz") for t in (first, last + dt.timedelta(days=contract.anomaly_baseline_days))]
    hourly = hourly.where(F.col("observation_hour").between(*span))
    c = changed.select(F.col("canonical_region_id").alias("_region"), F.col("observation_hour").alias("_from"), F.hour("local_observation_hour").alias("_hour"))
    until = F.col("_from") + F.expr(f"interval {contract.anomaly_baseline_days} days")
    near = (F.col("canonical_region_id") == F.col("_region")) & (F.hour("local_observation_hour") == F.col("_hour")) & (F.col("observation_hour") >= F.col("_from")) & (F.col("observation_hour") <= until)
    return hourly.join(c, near, "left_semi")


def mart_region_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.where("region_type != 'country'")


def mart_region_latest(hourly: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The latest ready hour of every region below country level."""
    rows = hourly.where("is_analysis_ready and region_type != 'country'")
    best = rows.groupBy("canonical_region_id").agg(F.max_by(F.struct("country_code", "region_type", "observation_hour", "no2_mean", "valid_area_km2", "total_area_km2", "coverage_fraction"), "observation_hour").alias("r"))
    return best.select(
        "canonical_region_id",
        "r.country_code",
        "r.region_type",
        F.col("r.observation_hour").alias("latest_observation_hour"),
        F.col("r.no2_mean").alias("latest_no2_mean"),
        F.col("r.valid_area_km2").alias("latest_valid_area_km2"),
        F.col("r.total_area_km2").alias("latest_total_area_km2"),
        F.col("r.coverage_fraction").alias("latest_coverage_fraction"),
        boundaries("hour", F.col("r.observation_hour"), F.lit(as_of).cast("timestamp_ntz")).alias("data_age_hours"),
    )


def mart_country_hourly(hourly: DataFrame) -> DataFrame:
    """The country's own row of each hour, with counts of its finest regions."""
    country, finest = F.col("region_type") == "country", F.col("region_type").isin(*FINEST_TYPES)
    own = ["no2_mean", "no2_median", "no2_p90", "coverage_fraction", "valid_pixel_count", "total_pixel_count", "valid_area_km2", "total_area_km2", "quality_flag_accepted", "source_granule_count", "all_granules_validated", "is_analysis_ready"]
    out = hourly.groupBy("country_code", "observation_hour").agg(
        *[F.max(F.when(country, F.col(c))).alias(c) for c in own],
        F.count_if(finest & F.col("is_analysis_ready")).alias("analysis_ready_region_count"),
        F.count_if(finest).alias("region_count"),
        F.count_if(country).alias("_countries"),
    )
    return out.where("_countries = 1").drop("_countries")


def mart_region_anomalies(anomalies: DataFrame) -> DataFrame:
    return anomalies.where(~F.col("canonical_region_id").isin(*COUNTRIES)).drop("source_revision", "contract_version")


def mart_grid_latest(grid_latest: DataFrame) -> DataFrame:
    return grid_latest.withColumn("is_analysis_ready", F.col("quality_flag_accepted") & F.col("no2").isNotNull())


def mart_region_registry(registry: DataFrame) -> DataFrame:
    return registry.select("country_code", "region_type", "source_region_id", "canonical_region_id", "region_name", "parent_region_id", "timezone", "geometry_version", "geometry_checksum", "loaded_at")


def data_quality(hourly: DataFrame, contract: Contract, as_of: dt.datetime) -> DataFrame:
    """Findings: hours without valid pixels, with low coverage, and regions whose latest hour is stale."""
    columns = [*KEY, "valid_area_km2", "total_area_km2", "coverage_fraction"]
    issue = lambda df, kind, severity, message: df.select(*columns, F.lit(kind).alias("issue_type"), severity.alias("severity"), F.lit(message).alias("message"))
    none = hourly.where("valid_pixel_count = 0")
    low = hourly.where((F.col("valid_pixel_count") > 0) & (F.col("coverage_fraction") < contract.min_region_coverage))
    latest = hourly.groupBy("canonical_region_id").agg(F.max_by(F.struct("observation_hour", "valid_area_km2", "total_area_km2", "coverage_fraction"), "observation_hour").alias("r"))
    latest = latest.select("canonical_region_id", "r.*")
    age = boundaries("hour", F.col("observation_hour"), F.lit(as_of).cast("timestamp_ntz"))
    stale = latest.where(age >= contract.stale_hours_warn)
    grade = F.when(age >= contract.stale_hours_error, "error").when(age >= contract.stale_hours_warn, "warn").otherwise("info")
    return (
        issue(none, "zero_valid", F.lit("error"), "No valid accepted-area observations")
        .unionByName(issue(low, "low_coverage", F.lit("warn"), "Regional coverage below contract floor"))
        .unionByName(issue(stale, "stale", grade, "Observation older than freshness contract"))
    )


def granule_observability(inventory: DataFrame) -> DataFrame:
    columns = [c for c in inventory.columns if c not in ("download_url", "local_path", "updated_at")]
    return inventory.select(*columns, boundaries("minute", F.col("discovered_at"), F.col("processed_at")).alias("processing_latency_minutes"))
