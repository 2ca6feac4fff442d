"""From grid cells and region weights to region-hours, and to the latest cell values.

The weight of a region's cells counts in the denominators once per scan whether valid or
not.  Those totals are products of per-region and per-hour numbers, so invalid cells are
never joined: only accepted cells meet the weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.exprs import MISSING_FLAG, cell_area_km2, finite, finite_or_null
from skyloom.operators.steps import settled

QUANTILES = {"no2_median": 0.5, "no2_p90": 0.9}
LIMIT, PARTS = 1_000_000, 64  # rows of a group that a task sorts, and parts that a larger one is cut into


def accepted(flags: list[int], value: str = "no2", flag: str = "quality_flag") -> Column:
    """Cells with an accepted quality flag and a finite value."""
    return F.coalesce(F.col(flag).isin([int(f) for f in flags]), F.lit(False)) & finite(F.col(value))


def weighted_stats(valid: DataFrame, keys: list[str], value: str = "value", weight: str = "weight", limit: int | None = None) -> DataFrame:
    """keys, no2_mean, no2_median, no2_p90, valid_pixel_count, valid_area_km2 of valid cells.

    A quantile is the first value, in ascending order, whose cumulative weight reaches its share
    of the total (lower bound); statistics are null where the total weight isn't positive.
    Groups of more than ``limit`` rows aren't sorted: their quantiles are narrowed down to (``narrowed``), and no task
    gets more than some ``limit`` rows of a group.  Without a limit every group is sorted in its task.
    """
    if limit:
        large = valid.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*keys)
        large = settled(large)  # one row for ``limit`` rows of the input at most
        if not large.isEmpty():
            small = _sorted_stats(valid.join(large, keys, "left_anti"), keys, value, weight)
            return small.unionByName(narrowed(valid.join(large, keys, "left_semi"), keys, value, weight, limit))
    return _sorted_stats(valid, keys, value, weight)


def _sums(value: Column, weight: Column, count: Column) -> list[Column]:
    mean = F.when(F.sum(weight) > 0, F.sum(value * weight) / F.sum(weight)).alias("no2_mean")
    return [mean, count.alias("valid_pixel_count"), F.sum(weight).cast("double").alias("valid_area_km2")]


def _sorted_stats(valid: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    v, w, by = F.col(value), F.col(weight), ", ".join(f"`{k}`" for k in keys)
    cum = F.expr(f"sum(`{weight}`) over (partition by {by} order by `{value}`)")
    tot = F.expr(f"sum(`{weight}`) over (partition by {by})")
    ranked = valid.withColumns({"_cum": cum, "_tot": tot})
    picks = [F.when(F.max("_tot") > 0, F.coalesce(F.min(F.when(F.col("_cum") >= F.col("_tot") * q, v)), F.max(v))).alias(n) for n, q in QUANTILES.items()]
    mean, count, area = _sums(v, w, F.count("*"))
    return ranked.groupBy(*keys).agg(mean, *picks, count, area)


def narrowed(valid: DataFrame, keys: list[str], value: str = "value", weight: str = "weight", limit: int = LIMIT, parts: int = PARTS) -> DataFrame:
    """The same statistics of large groups, by repeated exact selection.

    Equal values become one row first.  Summaries that tasks build and merge give cut points between which a group's
    values are about equally many, wherever they lie; the summed weights of these parts tell which one holds a quantile.
    That part is cut again until it has ``limit`` rows at most, and only those are sorted.  A round leaves about
    one row of ``parts``, so there are two or three.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    rows = valid.groupBy(*keys, F.col(value).alias("_v")).agg(F.sum(weight).alias("_w"), F.count("*").alias("_k"))
    rows = settled(rows)
    mean, count, area = _sums(F.col("_v"), F.col("_w"), F.sum("_k"))
    out = settled(rows.groupBy(*keys).agg(mean, count, area, F.sum("_w").alias("_tot")))
    for name, q in QUANTILES.items():
        left = rows.join(out.select(*keys, (F.col("_tot") * q).alias("_goal")), keys).withColumn("_base", F.lit(0).cast(dict(rows.dtypes)["_w"]))
        while (left.groupBy(*keys).count().agg(F.max("count").alias("n")).first().n or 0) > limit:
            cuts = left.groupBy(*keys).agg(F.percentile_approx("_v", [k / parts for k in range(1, parts)], 20 * parts).alias("_cuts"))
            left = left.join(cuts, keys).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
            sums = left.groupBy(*keys, "_part").agg(F.sum("_w").alias("_s"), F.first("_goal").alias("_goal"), F.first("_base").alias("_base"))
            sums = sums.withColumn("_cum", F.col("_base") + F.expr(f"sum(_s) over (partition by {by} order by _part)"))
            # Sums in another order may end just below the goal: then the last part counts.
            reached = F.struct(F.when(F.col("_cum") >= F.col("_goal"), F.col("_part")).otherwise(parts - F.col("_part") + parts).alias("at"))
            here = sums.groupBy(*keys).agg(F.min_by(F.struct("_part", (F.col("_cum") - F.col("_s")).alias("_base")), reached).alias("_r"))
            left = settled(left.drop("_base").join(here.select(*keys, "_r._part", "_r._base"), [*keys, "_part"]).drop("_part"))
        cum = left.withColumn("_cum", F.col("_base") + F.expr(f"sum(_w) over (partition by {by} order by _v)"))
        pick = cum.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("_cum") >= F.col("_goal"), F.col("_v"))), F.max("_v")).alias(name))
        out = out.join(pick, keys)
    picks = [F.when(F.col("_tot") > 0, F.col(n)).alias(n) for n in QUANTILES]
    return out.select(*keys, "no2_mean", *picks, "valid_pixel_count", "valid_area_km2")


def region_hours(cells: DataFrame, weights: DataFrame, regions: DataFrame, flags: list[int], limit: int | None = None) -> DataFrame:
    """Region-hour aggregates of gridded cells: one row per region with weights and hour with scans.

    ``cells``: granule_id, observation_hour, grid_row, grid_col, no2, quality_flag;
    ``weights``: grid_row, grid_col, canonical_region_id, overlap_weight (square km);
    ``regions``: canonical_region_id, country_code, region_type.  A weighted region that isn't
    registered raises an error.  ``limit``: see ``weighted_stats``.
    """
    keys = ["observation_hour", "canonical_region_id"]
    totals = weights.groupBy("canonical_region_id").agg(F.count("*").alias("_cells"), F.sum("overlap_weight").alias("_area"))
    scans = cells.groupBy("observation_hour").agg(F.countDistinct("granule_id").alias("_scans"))
    valid = cells.where(accepted(flags)).select("observation_hour", "grid_row", "grid_col", F.col("no2").alias("value"))
    stats = weighted_stats(valid.join(weights, ["grid_row", "grid_col"]).withColumnRenamed("overlap_weight", "weight"), keys, limit=limit)
    known = totals.join(regions.select("canonical_region_id", "country_code", "region_type"), "canonical_region_id", "left")
    missing = F.when(F.col("region_type").isNull(), F.raise_error(F.concat(F.lit("region without registry row: "), "canonical_region_id"))).otherwise(F.col("region_type"))
    # Every region has a row for every hour: this product is the result's own grain.
    grain = known.withColumn("region_type", missing).crossJoin(scans)
    out = grain.join(stats, keys, "left")
    area, total = F.coalesce("valid_area_km2", F.lit(0.0)), F.col("_area") * F.col("_scans")
    return out.select(
        "observation_hour",
        "canonical_region_id",
        "country_code",
        "region_type",
        "no2_mean",
        "no2_median",
        "no2_p90",
        F.coalesce("valid_pixel_count", F.lit(0)).cast("long").alias("valid_pixel_count"),
        (F.col("_cells") * F.col("_scans")).alias("total_pixel_count"),
        area.alias("valid_area_km2"),
        total.alias("total_area_km2"),
        F.coalesce(F.try_divide(area, total), F.lit(0.0)).alias("coverage_fraction"),
        (F.coalesce("valid_pixel_count", F.lit(0)) > 0).alias("quality_flag_accepted"),
        F.col("_scans").cast("int").alias("source_granule_count"),
        F.lit(True).alias("all_granules_validated"),
    )


def latest_batch(cells: DataFrame, weights: DataFrame, regions: DataFrame, flags: list[int], ingested_at: Column) -> DataFrame:
    """Observed cells (finite value or a quality flag) inside countries, in the shape of the latest-cell table."""
    countries = regions.where("region_type = 'country'").select("canonical_region_id")
    inside = weights.join(countries, "canonical_region_id", "left_semi").select("grid_row", "grid_col").distinct()
    observed = cells.where(finite(F.col("no2")) | (F.col("quality_flag") != MISSING_FLAG))
    return observed.join(inside, ["grid_row", "grid_col"], "left_semi").select(
        "grid_row",
        "grid_col",
        "latitude",
        "longitude",
        cell_area_km2(F.col("latitude")).alias("cell_area_km2"),
        "observation_time",
        "observation_hour",
        finite_or_null(F.col("no2")).alias("no2"),
        "quality_flag",
        F.col("quality_flag").isin([int(f) for f in flags]).alias("quality_flag_accepted"),
        "granule_id",
        ingested_at.alias("ingested_at"),
    )


def newest(existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``; an existing row stays unless the batch is strictly newer."""
    rows = existing.withColumn("_old", F.lit(1)).unionByName(batch.withColumn("_old", F.lit(0)))
    values = [c for c in existing.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order, "_old")).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in existing.columns])
