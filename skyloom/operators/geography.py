"""Overlap weights of rectangles on the grid, dominant zones, and region artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.exprs import EARTH_RADIUS_KM, GRID_COLS, GRID_LAT0, GRID_LON0, GRID_ROWS, GRID_STEP


def band_area_km2(south: Column, north: Column, west: Column, east: Column) -> Column:
    """Spherical area between two parallels and two meridians (degrees)."""
    return F.lit(EARTH_RADIUS_KM**2) * F.radians(east - west) * (F.sin(F.radians(north)) - F.sin(F.radians(south)))


def rectangle_weights(rectangles: DataFrame, step: float = GRID_STEP, lat0: float = GRID_LAT0, lon0: float = GRID_LON0, rows: int = GRID_ROWS, cols: int = GRID_COLS) -> DataFrame:
    """grid_row, grid_col, canonical_region_id, overlap_weight of regions given as rectangles.

    ``rectangles``: canonical_region_id, west, south, east, north.  Each one is exploded into
    the cells under its box by row and then by column; a region of any size streams through.
    """
    half = step / 2
    index = lambda c, origin: F.floor((F.col(c) - F.lit(origin - half)) / F.lit(step)).cast("int")
    inside = lambda x, n: F.least(F.greatest(x, F.lit(0)), F.lit(n - 1))
    r = rectangles.withColumn("grid_row", F.explode(F.sequence(inside(index("south", lat0), rows), inside(index("north", lat0), rows))))
    r = r.withColumn("grid_col", F.explode(F.sequence(inside(index("west", lon0), cols), inside(index("east", lon0), cols))))
    low_lat, low_lon = F.lit(lat0) + F.col("grid_row") * step - half, F.lit(lon0) + F.col("grid_col") * step - half
    south, north = F.greatest("south", low_lat), F.least("north", low_lat + step)
    west, east = F.greatest("west", low_lon), F.least("east", low_lon + step)
    area = F.when((north > south) & (east > west), band_area_km2(south, north, west, east)).otherwise(0.0)
    return r.withColumn("overlap_weight", area).where("overlap_weight > 0").select("grid_row", "grid_col", "canonical_region_id", "overlap_weight")


def dominant(df: DataFrame, key: str, candidate: str, area: str) -> DataFrame:
    """The candidate with the largest total area per key; of equal ones the smallest."""
    sums = df.groupBy(key, candidate).agg(F.sum(area).alias("_area"))
    best = sums.groupBy(key).agg(F.max("_area").alias("_top"))
    return sums.join(best, key).where("_area = _top").groupBy(key).agg(F.min(candidate).alias(candidate), F.max("_area").alias(area))


def to_grid(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude", step: float = GRID_STEP) -> DataFrame:
    """Adds the grid_row and grid_col of a position."""
    return df.withColumn("grid_row", F.round((F.col(latitude) - GRID_LAT0) / step).cast("int")).withColumn("grid_col", F.round((F.col(longitude) - GRID_LON0) / step).cast("int"))
