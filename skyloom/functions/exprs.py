"""Column expressions that Spark has no single function for; all stay in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
GRID_ROWS, GRID_COLS, GRID_STEP, GRID_LAT0, GRID_LON0 = 2950, 7750, 0.02, 14.01, -167.99
MISSING_FLAG = -9999

# The ellipsoid and the standard parallel of the equal-area projection.
ELLIPSOID_M, FLATTENING, STANDARD_PARALLEL = 6378137.0, 1 / 298.257223563, 30.0
_E2 = FLATTENING * (2 - FLATTENING)
_SCALE = math.cos(math.radians(STANDARD_PARALLEL)) / math.sqrt(1 - _E2 * math.sin(math.radians(STANDARD_PARALLEL)) ** 2)


def hour_of(ts: Column) -> Column:
    """The start of the hour, without a time zone."""
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """Crossed hour or minute boundaries between two naive timestamps (00:59 to 01:01 is one hour)."""
    seconds = {"hour": 3600, "minute": 60}[unit]
    at = lambda ts: F.unix_seconds(F.date_trunc(unit, ts).cast("timestamp"))
    return ((at(end) - at(start)) / seconds).cast("long")


def local_time(ts: Column, zone: Column) -> Column:
    """A naive UTC timestamp as naive local time in each row's own zone."""
    return F.convert_timezone(F.lit("UTC"), zone, ts)


def finite(x: Column) -> Column:
    """True for numbers; false for null, NaN and infinities."""
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def finite_or_null(x: Column) -> Column:
    return F.when(finite(x), x)


def parse_flags(text: Column) -> Column:
    """'0|1' or '0,1' as an array of int."""
    return F.transform(F.split(text, r"[|,]"), lambda x: F.trim(x).cast("int"))


def array_median(values: Column) -> Column:
    """Median of an array without nulls, interpolated for even sizes; null if empty."""
    s, n = F.sort_array(values), F.size(values)
    low, high = F.get(s, ((n - 1) / 2).cast("int")), F.get(s, (n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def array_mad(values: Column, median: Column) -> Column:
    """Unscaled median absolute deviation of an array from its median."""
    return array_median(F.transform(values, lambda x: F.abs(x - median)))


def robust_z(value: Column, ready: Column, samples: Column, median: Column, mad: Column, least: int) -> Column:
    usable = ready & (samples >= least) & mad.isNotNull() & (mad != 0)
    return F.when(usable, (value - median) / (1.4826 * mad))


def cell_area_km2(latitude: Column, step: float = GRID_STEP) -> Column:
    """Area of a spherical grid cell around its centre's latitude."""
    half = step / 2
    return F.lit(EARTH_RADIUS_KM**2) * F.radians(F.lit(step)) * F.abs(F.sin(F.radians(latitude + half)) - F.sin(F.radians(latitude - half)))


def equal_area_x(longitude: Column) -> Column:
    """Metres east in the cylindrical equal-area projection of the ellipsoid."""
    return F.radians(longitude) * (ELLIPSOID_M * _SCALE)


def equal_area_y(latitude: Column) -> Column:
    """Metres north in the same projection: areas between meridians and parallels are those of the ellipsoid."""
    e, s = math.sqrt(_E2), F.sin(F.radians(latitude))
    q = s / (1 - s * s * _E2) - F.log((1 - s * e) / (1 + s * e)) / (2 * e)
    return q * ((1 - _E2) * ELLIPSOID_M / (2 * _SCALE))


def cell_latitude(row: Column) -> Column:
    return F.lit(GRID_LAT0) + row * F.lit(GRID_STEP)


def cell_longitude(col: Column) -> Column:
    return F.lit(GRID_LON0) + col * F.lit(GRID_STEP)


def cf_time(value: Column, units: Column) -> Column:
    """A number of ``days|hours|minutes|seconds since <time>`` as naive UTC; null if it can't be read, an error without units."""
    parts = F.lower(F.trim(units))
    step = F.regexp_extract(parts, r"^(day|hour|minute|second|hr|min|sec|h|d|s)s? since ", 1)
    seconds = F.when(step.isin("day", "d"), 86400).when(step.isin("hour", "hr", "h"), 3600).when(step.isin("minute", "min"), 60).when(step.isin("second", "sec", "s"), 1)
    since = F.try_to_timestamp(F.upper(F.trim(F.regexp_extract(parts, r" since (.*)$", 1))))
    at = F.timestamp_micros((F.unix_micros(since) + F.round(value * seconds * 1_000_000)).cast("long"))
    return F.when(units.isNull(), F.raise_error(F.lit("a time needs units"))).otherwise(at.cast("timestamp_ntz"))
