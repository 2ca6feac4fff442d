import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skyloom.functions import exprs


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_boundaries_count_crossings(spark):
    r = one(spark, exprs.boundaries("hour", ts("2024-01-01 00:59:00"), ts("2024-01-01 01:01:00")), exprs.boundaries("minute", ts("2024-01-01 00:59:59"), ts("2024-01-01 01:01:00")), exprs.boundaries("hour", ts("2024-01-01 01:01:00"), ts("2024-01-01 00:59:00")))
    assert list(r) == [1, 2, -1]


@pytest.mark.parametrize(("utc", "zone", "local"), [("2026-03-01 21:00:00", "America/Los_Angeles", 13), ("2026-03-15 20:00:00", "America/Los_Angeles", 13)])
def test_local_time_follows_daylight_saving(spark, utc, zone, local):
    got = one(spark, exprs.local_time(ts(utc), F.lit(zone)))[0]
    assert got.hour == local and isinstance(got, dt.datetime)


def test_median_and_mad(spark):
    values = F.array(*[F.lit(float(x)) for x in range(1, 8)])
    r = one(spark, exprs.array_median(values).alias("m"), exprs.array_mad(values, F.lit(4.0)).alias("d"))
    assert (r.m, r.d) == (4.0, 2.0)
    even = F.array(F.lit(1.0), F.lit(4.0))
    assert one(spark, exprs.array_median(even))[0] == 2.5
    assert one(spark, exprs.array_median(F.array().cast("array<double>")))[0] is None


def test_robust_z(spark):
    z = lambda n, mad: exprs.robust_z(F.lit(8.0), F.lit(True), F.lit(n), F.lit(4.0), mad, 7)
    r = one(spark, z(7, F.lit(2.0)), z(6, F.lit(2.0)), z(7, F.lit(0.0)))
    assert r[0] == 1.3489815189531904 and r[1] is None and r[2] is None


def test_finite(spark):
    values = [1.0, None, math.nan, math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(exprs.finite(F.col("x"))).collect()] == [True, False, False, False, False]


def test_flags(spark):
    assert one(spark, exprs.parse_flags(F.lit("0|1")), exprs.parse_flags(F.lit("0, 1")))[:] == ([0, 1], [0, 1])
