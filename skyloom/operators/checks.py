"""Relation checks: each returns the violating rows, or a table of findings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.exprs import boundaries


def duplicate_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their count n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def outside_unit_interval(df: DataFrame, column: str = "coverage_fraction") -> DataFrame:
    return df.where((F.col(column) < 0) | (F.col(column) > 1))


def negative(df: DataFrame, column: str = "no2_mean") -> DataFrame:
    return df.where(F.col(column) < 0)


def unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, repeats counted, with the side."""
    columns = left.columns
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def unsorted(df: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Rows of Parquet files that stand right behind a greater (with ``strict``: or equal) key of their file.

    Neighbours meet by an equi-join on their place in the file, so no task has to see a whole file.
    """
    rows = df.select(F.struct(*keys).alias("_key"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    last = rows.select(F.col("_key").alias("_last"), "_file", (F.col("_at") + 1).alias("_at"))
    met = rows.join(last, ["_file", "_at"])
    return met.where((F.col("_last") >= F.col("_key")) if strict else (F.col("_last") > F.col("_key"))).select("_key.*")


def freshness(df: DataFrame, column: str, as_of: dt.datetime, warn_hours: int, error_hours: int) -> DataFrame:
    """One row: newest value, its age in crossed hours, and pass, warn or error (error if empty)."""
    newest = df.agg(F.max(column).alias("newest"))
    age = boundaries("hour", F.col("newest"), F.lit(as_of).cast("timestamp_ntz"))
    state = F.when(age.isNull() | (age >= error_hours), "error").when(age >= warn_hours, "warn").otherwise("pass")
    return newest.select("newest", age.alias("age_hours"), state.alias("state"))


def relation_report(df: DataFrame, name: str, required: list[str], keys: list[str], coverage: str | None = None, severity: str | None = None) -> list[dict]:
    """Existence of columns, unique grain, coverage range and error findings of one relation."""
    missing = [c for c in required if c not in df.columns]
    out = [{"relation": name, "check": "columns", "ok": not missing, "found": len(missing)}]
    if missing:
        return out
    counts = {"grain": duplicate_grain(df, keys).count()}
    if coverage:
        counts["coverage"] = outside_unit_interval(df, coverage).count()
    if severity:
        counts["errors"] = df.where(F.col(severity) == "error").count()
    return out + [{"relation": name, "check": k, "ok": n == 0, "found": n} for k, n in counts.items()]
