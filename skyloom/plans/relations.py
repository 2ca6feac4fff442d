"""Staging scans, analyst queries, exports and introspection over the published relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.plans.state import Store

STAGED = {
    "granule_inventory": schemas.GRANULE_INVENTORY,
    "grid_latest": schemas.GRID_LATEST,
    "pipeline_run_events": schemas.RUN_EVENTS,
    "region_hour_aggregates": schemas.REGION_HOURS,
    "region_registry": schemas.REGION_REGISTRY,
}


def staged(df: DataFrame, name: str) -> DataFrame:
    """The named staging relation: its columns in their types, nothing else is read."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGED[name].fields])


def staging_views(store: Store, scope: schemas.Scope) -> dict[str, DataFrame]:
    """All staging relations of a scope as temp views ``<scope>_stg_<table>``."""
    found = {name: staged(store.read(name, schema), name) for name, schema in STAGED.items()}
    for name, df in found.items():
        df.createOrReplaceTempView(f"{scope.name}_stg_{name}")
    return found


def relation_columns(spark: SparkSession, names: list[str]) -> DataFrame:
    """table_name, column_name, position of the named tables and views; one that isn't there has no rows."""
    found = [(n, c.name, k) for n in names if spark.catalog.tableExists(n) for k, c in enumerate(spark.catalog.listColumns(n), 1)]
    return spark.createDataFrame(found, "table_name string, column_name string, position int")


def country_history(country_hourly: DataFrame, country: str) -> DataFrame:
    """One country's ready hours, newest first."""
    columns = ["country_code", "observation_hour", "no2_mean", "coverage_fraction", "analysis_ready_region_count", "region_count"]
    return country_hourly.where((F.col("country_code") == country) & F.col("is_analysis_ready")).select(*columns).orderBy(F.desc("observation_hour"))


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header; ``one_file`` for small reports only, as one task then writes all."""
    (df.coalesce(1) if one_file else df).write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)
