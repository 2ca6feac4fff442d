"""Cutting lineage between the rounds of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        local = spark.sparkContext.master.startswith("local")
        folder = "file://" + tempfile.mkdtemp(prefix="skyloom-") if local else spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` in the shared folder: later rounds don't repeat earlier ones."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
