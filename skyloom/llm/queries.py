"""The registered queries of this subpackage: each operator with its production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.line_dedup import line_components

    return line_components(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.packing import best_fit_packing

    return best_fit_packing(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.html_extract import main_text

    return main_text(_table(spark, sf_dir, "pages"))


def op5_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.mixing import mixture

    return mixture(_table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.fingerprints import fingerprints

    return fingerprints(_table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.secrets import scan

    return scan(_table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.embedding_dedup import embedding_duplicates

    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.warc import round_trip

    return round_trip(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.token_alignment import align

    return align(_table(spark, sf_dir, "documents"), digest=True)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.periodic_runs import periodic_runs, rotated, run_digest

    return run_digest(periodic_runs(rotated(_table(spark, sf_dir, "documents"))))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyloom.llm.quality import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from skyloom.llm.oracles import ORACLES

    return dict(ORACLES)
