"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns
of ``documents``; the last one returns the packed pieces.  An empty input passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import durable
from skyloom.llm.line_dedup import drop_repeated_lines
from skyloom.llm.mixing import mix
from skyloom.llm.near_dedup import near_duplicates
from skyloom.llm.packing import best_fit_packing
from skyloom.llm.toxicity import CUT, score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(*COLUMNS), model).where(F.col("score") < CUT).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; those with no line left go."""
    return drop_repeated_lines(docs.select(*COLUMNS))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    # eqNullSafe keeps documents without an id, which are linked with nothing.
    return docs.select(*COLUMNS).alias("d").join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id"), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens follow the target mix of sources, languages and topics."""
    return mix(docs.select(*COLUMNS)).where("_sampled").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences and offsets."""
    return best_fit_packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("minhash near-dedup", dedup_documents),
    ("mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Classifier, similarity and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each one's result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
