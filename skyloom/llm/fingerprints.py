"""Document fingerprints: bottom-k sketches of word-shingle hashes, with DataFrame and SQL functions only.

A sketch is the sorted array of the ``K`` smallest distinct 63-bit hashes of a text's shingles.
Sketches of parts merge into the sketch of the whole; two of them estimate resemblance,
containment and the number of distinct shingles (exact for sets of fewer than ``K``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 128
WORDS = 5
SPAN = float(2**63)


def words(text: Column) -> Column:
    """Words of the text in lower case, cut at ASCII white space."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def sketch(words_column: str, k: int = K) -> Column:
    """The bottom-k sketch of a column of words; fewer than five words are one shingle, none give an empty sketch."""
    w = f"`{words_column}`"
    several = f"transform(sequence(0, size({w}) - {WORDS}), i -> shiftrightunsigned(xxhash64({', '.join(f'get({w}, i + {j})' for j in range(WORDS))}), 1))"
    hashes = f"case when size({w}) = 0 then cast(array() as array<bigint>) when size({w}) < {WORDS} then array(shiftrightunsigned(xxhash64({w}), 1)) else {several} end"
    return F.expr(f"slice(sort_array(array_distinct({hashes})), 1, {k})")


def with_sketch(df: DataFrame, text_col: str, name: str, k: int = K) -> DataFrame:
    return df.withColumn(f"_{name}_words", words(F.col(text_col))).withColumn(name, sketch(f"_{name}_words", k)).drop(f"_{name}_words")


def union(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches."""
    both = union(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.greatest(F.size(both), F.lit(1)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(SPAN) / F.greatest(F.element_at(a, -1), F.lit(1)).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, 0 to 1; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_shingles(union(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def encode(a: Column) -> Column:
    """The sketch as a string of 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def merge_sketches(df: DataFrame, keys: list[str], sketch_col: str, k: int = K, parts: int = 64) -> DataFrame:
    """One merged sketch per key, in two steps, so that a hot key's sketches meet in ``parts`` tasks first."""
    several = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_s")))), 1, k).alias("_s")
    salted = df.select(*keys, F.col(sketch_col).alias("_s"), F.pmod(F.xxhash64(sketch_col), F.lit(parts)).alias("_part"))
    # Equal sketches add nothing to each other, so copies are dropped before they meet.
    once = salted.dropDuplicates([*keys, "_part", "_s"]).groupBy(*keys, "_part").agg(several)
    return once.groupBy(*keys).agg(several).withColumnRenamed("_s", sketch_col)


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, extra, bucket, tie: the rows in buckets of the order of doc_id, with the first
    row of the following bucket at each one's end (extra), so that every row's successor lies in
    its own bucket.  One shuffle of the texts; no task sees more than its bucket.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("tie", F.xxhash64("text"))
    buckets = buckets or min(1024, 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # At most 1024 numbers.
    cuts = sorted(set(docs.select(F.col("doc_id").cast("double")).na.drop().approxQuantile("doc_id", [k / buckets for k in range(1, buckets)], 0.2 / buckets)))
    literal = f"array({', '.join(f'{int(c)}L' for c in cuts)})" if cuts else "cast(array() as array<bigint>)"
    placed = rows.withColumn("bucket", F.expr(f"size(filter({literal}, x -> x <= at))")).withColumn("extra", F.lit(0))
    firsts = sorted((r.bucket, r.at) for r in placed.groupBy("bucket").agg(F.min("at").alias("at")).collect())
    follow = [(firsts[(k + 1) % len(firsts)][1], b) for k, (b, _) in enumerate(firsts)]
    follow = spark.createDataFrame(follow, "at long, to int")
    extra = rows.join(F.broadcast(follow), "at").select("doc_id", "text", "at", "tie", F.col("to").alias("bucket"), F.lit(1).alias("extra"))
    return placed.select("doc_id", "text", "at", "tie", "bucket", "extra").unionByName(extra)


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, one row per document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_shingles, next_contained.  The edited text has the last floor(n_chars / 2) code points
    replaced by the first ones of the next document in the order of doc_id (ties by the
    text's hash; after the last comes the first).  A null text is empty, a null doc_id comes first; a single
    document is its own next one; other columns are ignored.
    """
    order = "over (partition by bucket order by extra, at, tie)"
    rows = with_next(docs).withColumn("following", F.expr(f"lead(text) {order}")).withColumn("n_chars", F.length("text").cast("long"))
    m = "cast(n_chars div 2 as int)"
    rows = rows.withColumn("edited", F.expr(f"case when extra = 1 then '' else concat(left(text, cast(n_chars as int) - {m}), left(following, {m})) end"))
    rows = with_sketch(with_sketch(rows, "text", "own", k), "edited", "other", k)
    rows = rows.select("doc_id", "at", "tie", "bucket", "extra", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "other")
    rows = rows.withColumn("after", F.expr(f"lead(own) {order}")).where("extra = 0")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        encode(F.col("own")).alias("fingerprint"),
        encode(F.col("other")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("other"), k).alias("near_edited"),
        resemblance(F.col("own"), F.col("after"), k).alias("near_next"),
        distinct_shingles(F.col("own"), k).alias("n_shingles"),
        containment(F.col("own"), F.col("after"), k).alias("next_contained"),
    )
