"""Shared pieces: tables in the shared folder, and exact components over DataFrame edges."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LONG = 2**63 - 1
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_IDS = 2_000_000  # 16 MB of longs
HEAVY_SHARE, HEAVY_ROWS = 100_000, 2_000
PASS_ROWS, PASSES = 2_000_000, 8  # keys that meet at once, as long as there are no more passes
TASK_ROWS, LEAST_TASKS = 50_000, 8  # rows of a small table that a task takes, tasks that it has all the same


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset a temporary one in local mode (tests), else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        local = spark.conf.get("spark.master", "local").startswith("local")
        folder = "file://" + tempfile.mkdtemp(prefix="skyloom-") if local else spark.conf.get("spark.sql.warehouse.dir")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/skyloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession):
    """Within it Spark deletes the shuffle files of what it runs as soon as that has ended, not at a garbage collection."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks that ran on it, and what
    was computed (also by non-deterministic steps) stays the same for every later reader.
    The write's shuffle files go as soon as it has ended: the table takes their place.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.durable_path = path
    return table


def drop_table(*tables: DataFrame) -> None:
    """Delete tables of ``durable`` that nothing reads any more."""
    for table in (t for t in tables if hasattr(t, "durable_path")):
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.durable_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def rows_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``id`` is among ``ids`` (id long, distinct).

    The ids are counted first: up to ``BROADCAST_IDS`` they are broadcast, so that rows with long
    texts stay where they are read; more of them meet the rows in a shuffle.
    """
    ids = durable(ids, "ids")
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids.hint("merge"), "id", "left_semi")


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of some ``rows`` rows, in no more partitions than these need: each shuffle partition costs a task and a file, however small."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def _state(edges: DataFrame) -> tuple:
    with freed(edges.sparkSession):
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the edges (u, v): one row (id, component) per node that has one.

    Distributed union-find by alternating large-star and small-star steps; every node ends
    up beside the smallest id that it can reach.  Each round is written to the shared
    folder, so the plan stays short.  Loops and nulls are ignored, an empty input gives none.
    """
    e = durable(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _state(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = gathered(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), state[0])
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Gathered before the last shuffle too: a union has the partitions of both its sides.
        stars = gathered(small.unionByName(low.select("u", F.col("m").alias("v"))), state[0])
        before, e = e, durable(gathered(stars.distinct(), state[0]), "edges")
        drop_table(before)
        last, state = state, _state(e)
        if last == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def spanning_edges(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a boolean matrix connects, one fewer than nodes; columns count on from the rows."""
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    n, edges = len(rows), []
    while rows.any():
        root = int(np.flatnonzero(rows)[0])
        front, rows[root] = np.array([root]), False
        while len(front):
            near = np.flatnonzero(linked[front].any(axis=0) & columns)
            columns[near] = False
            edges += [(root, n + int(j)) for j in near]
            front = np.flatnonzero(linked[:, near].any(axis=1) & rows) if len(near) else near
            rows[front] = False
            edges += [(root, int(i)) for i in front]
    return edges


def similar_enough(inter: Column, a: Column, b: Column, percent: int) -> Column:
    """Jaccard similarity of at least ``percent`` / 100, in whole numbers."""
    return inter * 100 >= (a + b - inter) * percent


def verify_pairs(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    ``sets_of(ids)`` gives (id, s array<long>) for the ids in question.  Each set moves once
    to its pairs and once with the pair to the other side; skewed sides are split by AQE.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = durable(sets_of(ids), "sets")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    fits = F.least(F.size("sa"), F.size("sb")) * 100 >= F.greatest(F.size("sa"), F.size("sb")) * percent
    inter = F.when(fits, F.size(F.array_intersect("sa", "sb"))).otherwise(0)
    return both.where(similar_enough(inter, F.size("sa"), F.size("sb"), percent)).select("a", "b")


def _members(keys: DataFrame) -> list[DataFrame]:
    """Tables (key, id, p) of the keys of several ids, p the smallest of them; ``keys``: durable, distinct (key, id).

    Most keys have one id, so what is shuffled is far more than what stays: keys of many rows meet in up to ``PASSES`` passes,
    a part of them each, and the shuffle files of a pass go before the next.
    Those that a sample shows to hold more than 1 / ``HEAVY_SHARE`` of the
    rows, ``HEAVY_SHARE`` at most, are broadcast instead, so their rows stay where they are.
    The sample decides on the way only, the rows are the same either way.
    """
    rows = keys.count()
    sampled = keys.sample(0.01, seed=1).groupBy("key").agg(F.count("*").alias("k")).where(f"k >= {HEAVY_ROWS // 100}")
    heavy = durable(sampled.where(F.col("k") * HEAVY_SHARE >= rows * 0.01).select("key"), "heavy")
    smallest = lambda rows: rows.groupBy("key").agg(F.min("id").alias("p"), F.max("id").alias("q")).where("p < q").select("key", "p")
    light = heavy.isEmpty()
    passes = max(1, min(PASSES, -(-rows // PASS_ROWS)))
    out = []
    for k in range(passes):
        some = keys.select("key", "id") if passes == 1 else keys.select("key", "id").where(f"pmod(key, {passes}) = {k}")
        dealt = (some if light else some.join(F.broadcast(heavy), "key", "left_anti")).repartition("key")
        out.append(durable(dealt.join(smallest(dealt).hint("shuffle_hash"), "key"), "members"))
    if not light:
        hot = keys.select("key", "id").join(F.broadcast(heavy), "key", "left_semi")
        out.append(durable(hot.join(F.broadcast(smallest(hot)), "key"), "members"))
    return out


def _open_keys(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of keys that hold several components, with their component c and the number of open pairs.

    Keys of two members are left out: that pair has been compared.
    """
    held = members.join(found, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    sizes = held.groupBy("key", "c").agg(F.count("*").alias("k"))
    sizes = sizes.groupBy("key").agg(F.max_by("c", F.struct("k", "c")).alias("big"), F.sum("k").alias("m"), F.max("k").alias("top"), F.count("*").alias("parts"))
    sizes = sizes.where("parts > 1 and m > 2").select("key", "big", "m", (F.col("m") - F.col("top")).alias("outside"), ((F.col("m") - F.col("top")) * F.col("m")).alias("open"))
    return durable(held.join(sizes, "key"), "held")


def _linkable(held: DataFrame, sets_of, percent: int) -> DataFrame:
    """The members (key, id) that can still be linked within their key, with n and common.

    n is the size of the set, common how many of its elements any other member has.  Two sets
    share at most the smaller common, so a similarity of percent / 100 needs
    common * (100 + percent) >= percent * (n + n of the other); with the key's smallest n this
    rules members out exactly, without looking at pairs.
    """
    rows = durable(sets_of(held.select("id").distinct()).select("id", F.size("s").alias("n"), F.explode("s").alias("x")), "elements")
    twice = rows.groupBy("x").agg(F.count("*").alias("df")).where("df > 1").select("x")
    common = rows.join(twice, "x").groupBy("id").agg(F.count("*").alias("common"))
    sizes = rows.groupBy("id").agg(F.min("n").alias("n")).join(common, "id", "left").select("id", "n", F.coalesce("common", F.lit(0)).alias("common"))
    known = durable(held.select("key", "id").join(sizes, "id"), "known")
    least = known.groupBy("key").agg(F.min("n").alias("least"))
    fits = F.col("common") * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    return durable(known.join(least, "key").where(fits).drop("least"), "linkable")


def _cross_pairs(members: DataFrame, percent: int | None = None) -> DataFrame:
    """Pairs of one key's members (key, id, c, big) in different components c.

    Everything outside the key's largest component meets all members of that key, so the
    work is in proportion to the pairs that are still open, not to the square of the key.  With
    ``percent`` (and columns n, common) pairs that can't be linked by their counts are left out.
    """
    columns = ["id", "c"] + ["n", "common"] * (percent is not None)
    small = members.where("c <> big").select("key", *[F.col(c).alias(f"_{c}") for c in columns])
    fits = F.col("_c") != F.col("c")
    if percent is not None:
        fits = fits & (F.least("common", "_common") * (100 + percent) >= (F.col("n") + F.col("_n")) * percent)
    met = small.join(members.select("key", *columns), "key").where(fits)
    return met.select(F.greatest("_id", "id").alias("a"), F.least("_id", "id").alias("b")).distinct()


def link_components(
    keys: DataFrame, sets_of, percent: int, open_limit: int, wide_edges, verify=None, rule_out: bool = True, known: DataFrame | None = None
) -> DataFrame:
    """Components (id, component) of items linked by exact set similarity; items without links have no row.

    ``keys``: durable (key, id) of distinct sets; the table goes when its keys have met.

    1. Every band key links its members to its smallest one (a star, never all pairs of a group).
    2. Keys that still hold several components, with up to ``open_limit`` open pairs, give those pairs.
    3. In wider keys, with ``rule_out``, members that can't be linked within their key are ruled out by counts
       (``_linkable``), and the others meet the key's most central member, the one with the largest
       common share. What is open then is enumerated up to ``open_limit`` again; beyond it
       ``wide_edges(members)`` gives edges (u, v) that connect what is linked among the members of the wide keys.

    ``verify(pairs)`` gives the linked ones of the pairs (a, b); by default it compares ``sets_of``.  ``known``: edges (u, v) found before.
    """
    verify = verify or (lambda pairs: verify_pairs(pairs, sets_of, percent))
    parts = _members(keys)
    drop_table(keys)
    members = reduce(DataFrame.unionByName, parts)
    stars = durable(members.where("id <> p").select(F.col("id").alias("a"), F.col("p").alias("b")).distinct(), "stars")
    linked = verify(stars).select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = components(linked if known is None else linked.union(known))
    held = _open_keys(members.select("key", "id"), found)
    drop_table(*parts)
    pairs, tested, tiled = _cross_pairs(held.where(F.col("open") <= open_limit)), stars, False
    edges = found.select(F.col("id").alias("u"), F.col("component").alias("v"))
    wide = held.where(F.col("open") > open_limit)
    if not wide.isEmpty():
        if rule_out:
            left = _linkable(wide, sets_of, percent)
            held = _open_keys(left, found)
            centre = held.groupBy("key").agg(F.max_by(F.struct("id", "c"), F.struct(F.col("common") / F.col("n"), "id")).alias("p"))
            met = held.join(centre, "key").where("c <> p.c").select(F.greatest("id", "p.id").alias("a"), F.least("id", "p.id").alias("b")).distinct()
            more = durable(met.join(stars, ["a", "b"], "left_anti"), "stars")
            tested = stars.union(more)
            found = components(edges.union(verify(more).select("a", "b")))
            edges = found.select(F.col("id").alias("u"), F.col("component").alias("v"))
            held = _open_keys(left, found)
            pairs = pairs.union(_cross_pairs(held.where(F.col("open") <= open_limit), percent))
            wide = held.where(F.col("open") > open_limit)
        if not wide.isEmpty():
            edges, tiled = edges.union(durable(wide_edges(wide), "edges")), True
    pairs = durable(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    if not tiled and pairs.isEmpty():
        return found
    return components(edges.union(verify(pairs).select("a", "b")))
