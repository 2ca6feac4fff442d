"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Token weights of (source, language, topic) cells are raked to three marginals.  Sources may be
many, so their factors stay in a DataFrame: one cycle is one aggregation over the cells that
returns a number per (language, topic).  Where languages and topics are many too, all factors stay
in DataFrames (``_rake_tables``); both ways make the same steps.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import drop_table, durable

KEEP = 0.7
EVEN = 0.8
CYCLES = 30
TOLERANCE = 1e-6
MAX_SMALL = 10_000  # pairs of language and topic whose masses the driver holds
SEED = "mix-1"


def topic(text: Column) -> Column:
    """A coarse topic from the form of a text: legal, contact, marked, long, short or prose; null is short."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t.rlike(r"(?i)licen[sc]e|copyright|all rights reserved"), "legal")
        .when(t.rlike(r"[\w.]@[\w-]+\.[\w.]|(?i)\btoken\s*=|\d[\d ()-]{8,}\d"), "contact")
        .when(t.rlike(r"[#$%&*!]{2,}"), "marked")
        .when(F.length(t) > 6000, "long")
        .when(F.length(t) < 400, "short")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """Token weight of a text: a quarter of its UTF-8 bytes, one at least."""
    return F.greatest(F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4), F.lit(1)).cast("long")


def _even(sizes: dict, power: float) -> dict:
    total = sum(v**power for v in sizes.values()) or 1.0
    return {k: v**power / total for k, v in sizes.items()}


def _shares(given: dict, sizes: dict) -> dict:
    """Target shares of the values that occur; values without a target keep their own share of the rest."""
    named = {k: max(0.0, given[k]) for k in sizes if k in given}
    rest = {k: v for k, v in sizes.items() if k not in named}
    spare = max(0.0, 1 - sum(named.values()))
    out = named | {k: spare * v / sum(rest.values()) for k, v in rest.items()}
    total = sum(out.values()) or 1.0
    return {k: v / total for k, v in out.items()}


def _goals(cells: DataFrame, axis: str, given: dict | None, power: float) -> DataFrame:
    """(axis, goal) as ``_shares`` or ``_even`` give them, for any number of values."""
    sizes = cells.groupBy(axis).agg(F.sum("n").cast("double").alias("size"))
    if given:
        named = cells.sparkSession.createDataFrame([(k, max(0.0, float(v))) for k, v in given.items()], f"{axis} string, share double")
        sizes = durable(sizes.join(named, axis, "left"), "goals")
        r = sizes.agg(F.coalesce(F.sum("share"), F.lit(0.0)).alias("named"), F.sum(F.when(F.col("share").isNull(), F.col("size"))).alias("rest")).first()
        spare = max(0.0, 1 - r.named) / r.rest if r.rest else 0.0
        sizes = sizes.select(axis, F.coalesce("share", F.col("size") * spare).alias("goal"))
    else:
        sizes = sizes.select(axis, F.pow("size", F.lit(power)).alias("goal"))
    sizes = durable(sizes, "goals")
    total = sizes.agg(F.sum("goal").alias("g")).first().g or 1.0
    return sizes.select(axis, (F.col("goal") / total).alias("goal"))


def _rake_tables(cells: DataFrame, total: int, goals: dict[str, DataFrame], cycles: int) -> tuple[DataFrame, list[float]]:
    """The cycles of ``rake`` with a weight per cell in a table and masses per value in tables."""

    def masses(x: DataFrame, axis: str) -> DataFrame:
        return x.groupBy(axis).agg(F.sum(F.col("w") * F.col("n") / total).alias("m")).join(goals[axis], axis)

    def scaled(x: DataFrame, axis: str) -> DataFrame:
        factor = masses(x, axis).select(axis, F.when(F.col("m") > 0, F.col("goal") / F.col("m")).otherwise(0.0 if axis == "source" else 1.0).alias("f"))
        return x.join(factor, axis).select("source", "lang", "topic", "n", (F.col("w") * F.col("f")).alias("w"))

    x, errors = durable(scaled(cells.select("source", "lang", "topic", "n", F.lit(1.0).alias("w")), "source"), "raked"), []
    for _ in range(cycles):
        off = [masses(x, axis).agg(F.max(F.abs(F.col("m") - F.col("goal"))).alias("e")).first().e for axis in ("lang", "topic")]
        errors.append(max(off))
        if errors[-1] < TOLERANCE:
            break
        before, x = x, durable(scaled(scaled(scaled(x, "lang"), "topic"), "source"), "raked")
        drop_table(before)
    return x.withColumnRenamed("w", "weight"), errors


def rake(cells: DataFrame, langs: dict | None = None, topics: dict | None = None, source_power: float = EVEN, sources: DataFrame | None = None, cycles: int = CYCLES) -> tuple[DataFrame, list[float]]:
    """(cells with column weight, largest error of each cycle).

    ``cells``: source, lang, topic, n (tokens).  Targets are shares: ``langs`` and ``topics`` as dicts,
    ``sources`` as (source, share); where none is given the actual share to the power ``source_power``,
    normalised.  Weight is target mass over actual mass per token, 1 on average.  No number of sources,
    languages, topics or cells is bounded.
    """
    spark = cells.sparkSession
    total = cells.agg(F.sum("n").alias("n")).first().n or 0
    if not total:
        return cells.withColumn("weight", F.lit(1.0)), [0.0]
    by_source = cells.groupBy("source").agg(F.sum("n").alias("size"))
    if sources is not None:
        by_source = by_source.join(sources, "source", "left").withColumn("goal", F.coalesce("share", F.lit(0.0))).drop("share")
    else:
        by_source = by_source.withColumn("goal", F.pow(F.col("size") / total, F.lit(source_power)))
    norm = by_source.agg(F.sum("goal").alias("g")).first().g
    goals = by_source.select("source", (F.col("goal") / norm).alias("goal"))
    small = cells.groupBy("lang", "topic").agg(F.sum("n").alias("n")).limit(MAX_SMALL + 1).collect()
    if len(small) > MAX_SMALL:
        return _rake_tables(cells, total, {"source": goals, "lang": _goals(cells, "lang", langs, source_power), "topic": _goals(cells, "topic", topics, source_power)}, cycles)
    l_size, t_size = {}, {}
    for r in small:
        l_size[r.lang], t_size[r.topic] = l_size.get(r.lang, 0) + r.n, t_size.get(r.topic, 0) + r.n
    l_goal = _shares(langs, l_size) if langs else _even(l_size, source_power)
    t_goal = _shares(topics, t_size) if topics else _even(t_size, source_power)
    # All cells of a source in one row: a source's factor then needs no shuffle.
    rows = durable(cells.join(goals, "source").groupBy("source", "goal").agg(F.collect_list(F.struct("lang", "topic", (F.col("n") / total).alias("n"))).alias("own")), "cells")
    b, c = dict.fromkeys(l_goal, 1.0), dict.fromkeys(t_goal, 1.0)

    def with_factors() -> DataFrame:
        factors = [(k, t, b[k] * c[t]) for k in b for t in c]
        table = spark.createDataFrame(factors, "lang string, topic string, f double")  # at most MAX_SMALL rows
        flat = rows.select("source", "goal", F.explode("own").alias("x")).select("source", "goal", "x.lang", "x.topic", "x.n")
        flat = flat.join(F.broadcast(table), ["lang", "topic"]).withColumn("u", F.col("n") * F.col("f"))
        mass = flat.groupBy("source").agg(F.sum("u").alias("mass"))
        return flat.join(mass, "source").withColumn("w", F.when(F.col("mass") > 0, F.col("goal") / F.col("mass")).otherwise(0.0) * F.col("f"))

    errors = []
    for _ in range(cycles):
        mass = {(r.lang, r.topic): r.m for r in with_factors().groupBy("lang", "topic").agg(F.sum(F.col("w") * F.col("n")).alias("m")).collect()}
        now = {k: sum(m for (x, _), m in mass.items() if x == k) for k in b}
        errors.append(max([abs(now[k] - l_goal[k]) for k in b] + [abs(sum(m for (_, x), m in mass.items() if x == t) - t_goal[t]) for t in c]))
        if errors[-1] < TOLERANCE:
            break
        move = {k: l_goal[k] / now[k] if now[k] else 1.0 for k in b}
        b = {k: v * move[k] for k, v in b.items()}
        now = {t: sum(m * move[k] for (k, x), m in mass.items() if x == t) for t in c}
        c = {t: v * (t_goal[t] / now[t] if now[t] else 1.0) for t, v in c.items()}
    weighted = with_factors().select("source", "lang", "topic", F.col("w").alias("weight"))
    return durable(cells.join(weighted, ["source", "lang", "topic"]), "weights"), errors


def _scale(cells: DataFrame, keep: float) -> float:
    """The factor f with sum(n * min(1, f * weight)) = keep * sum(n), by bisection over a bounded histogram of weights."""
    bins = cells.groupBy(F.round(F.log(F.greatest("weight", F.lit(1e-12))) * 1000).alias("k")).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("weight")) / F.sum("n")).alias("w")).collect()
    total = sum(r.n for r in bins)
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low * high) ** 0.5 if low else high / 2
        if sum(r.n * min(1.0, mid * r.w) for r in bins) < keep * total:
            low = mid
        else:
            high = mid
    return high


def mix(docs: DataFrame, keep: float = KEEP, langs: dict | None = None, topics: dict | None = None, sources: DataFrame | None = None, even: float = EVEN, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with _source, _lang, _topic, _tokens, _weight, _probability and _sampled.

    A document is sampled with probability min(1, f * weight of its cell), where f makes the
    expected kept tokens ``keep`` of all.  The draw is a hash of id, text and ``seed``: the same
    document is drawn alike in every run, and repeated rows share their fate.  Null sources and
    languages are cells of their own ("(none)"); empty and null texts count one token, texts of any length
    are used whole.  An empty table gives an empty result.  A warning tells if raking stopped before all
    marginals were within ``TOLERANCE`` of their targets.
    """
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    rows = docs.withColumns({"_source": none("source"), "_lang": none("lang"), "_topic": topic(F.col(text_col)), "_tokens": tokens(F.col(text_col))})
    cells = durable(rows.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("n")), "mass")
    weighted, errors = rake(cells, langs, topics, even, sources)
    if errors[-1] >= TOLERANCE:
        warnings.warn(f"raking did not settle: a marginal is {errors[-1]:.2g} from its target after {len(errors)} cycles", stacklevel=2)
    factor = _scale(weighted, keep) if not weighted.isEmpty() else 1.0
    named = weighted.select(F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("topic").alias("_topic"), F.col("weight").alias("_weight"))
    # Spark broadcasts the cells only where they are small; else a hot source's rows are split by AQE.
    out = rows.join(named, ["_source", "_lang", "_topic"]).withColumn("_probability", F.least(F.lit(1.0), F.col("_weight") * factor))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))), 1, 13), 16, 10).cast("double") / float(16**13)
    return out.withColumn("_sampled", draw < F.col("_probability"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, sampled of every document."""
    out = mix(docs, **options)
    return out.select(F.col("doc_id"), *[F.col(f"_{c}").alias(c) for c in ("source", "lang", "topic", "tokens", "weight", "probability", "sampled")])
