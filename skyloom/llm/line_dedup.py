"""Line dedup: fuzzy lines by MinHash, with DataFrame and SQL functions only.

Lines that are equal after trimming and lower-casing are one line from the start.  A distinct
line's signature is the sorted array of its ``SKETCH`` smallest shingle hashes (bottom-k MinHash), its
bands are runs of ``RUN`` neighbours in it.  Lines that share a band are candidates; their Jaccard
similarity is computed on their full shingle sets, and distributed union-find joins what is similar
enough.  Of each component the first line (smallest doc_id, then line number) stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import MAX_LONG, PASSES, drop_table, durable, link_components, rows_of

SHINGLE = 8
PERCENT = 80
SKETCH = 64
RUN = 4
BANDS = 20  # runs that a line of more shingles takes as bands, on average
BLOCK = 4096  # places hashed at once, so that very long lines need little memory
GROUP_ROWS = 512
PASS_PAIRS = 100_000  # pairs that meet their differences at once, as long as there are no more passes
WORDS = 16  # of 64 bits each, in a bitmap of differences
PAIRS_A_LINE = 2  # from which on bitmaps of lines cost less than they spare
BROADCAST_BITMAPS = 100_000  # members whose bitmaps (16 MB) are broadcast

_ALL = "9223372036854775807L"


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_id (hash of the whole text), line_no (from 0), row (a number of its own), id, check (hashes of the
    normalised line) and line of every line that isn't blank."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)).alias("doc_id"),
        F.xxhash64(text_col).alias("text_id"),
        F.posexplode(F.split(F.lower(text_col), "\n")).alias("line_no", "line"),  # in lower case at once: a line's end ends a word
    )
    rows = rows.select("doc_id", "text_id", "line_no", F.btrim("line", F.lit(" \t\r ")).alias("line"))
    return rows.where("line <> ''").select(
        "doc_id",
        "text_id",
        "line_no",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("line").alias("id"),
        F.xxhash64(F.lit(1), "line").alias("check"),
        "line",
    )


def _shared(places: DataFrame) -> DataFrame:
    """(id, low) of the ids that several texts share, as told by 128 bits."""
    shared = places.groupBy("id").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high")
    return durable(shared.select("id", "low"), "shared-ids")


def _apart(lines: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """The lines with an id of its own for each text: where two share a 64-bit id, all but one get another."""
    shared = _shared(lines) if shared is None else shared
    if shared.isEmpty():
        return lines
    own = F.when(F.col("check") > F.col("low"), F.xxhash64("check", "id")).otherwise(F.col("id"))
    return lines.join(F.broadcast(shared), "id", "left").withColumn("id", own).drop("low")


def _hashes(units: str, places: str, most: str = _ALL) -> str:
    """SQL for the hashes, up to ``most``, of the shingles of a line in UTF-16BE (so that every place is reached at once)."""
    block = f"sequence(2 * s + 1, 2 * least(s + {BLOCK}, {places}) - 1, 2)"
    hashed = f"transform({block}, i -> xxhash64(substring(t, i, {2 * SHINGLE})))"
    if most != _ALL:
        hashed = f"filter({hashed}, h -> h <= {most})"
    # As a variable of a lambda the line is passed on, as a column it would be copied for every place.
    blocks = f"flatten(transform(sequence(0, {places} - 1, {BLOCK}), s -> {hashed}))"
    if most == _ALL:
        blocks = f"case when {places} <= {BLOCK} then transform(sequence(1, 2 * {places} - 1, 2), i -> xxhash64(substring(t, i, {2 * SHINGLE}))) else {blocks} end"
    return f"transform(array({units}), t -> {blocks})[0]"


def _coded(lines: DataFrame, *others: str) -> DataFrame:
    coded = lines.select(*others, F.expr("encode(line, 'UTF-16BE')").alias("b"))
    return coded.select(*others, "b", F.expr(f"cast(greatest(octet_length(b) div 2 - {SHINGLE - 1}, 1) as int)").alias("n"))


def _once(df: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """Columns computed once a row, also where several later expressions use them."""
    fields = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    return df.select(*keep, F.expr(f"inline(array(struct({fields})))").alias(*columns))


def _keys(lines: DataFrame) -> DataFrame:
    """(id, key) for every band of the distinct lines (id, line).

    Bands are functions of a line's set of shingles alone.  Sets of up to ``SKETCH`` shingles have a run at
    each element, around the end to the beginning; at a similarity of 0.8 one run at least is in
    both.  Larger ones have their smallest ``SKETCH``; which runs become bands is drawn by other bits of the
    first hash, so that similar lines draw alike.  For lines of more than ``BLOCK`` places only hashes up to a bound are
    sorted; if repeats leave too few, all of them are.
    """
    bound = f"case when n <= {BLOCK} then {_ALL} else cast({2 * SKETCH} / cast(n as double) * 18446744073709551616D - 9223372036854775808D as bigint) end"
    smallest = f"slice(array_distinct({{}}), 1, {SKETCH + 1})"
    rows = _once(_coded(lines, "id"), ["id"], b="b", n="n", most=bound)
    # Lambdas are interpreted, and so is what stands around them: sorting has a step of its own, which is compiled.
    rows = _once(rows, ["id", "b", "n"], h=f"case when n <= {BLOCK} then {_hashes('b', 'n')} else {_hashes('b', 'n', 'most')} end")
    rows = _once(rows, ["id", "b", "n"], h="sort_array(h)")
    rows = _once(rows, ["id", "b", "n", "h"], s=smallest.format(f"slice(h, 1, {3 * SKETCH})"))
    rows = _once(rows, ["id", "b", "n"], s=f"case when size(s) <= {SKETCH} and size(h) > {3 * SKETCH} then {smallest.format('h')} else s end")
    rows = _once(rows, ["id"], s=f"case when n > {BLOCK} and size(s) <= {SKETCH} then {smallest.format('sort_array(' + _hashes('b', 'n') + ')')} else s end")
    rows = rows.select("id", "s", F.expr(f"least(size(s), {SKETCH})").alias("m"), F.expr(f"size(s) > {SKETCH}").alias("more"))
    starts = F.expr(f"sequence(0, case when more then m - {RUN} else m - 1 end)")
    rows = rows.select("id", "s", "m", F.explode(starts).alias("i")).where(f"(get(s, i) & 4294967295) < {BANDS} * 4294967296L / m")
    run = ", ".join(f"get(s, (i + {j}) % m)" for j in range(RUN))
    return rows.select("id", F.expr(f"xxhash64({run})").alias("key"))


def _similar(x: str, y: str, percent: int) -> Column:
    return F.expr(f"size(array_intersect({x}, {y})) * 100L >= size(array_union({x}, {y})) * {percent}L")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def _both(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) with x and y, the hashes of both lines' shingles (repeats included); ``kept``: (id, line) of all of them."""
    own = _coded(kept, "id")
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("b").alias("bx"), F.col("n").alias("nx")), "a")
    both = both.join(own.select(F.col("id").alias("b"), F.col("b").alias("by"), F.col("n").alias("ny")), "b")
    return _once(both, pairs.columns, x=_hashes("bx", "nx"), y=_hashes("by", "ny"))


def _line_bitmaps(lines: DataFrame) -> DataFrame:
    """(id, n, bits) of the lines (id, line): n distinct shingles and their bitmap."""
    sets = _once(_once(_coded(lines, "id"), ["id"], h=_hashes("b", "n")), ["id"], s="array_distinct(h)")
    return _bitmaps_of(sets.select("id", F.size("s").alias("n"), F.explode("s").alias("e")), "id", "n")


def _similar_pairs(pairs: DataFrame, texts, percent: int) -> DataFrame:
    """The similar ones of the pairs (a, b), exactly.

    Where lines are in many pairs, bitmaps, made once a line, rule most others out; the pairs left meet their shingles.
    """
    kept = durable(texts(_ids(pairs)), "texts")
    left = pairs.select("a", "b")
    if left.count() >= PAIRS_A_LINE * kept.count():
        maps = durable(_line_bitmaps(kept), "bitmaps")
        met = left.join(maps.withColumnRenamed("id", "a"), "a").join(maps.toDF("b", "_n", "_bits"), "b")
        left = durable(met.where(_may_link(percent)).select("a", "b"), "left")
        drop_table(maps)
    linked = durable(_both(left, kept).where(_similar("x", "y", percent)).select("a", "b"), "linked")
    drop_table(kept, left)
    return linked


def _told(members: DataFrame, texts) -> DataFrame:
    """Members (big, id, c) of wide groups by what they lack of their group's centre and what they have besides.

    The centre is the first line of the group's largest component.  kept counts what a member has of it, so the
    exact similarity of two members follows from these short arrays: their texts meet the centre once
    and never each other.
    """
    once = members.select("big", "id", "c").distinct()
    pairs = once.select(F.col("big").alias("a"), F.col("id").alias("b"), "c")
    sets = [F.expr("array_distinct(x)").alias("x"), F.expr("array_distinct(y)").alias("y")]
    kept = durable(texts(_ids(pairs)), "texts")
    both = _both(pairs, kept)
    full = both.select(F.col("a").alias("big"), F.col("b").alias("id"), "c", *sets)
    sides = [F.array_except("x", "y").alias("lacks"), F.array_except("y", "x").alias("has")]
    told = full.select("big", "id", "c", F.size("x").alias("centre"), F.size("y").alias("n"), *sides)
    told = durable(told.withColumns({"kept": F.expr("centre - size(lacks)"), "h": F.size("has")}), "differences")
    drop_table(kept)
    return told


def _bitmaps(told: DataFrame) -> DataFrame:
    """(big, id, bits): a bitmap of all elements in which a member and its centre differ; two members differ in those that only one of them has."""
    return _bitmaps_of(told.select("big", "id", F.explode(F.concat("lacks", "has")).alias("e")), "big", "id")


def _bitmaps_of(elements: DataFrame, *by: str) -> DataFrame:
    """(*by, bits) of the elements (*by, e), each of which is there once: a bit tells if an odd number of them fall on it.

    Common elements cancel out, so two sets differ in as many elements at least as their bitmaps have different bits, and hardly more as long as
    they differ in fewer than there are bits: most pairs are ruled out, exactly, by rows of a bounded size.
    """
    words = elements.groupBy(*by, F.expr(f"cast(e & {WORDS - 1} as int)").alias("w")).agg(F.expr("bit_xor(shiftleft(1L, cast(shiftright(e, 8) & 63 as int)))").alias("x"))
    columns = [F.expr(f"bit_or(case when w = {k} then x else 0L end)") for k in range(WORDS)]
    return words.groupBy(*by).agg(*[c.alias(f"w{k}") for k, c in enumerate(columns)]).select(*by, F.array(*[f"w{k}" for k in range(WORDS)]).alias("bits"))


def _may_link(percent: int) -> str:
    """SQL that tells if two members may be similar by their bitmaps: x and y are if (100 + percent) * what they differ in <= (100 - percent) * (n of x + n of y)."""
    differ = " + ".join(f"bit_count(get(bits, {k}) ^ get(_bits, {k}))" for k in range(WORDS))
    return f"({differ}) * (100L + {percent}) <= (n + _n) * (100L - {percent})"


_DESCRIBED = ("id", "c", "n", "kept", "h", "bits")


def _bounds(percent: int) -> str:
    """SQL that tells if a member and another one (columns with _) of the same centre may be similar, by their sizes and bitmaps."""
    sizes = " and ".join(f"{x} * (100L + {percent}) >= (n + _n) * {percent}L" for x in ("least(n, _n)", "(least(kept, _kept) + least(h, _h))"))
    return f"{sizes} and {_may_link(percent)}"


def _in_blocks(outside: DataFrame, members: DataFrame, on: str, percent: int) -> DataFrame:
    """Pairs (big, a, b) of lines of ``outside`` and ``members`` with equal ``on`` that may be similar, met in blocks of ``GROUP_ROWS``."""
    parts = members.groupBy(on).agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("parts"))
    dealt = members.select(*{on, "big"}, *_DESCRIBED).join(parts, on).withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) as int)")).drop("parts")
    other = [F.col(k).alias(f"_{k}") for k in _DESCRIBED]
    every = F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    met = outside.select(*{on, "big"}, *_DESCRIBED).join(parts, on).select(*{on, "big"}, every, *other).join(dealt, [*{on, "big", "part"}])
    return met.where(f"_c <> c and {_bounds(percent)}").select("big", F.greatest("id", "_id").alias("a"), F.least("id", "_id").alias("b")).distinct()


def _exact(pairs: DataFrame, told: DataFrame, percent: int) -> DataFrame:
    """The similar ones (a, b) of the pairs (big, a, b), by what both differ in from their centre; in up to ``PASSES`` passes."""
    pairs = durable(pairs, "pairs")
    arrays = told.select("big", F.col("id").alias("a"), "centre", "n", "lacks", "has")
    others = told.select("big", F.col("id").alias("b"), *[F.col(k).alias(f"_{k}") for k in ("n", "lacks", "has")])
    inter = "(centre - size(array_union(lacks, _lacks)) + size(array_intersect(has, _has)))"
    passes = max(1, min(PASSES, -(-pairs.count() // PASS_PAIRS)))
    out = []
    for k in range(passes):
        some = pairs if passes == 1 else pairs.where(f"pmod(xxhash64(a), {passes}) = {k}")
        both = arrays.join(some, ["big", "a"]).join(others, ["big", "b"])
        out.append(durable(both.where(f"{inter} * (100L + {percent}) >= (n + _n) * {percent}L").select("a", "b"), "edges"))
    drop_table(pairs)
    return reduce(DataFrame.unionByName, out)


def _rare_keys(told: DataFrame, percent: int) -> DataFrame:
    """(key, id): for each member the rarest elements that the centre doesn't have, as many as any link needs.

    What the centre can't give of the elements that a link needs has to be among those besides: ``need`` of them for members of a
    class of ``h`` (a quarter of a power of two, from ``low``), so one of the rarest ``h - need + 1`` is in both and makes a key for these two classes.
    Elements that no other member has make no key.
    """
    step = "cast(greatest(0, length(bin(h)) - 3) as int)"
    rows = told.withColumn("low", F.expr(f"shiftleft(shiftright(h, {step}), {step})"))
    classes = rows.where("h > 0").groupBy("big").agg(F.collect_set("low").alias("classes"))
    elements = rows.select("big", "id", F.explode("has").alias("e"))
    often = elements.withColumn("df", F.count("*").over(Window.partitionBy("big", "e"))).where("df > 1")
    shared = often.groupBy("big", "id").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("s"))
    of = rows.select("big", "id", "n", "kept", "h", "low").join(classes, "big")
    need = f"greatest(1, ({percent}L * n + 99) div 100 - kept, ({percent}L * (h + other) - (100 - {percent}) * kept + 99 + {percent}) div (100 + {percent}))"
    # Classes that no link can reach are left out before there is a row for each.
    fits = f"filter(classes, other -> {need} <= h and {need} < 2 * other and other * {percent}L <= n * 100L)"
    of = of.select("big", "id", "n", "kept", "h", "low", F.explode(F.expr(fits)).alias("other")).withColumn("need", F.expr(need))
    first = F.explode(F.expr("slice(s, 1, cast(greatest(0, size(s) - need + 1) as int))")).alias("s")
    keys = shared.join(of, ["big", "id"]).select("big", "id", F.least("low", "other").alias("a"), F.greatest("low", "other").alias("b"), first)
    return keys.select(F.xxhash64("big", "s.e", "a", "b").alias("key"), "id").distinct()


def _group_edges(members: DataFrame, texts, percent: int, open_limit: int) -> DataFrame:
    """Edges (u, v) that connect what is linked among the members (big, id, c) of wide groups, exactly.

    What is similar to the centre joins it.  A pair x, y of the rest can be linked without an element in common besides the
    centre's only if percent * (h of x + h of y) <= (100 - percent) * (the smaller kept).  Such pairs, of which one has half of
    that h at most, are compared in blocks.  All others share one of their rarest elements, which
    become keys of their own, handled as bands are: lines that share but a template don't meet at all.
    """
    first = _told(members, texts)
    near = F.expr(f"kept * (100L + {percent}) >= (centre + n) * {percent}L")
    told = first.withColumn("c", F.when(near, F.col("big")).otherwise(F.col("c")))
    known = members.select(F.col("id").alias("u"), F.col("c").alias("v")).union(told.select("id", "c")).where("u <> v").distinct()
    known = durable(known, "edges")
    open_groups = told.where("c <> big").select("big").distinct()
    all_told, told = first, durable(told.join(open_groups, "big", "left_semi"), "differences")
    drop_table(all_told)
    maps = durable(_bitmaps(told), "bitmaps")
    bits = told.join(maps, ["big", "id"], "left")
    no_bits, told = told, durable(bits.withColumn("bits", F.coalesce("bits", F.expr(f"array_repeat(0L, {WORDS})"))), "differences")
    drop_table(no_bits, maps)
    few = told.count() <= BROADCAST_BITMAPS
    light = told.where(f"{percent}L * h <= (100 - {percent}) * kept")
    half = f"2 * {percent}L * h <= (100 - {percent}) * kept"
    outside = light.where("c <> big")
    close = _in_blocks(outside.where(half), light, "big", percent).union(_in_blocks(outside.where(f"not ({half})"), light.where(half), "big", percent))
    known = durable(known.union(_exact(close, told, percent)), "edges")

    def verify(pairs: DataFrame) -> DataFrame:
        # Pairs meet the bitmaps first, and those that these leave meet the differences.
        maps = told.select("big", F.col("id").alias("a"), "n", "bits")
        others = maps.toDF("big", "b", "_n", "_bits")
        met = pairs.join(F.broadcast(maps) if few else maps, "a").join(F.broadcast(others) if few else others, ["big", "b"])
        return _exact(met.where(f"least(n, _n) * (100L + {percent}) >= (n + _n) * {percent}L and {_may_link(percent)}").select("big", "a", "b"), told, percent)

    def wide_edges(wide: DataFrame) -> DataFrame:
        rows = wide.select("key", "id", "c", F.col("big").alias("largest")).join(told.drop("c", "lacks", "has"), "id")
        return _exact(_in_blocks(rows.where("c <> largest"), rows, "key", percent), told, percent)

    keys = durable(_rare_keys(told, percent), "bands")
    found = link_components(keys, None, percent, open_limit, wide_edges, verify, rule_out=False, known=known)
    drop_table(told)
    return found.select(F.col("id").alias("u"), F.col("component").alias("v"))


def _decisions(docs: DataFrame, percent: int, open_limit: int = 500, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``line_components`` with text_id (doc_id is MAX_LONG where it is null), and the table of places that it reads."""
    split = split_lines(docs, id_col, text_col)
    # Texts are kept once a distinct line, places without them.
    places = durable(split.drop("line"), "places")
    shared = _shared(places)
    distinct = durable(_apart(split, shared).select("id", "line").dropDuplicates(["id"]), "lines")
    keys = durable(_keys(distinct), "bands")

    def texts(ids: DataFrame) -> DataFrame:
        return rows_of(distinct, ids)

    def verify(pairs: DataFrame) -> DataFrame:
        return _similar_pairs(pairs, texts, percent)

    found = link_components(keys, None, percent, open_limit, lambda wide: _group_edges(wide, texts, percent, open_limit), verify, rule_out=False)
    drop_table(distinct)
    labelled = _apart(places, shared).select("doc_id", "text_id", "line_no", "row", "id").join(found, "id", "left")
    labelled = labelled.select("doc_id", "text_id", "line_no", "row", F.coalesce("component", "id").alias("component"))
    first = labelled.groupBy("component").agg(F.min(F.struct("doc_id", "line_no", "text_id", "row")).alias("first"))
    out = labelled.join(first, "component").select(
        "doc_id",
        "text_id",
        "line_no",
        F.col("first.doc_id").alias("keep_doc_id"),
        F.col("first.line_no").alias("keep_line_no"),
        F.expr("row = first.row").alias("kept"),
    )
    return out, places


def line_components(docs: DataFrame, percent: int = PERCENT, open_limit: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that isn't blank: doc_id, line_no, keep_doc_id, keep_line_no, kept.

    Lines are linked when the Jaccard similarity of their distinct 8-character shingles is
    percent / 100 or more (a shorter line is one shingle); keep_* names the first line of
    the component, and exactly one row of each component is kept, also among rows equal in everything.
    Null, empty and blank texts have no lines.  Null ids count as one document behind all others
    (doc_id null); rows that share an id count as one document, whose equal places are told apart
    by a hash of the text.  Lines of any length are used whole.  Other columns are ignored; an
    empty table gives an empty result.
    """
    out, _ = _decisions(docs, percent, open_limit, id_col, text_col)
    return out.select(
        F.nullif("doc_id", F.lit(MAX_LONG)).alias("doc_id"),
        "line_no",
        F.nullif("keep_doc_id", F.lit(MAX_LONG)).alias("keep_doc_id"),
        "keep_line_no",
        "kept",
    )


def drop_repeated_lines(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines that repeat an earlier one; blank lines stay.

    A document of whose lines none is left goes; one that had no lines from the start stays.
    Decisions hold for a row's id and text together: rows without an id, or of one id, with
    different texts lose only their own lines; of rows equal in both, all of whose lines are
    repeats but for one row, one is left.  n_chars follows the text where that column exists; all other
    columns are carried.  Null and empty texts stay as they are; an empty table gives an empty result.
    """
    found, places = _decisions(docs, percent, id_col=id_col, text_col=text_col)
    result = durable(found, "decisions")
    drop_table(places)
    key = [F.col("doc_id").alias("_key"), F.col("text_id").alias("_text_id")]
    # A document's lines fit one row, as its text does.  A place of which any row is kept is no repeat.
    places = result.groupBy("doc_id", "text_id", "line_no").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = places.where("not kept").groupBy(*key).agg(F.collect_set("line_no").alias("_gone"))
    keyed = docs.withColumns({"_key": F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)), "_text_id": F.xxhash64(text_col)})
    copied = durable(places.where("n > 1").select(*key).distinct(), "copied")
    if not copied.isEmpty():
        single = keyed.join(copied, ["_key", "_text_id"], "left_anti")
        keyed = single.unionByName(keyed.join(copied, ["_key", "_text_id"], "left_semi").dropDuplicates(["_key", "_text_id"]))
    joined = keyed.join(gone, ["_key", "_text_id"], "left")
    keep = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(keep, "\n"))
    out = joined.withColumn("_text", text).where(F.col("_gone").isNull() | F.col("_text").rlike(r"[^ \t\r\n]"))
    changes = {text_col: F.col("_text")}
    if "n_chars" in docs.columns:
        length = F.length("_text").cast(dict(docs.dtypes)["n_chars"])
        changes["n_chars"] = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(length)
    return out.select(*[changes.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
