import random

from pyspark.sql import functions as F

from skyloom.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, lang string, n_chars long, line string, id string"


def shingles(line):
    return {line[k : k + 8] for k in range(max(1, len(line) - 7))}


def brute(docs):
    first, lines = {}, []
    for i, t in sorted(docs, key=lambda d: d[0]):
        for k, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\r").lower()
            if line:
                lines.append(((i, k), line))
    distinct = sorted({x for _, x in lines})
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in distinct:
        for b in distinct:
            if a < b:
                x, y = shingles(a), shingles(b)
                n = len(x & y)
                if n * 100 >= 80 * (len(x) + len(y) - n):
                    parent[find(b)] = find(a)
    for at, line in lines:
        first.setdefault(find(line), at)
    return {at: first[find(line)] for at, line in lines}


def corpus():
    rnd = random.Random(3)
    sentence = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    pool = [sentence(rnd.randint(1, 60)) for _ in range(12)] + [sentence(400)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            line = rnd.choice(pool) if rnd.random() < 0.5 else sentence(rnd.randint(1, 20))
            if rnd.random() < 0.4 and len(line) > 200:
                k = rnd.randrange(len(line))
                line = line[:k] + "Z" + line[k + 1 :]
            lines.append(rnd.choice(["", "  ", "\t"]) + (line.upper() if rnd.random() < 0.2 else line))
        docs.append((i, "\n".join(lines)))
    return docs + [(100, None), (101, ""), (102, " \n\t"), (103, "a\n\nb\na"), (104, "𝒳𝒴 é" * 30), (105, "𝒳𝒴 é" * 30)]


def test_equals_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "en", len(t or ""), "x", "y") for i, t in docs], SCHEMA).repartition(3)
    got = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in ld.line_components(df).collect()}
    want = brute(docs)
    assert got == want
    kept = {k for k, v in want.items() if k == v}
    out = {r.doc_id: r for r in ld.drop_repeated_lines(df).collect()}
    for i, t in docs:
        lines = (t or "").split("\n")
        left = [x for k, x in enumerate(lines) if not x.strip(" \t\r") or (i, k) in kept]
        if any(x.strip(" \t\r") for x in lines) and not any(x.strip(" \t\r") for x in left):
            assert i not in out
        else:
            assert (out[i].text or "") == "\n".join(left) and out[i].n_chars == len(out[i].text or "") and out[i].id == "y"


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(None, "same line"), (1, "same line"), (1, "same line"), (2, "other")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.keep_doc_id, r.kept) for r in ld.line_components(df).collect())
    assert got == [(0, 1, False), (1, 1, False), (1, 1, True), (2, 2, True)]
    assert ld.line_components(df.limit(0)).count() == 0 and ld.drop_repeated_lines(df.limit(0)).count() == 0


def test_lines_of_few_shingles_and_many_characters(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8)))
    passage = " ".join(word() for _ in range(60))
    sentence = " ".join(word() for _ in range(10))
    lines = ["-" * 80, "-" * 200, "-" * 3000, sentence * 4, sentence * 12, sentence * 90, passage[:300], passage[:300] * 2, "=" * 700, "ab" * 900, "ab" * 20, "0" * 70_000]
    docs = list(enumerate(lines))
    got = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in ld.line_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute(docs)
    assert got == want and len(set(want.values())) == 6
    keyed = ld._keys(spark.createDataFrame(docs, "id long, line string"))
    assert keyed.select("id").distinct().count() == len(lines)


def test_recall_at_the_threshold(spark):
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    for n in (17, 137, 457):  # shingles both lines share, with n / 4 more in one of them
        rows = []
        for i in range(1500):
            common = text(n + 7)
            rows += [(2 * i, common), (2 * i + 1, common + text(n // 4))]
        found = {i: set() for i in range(2 * 1500)}
        for r in ld._keys(spark.createDataFrame(rows, "id long, line string")).collect():
            found[r.id].add(r.key)
        assert sum(not found[2 * i] & found[2 * i + 1] for i in range(1500)) <= 4


def test_rows_without_an_id_and_of_one_id_lose_only_their_own_lines(spark):
    rows = [(1, "common"), (None, "unique A\ncommon"), (None, "common\nunique B"), (None, "only C\nunique A"), (7, "seven\ncommon"), (7, "common\neight"), (8, "one place\nx"), (8, "one place\ny")]
    out = ld.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    lines = lambda i: sorted(x for r in out if r.doc_id == i for x in r.text.split("\n"))
    assert lines(None) == ["only C", "unique A", "unique B"]
    assert lines(1) == ["common"] and lines(7) == ["eight", "seven"] and lines(8) == ["one place", "x", "y"]


def test_of_rows_equal_in_everything_one_keeps_its_lines(spark):
    rows = [(3, "a line of its own\nsecond line of it"), (3, "a line of its own\nsecond line of it"), (None, "x y z"), (None, "x y z"), (4, None), (4, None)]
    out = ld.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == [(0, "x y z"), (3, rows[0][1]), (4, ""), (4, "")]


def test_wide_groups_give_the_same_links(spark):
    rnd = random.Random(8)
    words = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n)]
    base, docs = words(60), []
    for i in range(70):
        line = list(base)
        for _ in range(rnd.randint(0, 6)):
            k = rnd.randrange(len(line))
            line[k : k + 1] = rnd.choice([[], words(1), words(2)])
        docs.append((i, " ".join(line)))
    want = brute(docs)
    assert 2 <= len(set(want.values())) < 70
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for limit in (500, 0):
        got = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in ld.line_components(df, open_limit=limit).collect()}
        assert got == want


def test_equal_hashes_of_different_lines(spark):
    rows = [(5, 1, "x"), (5, 9, "y"), (5, 9, "y"), (6, 2, "z")]
    out = ld._apart(spark.createDataFrame(rows, "id long, check long, line string")).collect()
    ids = {r.line: {s.id for s in out if s.line == r.line} for r in out}
    assert ids["x"] == {5} and ids["z"] == {6} and len(ids["y"]) == 1 and not ids["y"] & {5, 6}


def template_groups():
    """Groups of lines around a template: random tails, replaced parts, fragments, sub-templates; ids go on from group to group."""
    rnd = random.Random(21)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    groups = []
    for size in (30, 100, 240):
        for tail in (0.05, 0.15, 0.22, 0.4):
            template, subs = text(size), [text(int(size * tail)) for _ in range(3)]
            lines = {template}
            for k in range(40):
                at, cut = rnd.randrange(size), int(size * tail)
                end = rnd.choice(subs)
                lines.add(
                    [
                        template + text(int(cut * rnd.uniform(0.5, 1.6))),
                        template[:at] + text(cut) + template[at + cut :],
                        template[at // 2 : at // 2 + int(size * rnd.uniform(0.4, 1))],
                        template + end + text(rnd.randint(0, cut)),
                        template[at // 3 :] + end,
                    ][k % 5]
                )
            groups.append(sorted(x.strip() for x in lines if x.strip()))
    return groups


def test_groups_around_a_template_give_all_links_and_nothing_else(spark):
    from skyloom.llm.common import components, durable

    rows, members, want = [], [], {}
    for lines in template_groups():
        start = len(rows)
        parent = list(range(len(lines)))
        find = lambda x: x if parent[x] == x else find(parent[x])  # noqa: E731, B023
        sets = [shingles(x) for x in lines]
        for a in range(len(lines)):
            for b in range(a):
                n = len(sets[a] & sets[b])
                if n * 100 >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    parent[max(find(a), find(b))] = min(find(a), find(b))
        want |= {start + k: start + find(k) for k in range(len(lines))}
        members += [(start + len(lines) // 2, start + k, start + k) for k in range(len(lines))]
        rows += [(start + k, x) for k, x in enumerate(lines)]
    assert len(rows) / 6 < len(set(want.values())) < len(rows) - 50
    texts = spark.createDataFrame(rows, "id long, line string")
    held = spark.createDataFrame(members, "big long, id long, c long")
    for limit in (0, 500):
        edges = durable(ld._group_edges(held, lambda ids: texts.join(ids, "id"), 80, limit))
        found = {r.id: r.component for r in components(edges).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_lines_that_share_but_a_template_do_not_meet(spark):
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    for common, own in ((100, 40), (100, 60), (60, 30)):
        template = text(common)
        texts = spark.createDataFrame([(i, template + text(own)) for i in range(400)], "id long, line string")
        told = ld._told(texts.select(F.lit(0).cast("long").alias("big"), "id", F.col("id").alias("c")), lambda ids: texts.join(ids, "id"))
        assert told.where("160 * h <= 20 * kept and id <> 0").count() == 0
        keys = ld._rare_keys(told, 80)
        pairs = keys.groupBy("key").count().agg(F.sum(F.expr("count * (count - 1)"))).first()[0] or 0
        assert pairs <= 400  # of 159,600


def test_tables_go_when_they_are_used_and_passes_change_nothing(spark, monkeypatch):
    import os

    from skyloom.llm import common

    rows = [(k, "\n".join(f"a line of some length that is much like others, number {(k * j) % 37}" for j in range(5))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, ld.drop_repeated_lines(docs).collect()))
    monkeypatch.setattr(common, "PASS_ROWS", 50)
    folder = common.shared_folder(spark).removeprefix("file://") + "/skyloom"
    before = set(os.listdir(folder))
    assert sorted(map(tuple, ld.drop_repeated_lines(docs).collect())) == want
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert "decisions" in left and not left & {"lines", "places", "bands", "members"}


def test_bitmaps_rule_out_most_pairs_and_none_that_is_similar(spark, monkeypatch):
    import re

    rnd = random.Random(13)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    base, lines = text(300), []
    for k in range(160):  # edits at random, and pairs of near copies of each other
        line = list(lines[-1] if k % 4 == 3 else base)
        for _ in range(1 if k % 4 == 3 else rnd.randint(2, 9)):
            line[rnd.randrange(len(line))] = text(rnd.randint(0, 2))
        lines.append("".join(line))
    sets = [shingles(x) for x in lines]
    similar = {(a, b) for a in range(160) for b in range(a) if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])}
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    told = ld._told(texts.select(F.lit(0).cast("long").alias("big"), "id", F.col("id").alias("c")), lambda ids: texts.join(ids, "id"))
    told = told.join(ld._bitmaps(told), ["big", "id"]).persist()
    assert told.count() >= 159 and "lacks" not in ld._DESCRIBED and "has" not in ld._DESCRIBED
    here = {r.id for r in told.select("id").collect()}
    pairs = ld._in_blocks(told, told, "big", 80).persist()
    met = {(r.a, r.b) for r in pairs.collect()}
    want = {x for x in similar if here >= set(x)}
    assert want and want <= met and len(met) - len(want) < 0.1 * 160 * 159 / 2
    for most in (ld.PASS_PAIRS, 10):
        monkeypatch.setattr(ld, "PASS_PAIRS", most)
        assert {(r.a, r.b) for r in ld._exact(pairs, told, 80).collect()} == want
    assert not re.search(r"Join.*\be#\d+L? = e#", ld._rare_keys(told, 80)._jdf.queryExecution().optimizedPlan().toString())


def test_small_tables_take_few_tasks(spark):
    from skyloom.llm.common import components

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = components(spark.range(400).selectExpr("2 * id + 1 as u", "2 * id as v"))
        assert len(found.inputFiles()) <= 8 and found.where("component = id").count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pairs_meet_bitmaps_before_their_shingles(spark, monkeypatch):
    rnd = random.Random(17)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    lines = ["-" * 80, "-" * 200, "short", "shorter"]
    for size in (60, 300, 1500):
        for k in range(30):  # half of a line in common with the next, none to many edits, repeats
            line = text(size)
            lines += [line, line[: size // 2] + text(size // 2), line + text((k * size) // 60), line * 2, line[: -size // 10] + text(size // 12)]
    sets = [shingles(x) for x in lines]
    pairs = [(a, b) for a in range(len(lines)) for b in range(max(0, a - 6), a)]
    want = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])}
    met, both = [], ld._both
    monkeypatch.setattr(ld, "_both", lambda p, kept: met.append(p.count()) or both(p, kept))
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    found = ld._similar_pairs(spark.createDataFrame(pairs, "a long, b long"), lambda ids: texts.join(ids, "id"), 80)
    assert {(r.a, r.b) for r in found.collect()} == want and len(want) > 100
    assert len(want) <= sum(met) < len(want) + 0.1 * (len(pairs) - len(want))
