"""Operators whose work follows the input where a plain join would make all pairs of a block, against brute force."""

import math
import random

from pyspark.sql import functions as F

from quillgraph.operators import nearest, relational


def rows(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)


def test_preferred_against_brute_force(spark):
    rng = random.Random(5)
    place = lambda n: rng.choice([None, *range(n)])
    left = [(k, k % 6, place(5)) for k in range(60)] + [(3, 3, 1), (3, 3, 9)]
    right = [(i % 5, place(4), i) for i in range(25)] + [(5, None, 99)]
    got = relational.preferred(spark.createDataFrame(left, "k long, b long, p long"), spark.createDataFrame(right, "b long, p long, c long"), "k", "b", "p", "c")
    met = [(k, c, None if p is None or q is None else p == q) for k, b, p in left for d, q, c in right if b == d]
    some = {k: any(h for j, _, h in met if j == k and h is not None) for k in {m[0] for m in met if m[2] is not None}}
    assert rows(got) == sorted(((k, c) for k, c, h in met if h or some.get(k) is False), key=repr)
    # the pairs of a block aren't made to be sorted by key: what is sorted is rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan[: plan.index("Join")]


def test_dealt_join_has_every_pair(spark):
    a = spark.range(200).select("id", (F.col("id") % 3).alias("b"))
    b = spark.range(90).select(F.col("id").alias("other"), (F.col("id") % 3).alias("b"))
    got = relational.dealt_join(a, b, ["b"], "id", 5)
    assert rows(got, "id", "other") == sorted(((i, j) for i in range(200) for j in range(90) if i % 3 == j % 3), key=repr)


def drawn(n, seed, size):
    """Points and sites in three blocks, some values shared by many, some close together, some null."""
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 0.0, 5.0, 5.1, *(round(rng.uniform(-size, size), 2) for _ in range(12))])
    return [(i, i % 3, value()) for i in range(n)]


POINT, SITE = "p long, b long, x double", "s long, b long, y double"


def likeness(a, b):
    return F.floor(100 * (1 - F.abs(a - b) / 50)) / 100


def plain_likeness(a, b):
    return None if a is None or b is None else math.floor(100 * (1 - abs(a - b) / 50)) / 100


def test_nearest_against_brute_force(spark):
    for size, k in ((40, 3), (3, 2), (400, 1)):
        points, sites = drawn(40, size, size), drawn(150, size + 1, size)
        got = nearest.nearest(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), "b", "x", "y", "s", likeness, k)
        want = set()
        for _, b, x in points:
            met = sorted(((plain_likeness(x, y), s) for s, c, y in sites if c == b), key=lambda t: (t[0] is None, -(t[0] or 0), t[1]))
            want |= {(b, x, s, v) for v, s in met[:k]}
        assert rows(got, "b", "x", "s", "score") == sorted(want, key=repr)
    none = nearest.nearest(spark.createDataFrame([], POINT), spark.createDataFrame(sites, SITE), "b", "x", "y", "s", likeness, 2)
    assert none.count() == 0


def test_within_against_brute_force(spark):
    points, sites = drawn(60, 7, 60), drawn(90, 8, 60)
    got = nearest.within(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), "b", "x", "y", "s", likeness, [(0.98, 1.0), (0.9, 5.0), (0.5, 25.0)])
    want = set()
    for _, b, x in points:
        if x is not None:
            inside = [[s for s, c, y in sites if c == b and y is not None and plain_likeness(x, y) >= least] for least in (0.98, 0.9, 0.5)]
            want.add((b, x, tuple(map(len, inside)), tuple(i[0] if len(i) == 1 else None for i in inside)))
    assert sorted(((r[0], r[1], tuple(r[2]), tuple(r[3])) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_nearest_in_turn_as_all_pairs_in_turn(spark):
    from quillgraph.operators import identity

    for size in (3, 40, 200):
        points, sites = (spark.createDataFrame(drawn(90, size + i, size), s) for i, s in ((2, POINT), (3, SITE)))
        pairs = points.join(sites, "b").withColumn("score", likeness(F.col("x"), F.col("y")))
        want = identity.one_to_one(pairs, "b", "p", "s", "score", 0.8)
        got = nearest.nearest_in_turn(points, sites, "b", "p", "s", "x", "y", lambda a, b: math.floor(100 * (1 - abs(a - b) / 50)) / 100, 0.8)
        assert rows(got, "b", "p", "s", "fate") == rows(want, "b", "p", "s", "fate")


def test_ranked_queries_make_no_pairs_of_a_nation(spark, small, monkeypatch):
    from quillgraph import catalog
    from quillgraph.plans import tables

    def refuse(*_):
        raise AssertionError("all pairs of a nation")

    monkeypatch.setattr(tables, "_candidates", refuse)
    for name in ("blocked_score_rank", "margin_gate", "conflict_demote", "tier_match", "evidence_score", "alias_then_tier"):
        assert catalog.queries()[name](spark, small).count(), name


def test_leftover_fates_compare_a_name_once_for_all_copies(spark):
    from quillgraph.operators import gates

    calls = spark.sparkContext.accumulator(0)

    def counted(a, b):
        calls.add(1)
        return 1.0 if a[:2] == b[:2] else 0.0

    like = F.udf(counted, "double")
    copies = 30
    left = [(c * 10 + i, 1, "QC" if i == 3 else "N", 4, "7", n, b, "12") for c in range(copies) for i, (n, b) in enumerate([("moose", "aa"), ("xx", "aa"), ("zz", None), ("elk lake", None)])]
    known = [(c * 10 + i, r, "9", n, "aa", a) for c in range(copies) for i, (r, n, a) in enumerate([("N", "moose", "99"), ("N", "yy", "12"), ("QC", "elk", "99")])]
    rows_ = spark.createDataFrame(left, "id long, edition long, region string, page long, no string, name string, band string, acres string")
    registry = spark.createDataFrame(known, "entry long, region string, no string, name string, band string, acres string")
    matched = spark.createDataFrame([(1, 6, "7", "zz top", 5), (1, 5, "7", "zz", 8)], "edition long, page long, no string, name string, entry long")
    one = known[:3]
    for registry_, fate in ((registry, "absence_candidate"), (spark.createDataFrame(one, registry.schema), "renumbered_link")):
        before = calls.value
        got = gates.leftover_fates(rows_, matched, registry_, like=lambda a, b: like(a, b)).collect()
        assert calls.value - before < 100
        told = {(r.id % 10, r.disposition, r.proposed) for r in got}
        # two entries of the like band reach the first row, by name and by acres; one reaches the second, by acres
        want = {(0, "absence_candidate", None), (1, fate, 1 if fate == "renumbered_link" else None), (2, "duplicate_emission", 5), (3, fate, 2 if fate == "renumbered_link" else None)}
        assert len(got) == len(left) and told == want


def test_person_score_of_known_surnames(spark):
    from quillgraph.functions import similarity as S

    made = spark.createDataFrame([("smith", "smyth", "j", "jh"), ("bell", "cole", "a", "a")], "a string, b string, i string, k string")
    none = F.array().cast("array<string>")
    x, y = F.array("a"), F.array("b")
    both = made.withColumn("s", S.surname_score(x, y)).select(S.person_score(x, y, F.col("i"), F.col("k"), none, none), S.person_score_of(F.col("s"), F.col("i"), F.col("k"), none, none))
    assert all(p == q for p, q in both.collect())


def test_edition_links_with_copies_as_all_pairs_in_turn(spark):
    from quillgraph.operators import editions, identity

    rng = random.Random(11)
    side = lambda i: (rng.choice("NS"), str(rng.randrange(6)), rng.choice(["moose lake", "moose lakes", "elk", "", None]), rng.choice(["cree", "crees", None]), "d", rng.choice([None, 10.0, 10.004, 25.0]))
    entries = [side(i) for i in range(40)]
    registry = spark.createDataFrame([(i, *x) for i, x in enumerate(entries + entries[:12] * 3)], "entry long, region string, no string, name string, band string, division string, acres double")
    printed = spark.createDataFrame([(i, i % 2, *side(i)) for i in range(120)], "id long, edition long, region string, no string, name string, band string, division string, acres double")
    pairs = editions.candidates(printed, registry).withColumn("slot", F.concat_ws("/", "edition", "entry")).withColumn("o", F.col("id")).localCheckpoint()
    took = {r.id: (r.slot, r.fate) for r in identity.taken_in_turn(pairs, "id", "slot", "o", "score").collect()}
    got = editions.edition_links(printed, registry).collect()
    assert len(got) == 120 and {"assigned", "ambiguous"} <= {f for _, f in took.values()}
    for r in got:
        slot, fate = took.get(r.id, (None, "unmatched"))
        assert (f"{r.edition}/{r.entry}" if r.entry is not None else None) == slot
        assert fate == "assigned" if r.entry is not None else r.tier == fate


def test_editions_compare_two_texts_once(spark, monkeypatch):
    from quillgraph.operators import editions

    calls, plain = spark.sparkContext.accumulator(0), editions.likeness

    def counted(a, b):
        @F.udf("double")
        def f(v):
            calls.add(1)
            return v

        return f(plain(a, b))

    monkeypatch.setattr(editions, "likeness", counted)
    side = "region string, no string, name string, band string, division string, acres double"
    registry = spark.createDataFrame([(i, "N", "4", "moose", "cree", "d", float(i % 5)) for i in range(60)], f"entry long, {side}")
    printed = spark.createDataFrame([(i, 1, "N", "4", "moose", "cree", "d", float(i % 7)) for i in range(60)], f"id long, edition long, {side}")
    assert editions.edition_links(printed, registry).where("tier = 'ambiguous'").count() == 60
    assert calls.value < 60


def test_pruned_as_member_by_member_and_folds_no_members(spark):
    from quillgraph.operators import linking

    rng = random.Random(2)
    made = [(g, f"m{i}", f := rng.randrange(1990, 1996), f + rng.randrange(3), rng.randrange(4), rng.choice(["a", "b", None])) for g in "xy" for i in range(80)]
    frame = linking.pruned(spark.createDataFrame(made, "g string, m string, f long, l long, w long, c string"), "g", "m", "f", "l", "w", "c")
    want = set()
    for g in "xy":
        kept = []
        for _, m, f, last, w, c in sorted((r for r in made if r[0] == g), key=lambda r: (-r[4], r[2], r[1])):
            fits = all(last < a or b < f or c is None or d is None or c == d for a, b, d in kept)
            kept += [(f, last, c)] if fits else []
            want.add((g, m, fits))
    assert {tuple(r) for r in frame.collect()} == want and len({w[2] for w in want}) == 2
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan[: plan.index("aggregate(")]


def test_editions_of_unlike_entries_make_no_pairs(spark):
    """Entries of one number that print differently, and rows without a region or an edition, against all pairs in turn."""
    from quillgraph.operators import editions, identity

    rng = random.Random(4)
    word = lambda: rng.choice(["red", "moose", "lake", "bank", "elk", "hills", "ekal", "knab"])
    side = lambda: (rng.choice(["N", "N", "N", None]), rng.choice(["1", "1", "2", "", None]), f"{word()} {word()} {word()}", rng.choice(["cree", "crees", "sioux", "", None]), f"{word()} {word()}", rng.choice([None, *(round(rng.uniform(5, 9), 2) for _ in range(9))]))
    fields = "region string, no string, name string, band string, division string, acres double"
    known = [(i, *side()) for i in range(240)]
    like = lambda k, i: k[1:] if i % 4 else (k[1], k[2], "zzz", None, *k[5:])
    printed = [(i, rng.choice([1, 1, 2, None]), *(side() if i % 2 else like(rng.choice(known), i))) for i in range(400)]
    rows_, registry = spark.createDataFrame(printed, f"id long, edition long, {fields}"), spark.createDataFrame(known, f"entry long, {fields}")
    pairs = editions.candidates(rows_, registry).withColumn("slot", F.concat_ws("/", F.coalesce("edition", F.lit(0)), "entry")).localCheckpoint()
    took = identity.taken_in_turn(pairs.withColumn("o", F.col("id")), "id", "slot", "o", "score")
    won = took.where("fate = 'assigned'").join(pairs, ["id", "slot"]).select("id", "entry", "tier", "score").collect()
    want = {i: (e, None, "unmatched") for i, e, *_ in printed} | {r.id: (printed[r.id][1], None, "ambiguous") for r in took.where("fate = 'ambiguous'").collect()}
    want |= {r.id: (printed[r.id][1], r.entry, r.tier) for r in won}
    frame = editions.edition_links(rows_, registry)
    got = frame.collect()
    assert {r.id: (r.edition, r.entry, r.tier) for r in got} == want and len(got) == 400
    assert {(r.id, round(r.score, 9)) for r in got if r.score is not None} == {(r.id, round(r.score, 9)) for r in won}
    assert {r.tier for r in got} >= {"T1", "T2", "T3", "T4", "T5", "ambiguous", "unmatched"}
    # rows and entries of a region meet as one group, not by number, name or size
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in text and "_k" not in text


def test_editions_compare_few_texts(spark):
    import pandas as pd

    from quillgraph.operators import editions

    n = 300
    name = lambda i: "".join("abcdefghijklmnopqrstuvwxyz"[i // 26**k % 26] * (k + 2) for k in range(2))
    made = pd.DataFrame({"no": "7", "name": [name(i) for i in range(n)], "band": "cree", "division": "d", "acres": [float(i) for i in range(n)], "entry": range(n), "_several": False, "_x_only": True, "_r_only": True})
    editions._like.cache_clear()
    assert [e for e, *_ in editions._in_turn(made, made)] == list(range(n))
    assert editions._like.cache_info().misses < 3 * n


def test_initials_as_numbers_score_as_texts(spark):
    from quillgraph.functions import similarity as S

    rng = random.Random(9)
    words = ["", "0", "9z", "z9", "abcdef", "fedcba", "abcdeg", "aab", "abb", "ba", "z", *("".join(rng.choice("019abz") for _ in range(rng.randrange(7))) for _ in range(150))]
    side = lambda c: spark.createDataFrame([(w,) for w in dict.fromkeys(words)], f"{c} string").withColumn(f"{c}_", F.struct(*S.initials_code(F.col(c))))
    pairs = side("a").crossJoin(side("b"))
    got = pairs.select(F.get(F.array(*map(F.lit, S.INITIALS)), S.initials_rule(F.col("a_"), F.col("b_"))).alias("got"), S.initials_score(F.col("a"), F.col("b")).alias("want")).groupBy("want").agg(F.count_if(F.col("got") != F.col("want")), F.count("got"))
    assert {r[0]: r[1] for r in got.collect()} == dict.fromkeys(S.INITIALS, 0)
    other = spark.createDataFrame([("abcdefg",), ("A",), ("é",), ("a b",), ("a\n",), (None,)], "a string").select(*S.initials_code(F.col("a")))
    assert {tuple(r) for r in other.collect()} == {(None,) * 4}


def test_person_score_of_odd_names_and_of_many_of_a_surname(spark, tmp_path):
    from quillgraph import catalog
    from quillgraph.functions import similarity as S

    names = ["Customer#000012345", "x#000012543", "#000012435", "#00001234é", "#000012A45", "#000012", None, "ab", "#00001234\n", "#000912345"]
    spark.createDataFrame([(i, n, i % 2, 0.0, "M") for i, n in enumerate(names + names[:4])], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, n, k, 0.0) for i, n in enumerate(names) for k in (0, 1)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    frame = catalog.queries()["person_score"](spark, str(tmp_path))
    got = [tuple(r) for r in frame.collect()]
    last = lambda t, c, n: spark.read.parquet(f"{tmp_path}/{t}.parquet").select(F.col(n).alias("nation"), F.right(F.lower(c), F.lit(9)).alias(t[0])).distinct()
    none, part = F.array().cast("array<string>"), lambda c: F.array(F.concat(F.lit("s"), F.substring(c, 1, 6)))
    pairs = last("customer", "c_name", "c_nationkey").join(last("supplier", "s_name", "s_nationkey"), "nation")
    want = pairs.select("nation", "c", "s", F.round(S.person_score_of(S.surname_score(part("c"), part("s")), F.substr("c", F.lit(7)), F.substr("s", F.lit(7)), none, none), 6))
    assert sorted(got, key=repr) == sorted((tuple(r) for r in want.collect()), key=repr) and len({r[3] for r in got}) > 4


def test_pairs_are_counted_by_what_rows_stand_for(spark):
    a = spark.range(20).select("id", F.lit(1).alias("b"), F.lit(50).alias("n"))
    b = spark.range(4).select(F.col("id").alias("other"), F.lit(1).alias("b"), F.lit(50).alias("m"))
    got = relational.dealt_join(a, b, ["b"], "id", 10_000, ("n", "m"))
    assert got.count() == 80 and ", 36" in got._jdf.queryExecution().optimizedPlan().toString()  # 200,000 pairs


def test_pairs_of_like_values_lie_together(spark, monkeypatch):
    monkeypatch.setattr(relational, "AGAIN", 10)
    rng = random.Random(7)
    left = [(i, None if i == 5 else i // 80, rng.choice([None, *map(float, range(30))])) for i in range(160)]
    right = [(i, i % 2, rng.choice([None, 1.0, 2.0])) for i in range(12)]
    a, b = spark.createDataFrame(left, "id long, b long, x double"), spark.createDataFrame(right, "other long, b long, y double")
    parts = relational.dealt_join(a, b, ["b"], "id", 200, near=("x", "y")).select("id", "other", "b", "x", "y").rdd.glom().collect()
    got = [tuple(r) for part in parts for r in part]
    assert sorted(got, key=repr) == sorted(((i, j, k, x, y) for i, k, x in left for j, m, y in right if k == m), key=repr)
    low = lambda v: -1.0 if v is None else v
    runs, met = 0, {}
    for part in parts:
        last = None
        for i, j, _, x, _ in part:
            runs += j != last
            met.setdefault((runs, j), []).append((i, low(x)))
            last = j
    assert runs <= 2 * 6 * 8  # one run of a right row for each part of its key, of ten rows on the left at most
    assert all(len(v) <= 10 and [x for _, x in v] == sorted(x for _, x in v) for v in met.values())
    # a part's values are neighbours: no other value of the key lies between them but those of its own
    for v in {frozenset(v) for v in met.values()}:
        k, low_, high = left[next(iter(v))[0]][1], min(x for _, x in v), max(x for _, x in v)
        assert {(i, low(x)) for i, m, x in left if m == k and low_ < low(x) < high} <= v
