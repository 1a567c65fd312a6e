"""Decisions by joined evidence against plain Python."""

import itertools
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.functions import similarity as S
from quillgraph.operators import chunks, editions, identity, kinds, papers, series, staff
from quillgraph.plans import evidence
from quillgraph.sources import readers


def rows(frame, *columns):
    return sorted([tuple(r[c] for c in columns or frame.columns) for r in frame.collect()], key=str)


# ---- turns and clusters


def plain_turns(pairs, open_ties=True):
    """(left, right, fate) by a loop in order."""
    used, out, best = set(), [], {}
    for left, right, order, score in pairs:
        best[order, left, right] = max(score, best.get((order, left, right), score))
    for (_, left), mine in itertools.groupby(sorted(best, key=lambda k: k[:2]), key=lambda k: k[:2]):
        free = sorted([(-best[k], k[2]) for k in mine if k[2] not in used])
        if not free:
            out.append((left, None, "unmatched"))
        elif open_ties and len(free) > 1 and abs(free[0][0] - free[1][0]) < 1e-9:
            out.append((left, None, "ambiguous"))
        else:
            used.add(free[0][1])
            out.append((left, free[0][1], "assigned"))
    return sorted(out, key=str)


@pytest.mark.parametrize("open_ties", [True, False])
def test_turns(spark, open_ties):
    import random

    rng = random.Random(3)
    pairs = [(i, f"r{rng.randrange(25)}", (i * 7) % 40, rng.choice([1.0, 1.5, 2.25])) for i in range(40) for _ in range(rng.randrange(4))]
    frame = spark.createDataFrame([*pairs, (None, "r1", 1, 9.0), (99, None, 1, 9.0), (98, "r2", 1, None)], "l long, r string, o int, s double")
    assert rows(identity.taken_in_turn(frame, "l", "r", "o", "s", open_ties=open_ties)) == plain_turns(pairs, open_ties)
    got = identity.taken_in_turn(frame.withColumn("b", F.lit("x")), "l", "r", "o", "s", "b", open_ties)
    assert rows(got, "l", "r", "fate") == plain_turns(pairs, open_ties)
    assert identity.taken_in_turn(frame.limit(0), "l", "r", "o", "s").count() == 0


def test_numbers_in_order(spark):
    frame = spark.createDataFrame([(i * 37 % 101, "x") for i in range(101)], "k int, x string").repartition(7)
    assert rows(identity.numbered(frame, ["k"]), "k", "number") == sorted([(k, k + 1) for k in range(101)], key=str)
    assert rows(identity.minted(spark.createDataFrame([("b",), (None,), ("b",), ("a",)], "k string"), ["k"], "z")) == [("a", "z00002"), ("b", "z00003"), ("b", "z00003"), (None, "z00001")]


def plain_clusters(names, near):
    groups = []
    for n in names:
        for g in groups:
            if all(near(n, m) for m in g):
                g.append(n)
                break
        else:
            groups.append([n])
    return {n: i for i, g in enumerate(groups) for n in g}


def test_complete_linkage(spark):
    import random

    rng = random.Random(5)
    keys = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(60)})
    grams = lambda s: [s[i : i + 2] for i in range(len(s) - 1)]

    def near(a, b):
        x, y = grams(a), grams(b)
        return 2 * sum(min(x.count(g), y.count(g)) for g in set(x)) / (len(x) + len(y)) >= 0.6 if x and y else False

    want = plain_clusters(sorted(keys, key=lambda s: (-len(s), s)), near)
    got = identity.complete_linkage(spark.createDataFrame([("p", k) for k in [*keys, *keys, None]], "p string, k string"), "p", "k", 0.6)
    assert {r.k: r.cluster for r in got.collect()} == want


def test_ids_of_lost_first_choices(spark):
    """Each of a chain of clusters loses its first choice to the one before, and takes its second."""
    before = [(f"n{i}{j}", f"SCH-{i:05d}", "day") for i in range(1, 6) for j in range(3)] + [("odd", "SCH-00009", "residential"), ("free", "SCH-00007", None)]
    now = [(f"n{i}{j}", i, "day") for i in range(1, 6) for j in range(2)] + [(f"n{i - 1}{j}", i, "day") for i in range(2, 6) for j in range(3)] + [("odd", 8, "day"), ("free", 9, "residential"), ("new", 7, "day")]
    old, new = spark.createDataFrame(before, "name string, old string, kind string"), spark.createDataFrame(now, "name string, cluster long, kind string")
    got = rows(identity.stable_ids(old, new, "name", "old", "cluster", kind="kind", prefix="SCH-"))
    assert got == [(1, "SCH-00001", 2), (2, "SCH-00002", 2), (3, "SCH-00003", 2), (4, "SCH-00004", 2), (5, "SCH-00005", 2), (7, "SCH-00010", None), (8, "SCH-00011", None), (9, "SCH-00007", 1)]
    assert dict((r[0], r[1]) for r in rows(identity.stable_ids(old, new, "name", "old", "cluster")))[8] == "SCH-00009"


# ---- staff


def plain_score(a, b):
    """The score of two parsed names (surnames, initials, given)."""
    surname = max((min(1.0, S._jaro_winkler(x, y) + 0.02 * (i == j == 0)) for i, x in enumerate(a[0]) for j, y in enumerate(b[0])), default=0.0)
    if surname < 0.87:
        return 0.0
    x, y = (p[2][0] if p[2] else "" for p in (a, b))
    i, j = a[1], b[1]
    if len(x) >= 3 and len(y) >= 3 and not x.startswith(y) and not y.startswith(x):
        initials = 0.1 if x[0] == y[0] else 0.0
    elif not i or not j:
        initials = 0.5
    elif i == j:
        initials = 1.0
    elif i.startswith(j) or j.startswith(i):
        initials = 0.95
    elif set(i) == set(j):
        initials = 0.9
    elif i[0] == j[0]:
        initials = 0.85 if set(i) <= set(j) or set(j) <= set(i) else 0.75 if len(i) == len(j) and sum(p != q for p, q in zip(i, j, strict=True)) == 1 else 0.6
    else:
        initials = 0.15 if set(i) & set(j) else 0.0
    return min(1.0, 0.65 * surname + 0.35 * initials + 0.01 * (len(x) >= 3 and x == y))


def plain_staff(nodes, places):
    """node -> the smallest node of its person; nodes: (school, key) -> (parsed, class), places: (school, key) -> provinces."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    def join(a, b):
        x, y = sorted((find(a), find(b)))
        root[y] = x

    for school in {n[0] for n in nodes}:
        own = sorted(k for s, k in nodes if s == school)
        near = lambda a, b, s=school: plain_score(nodes[s, a][0], nodes[s, b][0]) >= 0.9 - 1e-12 and not (nodes[s, a][1] and nodes[s, b][1] and nodes[s, a][1] != nodes[s, b][1])
        groups = plain_clusters(own, near)
        for a, b in itertools.combinations(own, 2):
            if groups[a] == groups[b]:
                join((school, a), (school, b))
    for key in {n[1] for n in nodes}:
        for province in {p for n, ps in places.items() if n[1] == key for p in ps}:
            first, *others = sorted(n for n, ps in places.items() if n[1] == key and province in ps)
            for other in others:
                if not (nodes[first][1] and nodes[other][1] and nodes[first][1] != nodes[other][1]):
                    join(first, other)
    return {n: find(n) for n in nodes}


def test_staff(spark, small):
    printed = evidence._teachers(spark, small)
    seen = staff.attested(printed, "school", "teacher", "province")
    nodes = {(r.school, r.key): (([s for s in r.surnames if s], r.initials, [g for g in r.given if g]), r["class"]) for r in staff.nodes(seen).collect()}
    places = {}
    for r in seen.select("school", "key", "province").distinct().collect():
        if r.province:
            places.setdefault((r.school, r.key), set()).add(r.province)
    want = plain_staff(nodes, places)
    got = {(r.school, r.key): r.person for r in staff.staff(printed, "school", "teacher", "province").collect()}
    together = lambda of: {frozenset(n for n in of if of[n] == p) for p in set(of.values())}
    assert together(got) == together(want) and len(set(got.values())) < len(got)
    # every name against every other that the greedy groups kept: all pairs of a school's group are alike
    for group in together({n: p for n, p in want.items()}):
        for a, b in itertools.combinations(sorted(group), 2):
            if a[0] == b[0] and not any(a[0] != n[0] for n in group):
                assert plain_score(nodes[a][0], nodes[b][0]) >= 0.9 - 1e-12


def test_staff_of_odd_rows(spark):
    said = [("s", "Rev. E.F. Green, O.M.I., S.J.", "Ontario")] * 3 + [("s", "Miss E.F. Green", "Ontario"), ("s", "Teacher", "Ontario"), ("s", None, "Ontario"), (None, "J. Roy", "Ontario"), ("s", "X", None), ("t", "E.F. Green", None), ("t", "Sister Green", "Quebec"), ("u", "Constable.", "x")]
    frame = spark.createDataFrame(said, "school string, teacher string, province string")
    assert {(r.school, r.key, r["class"]) for r in staff.nodes(staff.attested(frame, "school", "teacher", "province")).collect()} == {("s", "e f green", "m"), ("t", "e f green", ""), ("t", "green", "f")}
    assert rows(staff.staff(frame, "school", "teacher", "province"), "school", "key") == [("s", "e f green"), ("t", "e f green"), ("t", "green")]
    assert staff.staff(frame.limit(0), "school", "teacher", "province").count() == 0


@pytest.mark.parametrize(
    ("printed", "said"),
    [("Rev. P. Roy, O.M.I.", ("P. Roy", "rev", "m", "teacher")), ("Rev. Sister Anne, (S.G.M.)", ("Anne", "rev sister", "f", "teacher")), ("M. Bell, S.J., Farmer", ("M. Bell", "", "", "farmer")), ("A. Orsj", ("A. Orsj", "", "", "teacher"))],
)
def test_orders_and_titles(spark, printed, said):
    assert tuple(spark.createDataFrame([(printed,)], "x string").select(M.titled("x").alias("t")).first().t) == said


# ---- papers and rule files


def test_papers(spark):
    cases = [
        ("", "Report of the Minister of Agriculture .— Report on Archives", "report", "agriculture", ["archives"]),
        ("Fisheries", "Statement of insurance", "statement", "fisheries", ["insurance"]),
        (None, "Return to an Order of the House: Yukon and railway papers", "return_to_order", None, ["railways_other", "yukon"]),
        ("Railway", "Return to an Address: Yukon", "return_to_address", None, ["railways_other", "yukon"]), ("Yukon", "Return to an Address on railways", "return_to_address", "yukon", ["railways_other"]),
        ("", None, "other", None, []), (None, "*Message* about nothing", "message", None, []), ("", "APPENDIX on census", "other", "census", []),
    ]
    frame = spark.createDataFrame([(i, s, t) for i, (s, t, *_) in enumerate(cases)], "i int, s string, t string")
    got = papers.classified(frame, "s", "t").orderBy("i").collect()
    assert [(r.kind, r.series, r.contains) for r in got] == [tuple(c[2:]) for c in cases]
    assert papers.classified(frame.limit(0), "s", "t").count() == 0


GOOD = """# columns of one kind
family: census
entity_type: band   # of the registry

series:
  # people
  - id: population
    label: Number in band
    match: '^number( in)? band$|^it''s all$'
  - id: crop_{crop}
    match: "^(?P<crop>[a-z]+) acres$"
    years: [1890, 1899]
ignore:
  - '^total$'
  - remarks
"""


def test_rule_files(spark, tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text(GOOD)
    got = readers.rule_file(spark, str(path))
    assert (got["family"], got["entity_type"], got["ignore"]) == ("census", "band", ["^total$", "remarks"])
    assert readers.rule_list(spark, str(path)) == [("population", "^number( in)? band$|^it's all$", 0, 9999), ("crop_{crop}", "^(?<crop>[a-z]+) acres$", 1890, 1899)]


@pytest.mark.parametrize(
    "line",
    ["    note: x", "    match: '('", "    label: 'open", "    label: |", "    years: [[1], 2]", "    label: {a: 1}", "stray", "family: again", "    match:", "    id: &x y", "\tlabel: x", "    label: a: b"],
)
def test_rule_files_refuse_what_they_do_not_know(spark, tmp_path, line):
    path = tmp_path / "rules.yaml"
    path.write_text(GOOD.replace("    label: Number in band\n", line + "\n"))
    with pytest.raises(ValueError, match="line 8"):
        readers.rule_list(spark, str(path))


def test_rules_that_lack_a_pattern(spark, tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text("series:\n  - id: x\n    label: y\n")
    with pytest.raises(ValueError, match="rule 1"):
        readers.rule_list(spark, str(path))


# ---- editions


def plain_links(printed, registry):
    words = lambda s: set(s.split())
    share = lambda a, b: 1.0 if not words(a) and not words(b) else len(words(a) & words(b)) / len(words(a) | words(b))
    like = lambda a, b: max(share(a, b), SequenceMatcher(None, a.replace(" ", ""), b.replace(" ", "")).ratio()) if a and b else 0.0
    out = []
    for edition in {r["edition"] for r in printed}:
        mine, used = [r for r in printed if r["edition"] == edition], set()
        for r in sorted(mine, key=lambda r: r["id"]):
            found = []
            for x in registry:
                if x["region"] != r["region"] or x["entry"] in used:
                    continue
                n, b, a = like(r["name"], x["name"]), like(r["band"], x["band"]), r["acres"] is not None and x["acres"] is not None and abs(r["acres"] - x["acres"]) < 0.01
                number = r["no"] and r["no"] == x["no"]
                alone = r["name"] and r["name"] == x["name"] and sum(y["region"] == r["region"] and y["name"] == r["name"] for y in registry) == 1 and sum(y["region"] == r["region"] and y["name"] == r["name"] for y in mine) == 1
                if number and r["band"] and x["band"] and b >= 0.7:
                    tier = ("T1", 3 + n)
                elif number and r["name"] and n >= 0.6:
                    tier = ("T2", 2 + n)
                elif number and a:
                    tier = ("T4", 1 + n)
                elif alone:
                    tier = ("T3", 1.5)
                elif n >= 0.75 and a:
                    tier = ("T5", 1 + n)
                else:
                    continue
                found.append((round(tier[1] + 0.3 * share(r["division"], x["division"]) + 0.3 * a, 9), tier[0], x["entry"]))
            found.sort(key=lambda f: (-f[0], f[2]))
            if not found:
                out.append((r["id"], edition, None, "unmatched", None))
            elif len(found) > 1 and abs(found[0][0] - found[1][0]) < 1e-9:
                out.append((r["id"], edition, None, "ambiguous", None))
            else:
                used.add(found[0][2])
                out.append((r["id"], edition, found[0][2], found[0][1], found[0][0]))
    return sorted(out, key=str)


def test_editions(spark):
    import random

    rng = random.Random(11)
    nouns = ["long lake", "lake long", "red bank", "red banks", "stony", "stone y", "blood", ""]
    one = lambda: {"region": rng.choice("AB"), "no": rng.choice(["1", "2", "3", ""]), "name": rng.choice(nouns), "band": rng.choice(["cree", "crees", "blood", ""]), "division": rng.choice(["north", "south bay", ""]), "acres": rng.choice([10.0, 10.004, 57.42, None])}
    registry = [{"entry": i, **one()} for i in range(30)]
    printed = [{"id": i, "edition": 1900 + i % 3, **one()} for i in range(60)]
    kinds_ = "region string, no string, name string, band string, division string, acres double"
    left, right = spark.createDataFrame(printed, f"id long, edition int, {kinds_}"), spark.createDataFrame(registry, f"entry long, {kinds_}")
    want = plain_links(printed, registry)
    got = [(*r[:4], None if r[4] is None else round(r[4], 9)) for r in rows(editions.edition_links(left, right), "id", "edition", "entry", "tier", "score")]
    assert got == want and {r[3] for r in want} >= {"T1", "T2", "T3", "unmatched", "ambiguous"}
    taken = [(r[1], r[2]) for r in got if r[2] is not None]
    assert len(taken) == len(set(taken))
    assert editions.edition_links(left.limit(0), right).count() == 0


def test_patches(spark):
    frame = spark.createDataFrame([(1, 28, "Oakfield", 5.0), (1, 29, "Oakfield", 6.0), (2, 7, "Tarn", None), (3, 1, None, 1.0)], "chunk int, page int, name string, acres double")
    patches = spark.createDataFrame([(1, 28, "Oakfield", 410.0), (2, 9, "Tarn", 77.0), (1, 40, "Oakfield", 1.0), (9, 9, "Nowhere", 1.0), (3, 1, None, 7.0)], "chunk int, page int, name string, acres double")
    keys = (["chunk", "page", "name"], ["chunk", "name"], ["acres"])
    assert rows(editions.patched(frame, patches, *keys)) == [(1, 28, "Oakfield", 410.0, "exact"), (1, 29, "Oakfield", 6.0, None), (2, 7, "Tarn", 77.0, "relaxed"), (3, 1, None, 1.0, None)]
    assert rows(editions.patch_fates(frame, patches, *keys), "page", "fate") == [(1, "missed"), (28, "exact"), (40, "several"), (9, "missed"), (9, "relaxed")]


# ---- kinds


def test_identity_kinds(spark):
    cases = [
        ("No. 12, Band of John", "ledger_person", ""), ("Fort William School", "school", ""), ("Relief and supplies", "appropriation", ""), ("Relief, Kent County", "agency", ""), ("Clearing brush", "appropriation", ""),
        ("Oak Lake, J. Cole, Agent", "agency", "Oak Lake"), ("Piapot Band, J. Cole, farmer.", "band_row", "Piapot Band"), ("Elm Agency, Rev. J. Roy", "agency", "Elm Agency"), ("Lac Bleu", "agency", ""),
        ("Walpole Island", "agency", ""), ("Jones, A.E.", "staff", ""), ("Dr. Peter Hall", "staff", ""), ("John Tolley", "staff", ""), ("Jon Nobody", "agency", ""), ("", "other", ""), (None, "other", ""), ("Word", "agency", ""),
    ]
    known = spark.createDataFrame([("Tolley, John",), ("Zeller, Q.",), (None,)], "name string")
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, name string")
    assert [(r.name, r.kind, r.unit) for r in kinds.identity_kinds(frame, "name", known).orderBy("i").collect()] == cases


# ---- windows of pages


def test_longest_stretch_and_its_windows(spark, small):
    """Against a walk over each text; the bodies of a stretch, one after the other, are the text."""
    docs = evidence._volumes(spark, small)
    begin, end = r"CENSUS OF INDIANS[^\n]{0,80}\n", r"\nSCHOOL STATEMENT[^\n]{0,40}\n"
    want = {}
    for r in docs.collect():
        marks = [(m.start(), int(m[1])) for m in re.finditer(r"<!-- page (\d+) -->", r.text)]
        page = lambda at, marks=marks: ([p for a, p in marks if a <= at] or [0])[-1]
        for m in re.finditer(begin, r.text):
            e = next((e.start() for e in re.finditer(end, r.text) if e.start() >= m.end() + 500), None)
            if page(m.start()) > 15 and e is not None and (r.doc_id not in want or e - m.start() > want[r.doc_id][1] - want[r.doc_id][0]):
                want[r.doc_id] = (m.start(), e, page(m.start()), page(e))
    spans = chunks.located(docs, begin, end)
    assert rows(spans) == sorted([(d, *x) for d, x in want.items()], key=str) and len(want) > 3
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = chunks.page_chunks(docs, spans, pages=3, context=100, header=50, least=0).orderBy("doc_id", "n").collect()
    for doc, group in itertools.groupby(got, key=lambda r: r.doc_id):
        group, (start, stop, first, last) = list(group), want[doc]
        assert [r.n for r in group] == list(range(len(group))) and (group[0].page_from, group[-1].page_to) == (first, last)
        assert all(a.char_end == b.char_start and a.page_to + 1 == b.page_from for a, b in itertools.pairwise(group))
        assert "".join(r.body for r in group) == texts[doc][group[0].char_start : stop] and group[0].char_start <= start
        assert group[0].context == "" and all(texts[doc][: r.char_start].endswith(r.context) and 0 < len(r.context) <= 100 for r in group[1:])
        assert {r.header for r in group} == {texts[doc][start : start + 50]}


def test_stretches_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "CENSUS\n" + "x" * 600 + "\nEND\n"), (4, "<!-- page 16 -->CENSUS\n" + "x" * 10 + "\nEND\n"), (5, "<!-- page 16 -->CENSUS\n" + "x" * 600 + "\nEND\n")], "doc_id int, text string")
    assert rows(chunks.located(docs, "CENSUS\n", "\nEND\n"), "doc_id", "char_start", "page_from", "page_to") == [(5, 16, 16, 16)]


# ---- series


def test_addresses(spark):
    points = spark.createDataFrame([("a", 1890, 5), ("a", 1890, 5), ("b", 1890, 64), ("c", 1890, None), ("d", None, 5), ("e", 1891, 5), ("f", 1890, 999)], "id string, year int, page int")
    segments = spark.createDataFrame([(1890, 1, 90, "d", "whole", "letter", "w"), (1890, 4, 6, "d", "tight", "letter", "t"), (1890, 1, 70, "d", "table", "tabular_statement", "x"), (1890, 60, 64, "e", "late", None, None), (None, 1, 9, "d", "none", "letter", ""), (1891, 9, 1, "d", "turned", "letter", "")], "report_year int, page_start int, page_end int, doc_id string, segment_id string, kind string, heading string")
    got = rows(series.addressed(points, segments), "id", "address")
    assert got == [("a", "d / table"), ("a", "d / table"), ("b", "d / table"), ("c", None), ("d", None), ("e", None), ("f", None)]
    redirects = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "id string, target string")
    assert rows(series.canonical_points(points.select("id").distinct(), redirects, "id"), "id", "canonical") == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e"), ("f", "f")]


# ---- queries that SQL can't express, row by row


def test_ratcliff_of_all_pairs(spark, small):
    from quillgraph import catalog

    got = catalog.queries()["sim_ratcliff"](spark, small).select("a", "b", "score").distinct().collect()
    assert len(got) > 100 and all(r.score == round(SequenceMatcher(None, r.a, r.b).ratio(), 6) for r in got)


def test_objects_of_cut_replies(spark, small):
    """Two whole objects in every reply, the cut third one left out."""
    from quillgraph import catalog

    got = catalog.queries()["salvage_json"](spark, small).collect()
    assert {r.n for r in got} == {2} and len(got) == spark.read.parquet(f"{small}/events.parquet").count()
