"""Cues around mentions, staged lookup, headers, leftover rows, overlaps and agreements on small made cases."""

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.operators import cues, fulltext, hubs, linking, passages, series
from quillgraph.operators import gates as G


def rows(frame, *columns):
    return sorted([tuple(r[c] for c in columns or frame.columns) for r in frame.collect()], key=str)


NAMES = [
    ("alexander", "reserve", "R1", "Edmonton", "AB"), ("alexander", "band", "B1", None, "AB"), ("duck lake", "agency", "A1", None, None), ("duck lake", "reserve", "R2", "Carlton", "SK"),
    ("pete", "band", "B2", None, None), ("stony", "band", "B3", None, "AB"), ("stony", "band", "B4", "Hobbema", "AB"),
]
SEGMENTS = [
    (1, "Alexander reserve and then the farmer Alexander Moss.", "agency_letter", "AB", None),  # the second has no cue close by
    (2, "Pete-mok-anak band, but Pete's band.", "agency_letter", "SK", None),  # inside a hyphenated name, and right after a letter's apostrophe
    (3, "The Alexander band went.", "agency_letter", "SK", None),  # from another region, in a letter
    (4, "The Alexander band went.", "return", "SK", None),  # the same in a table
    (5, "at Duck Lake we met", "tabular_statement", "SK", None), (6, "at Duck Lake agency we met", "letter", None, None), (7, "Duck Lake, reserve", "letter", None, None),
    (8, "Stony Indians", "letter", "AB", "Hobbema"), (9, "Stony Indians", "letter", "AB", None), (10, "No. 134 is Alexander", "letter", "AB", None), (11, None, None, None, None), (12, "", "letter", "AB", None),
]


def test_cues(spark):
    names = spark.createDataFrame(NAMES, "surface string, type string, entity_id string, context string, region string")
    docs = spark.createDataFrame(SEGMENTS, "doc_id int, text string, kind string, region string, agency string")
    found = passages.mentions(docs, names.select("surface", "entity_id"), 2).select("doc_id", "pos", "n_tokens", "surface").distinct()
    got = rows(cues.decided_mentions(docs, found, names), "doc_id", "char_start", "char_end", "entity_id", "confidence", "candidates", "note")
    assert got == sorted([
        (1, 0, 9, "R1", "medium", "reserve:R1", ""), (2, 24, 28, "B2", "medium", "band:B2", ""),
        (3, 4, 13, None, "residual", "band:B1|reserve:R1", "region mismatch: SK"), (4, 4, 13, "B1", "low", "band:B1", "region mismatch: SK"),
        (5, 3, 12, None, "residual", "agency:A1|reserve:R2", ""), (6, 3, 12, "A1", "high", "agency:A1", ""), (7, 0, 9, "R2", "medium", "reserve:R2", ""),
        (8, 0, 5, "B4", "medium", "band:B4", ""), (9, 0, 5, None, "residual", "band:B3|band:B4", ""), (10, 11, 20, "R1", "medium", "reserve:R1", ""),
    ], key=str)
    assert cues.decided_mentions(docs, found.limit(0), names).count() == 0


def test_surfaces_that_are_no_mentions(spark):
    names = spark.createDataFrame([("York", "reserve"), ("Manitoba", "agency"), ("Manitoba", "band"), ("O Q", "band"), ("Lac la Biche", "agency"), (None, "band")], "surface string, type string")
    assert rows(cues.gazetteer(names)) == [("Lac la Biche", "agency"), ("Manitoba", "band")]


def test_stages_of_lookup(spark):
    """Later classes open only where the earlier ones give fewer than the limit; mentions add up over a class's names."""
    aliases = spark.createDataFrame([("Duck Lake", "a", 1, 7), ("duck-lake!", "a", 1, 3), ("Duck Lake Band", "b", 2, 90), ("Old Duck Lake", "b", 3, 1), ("Lake of the Duck", "b", 4, 1), ("Aducklak", "b", 5, 2), ("Ghost", "b", 99, 1), (None, "b", 6, 1)], "alias string, type string, id long, n long")
    entities = spark.createDataFrame([("a", 1, 5, 1), ("b", 2, 9, 1), ("b", 3, None, 2), ("b", 4, 0, 3), ("b", 5, 0, None)], "type string, id long, n_mentions long, n_years long")
    asked = spark.createDataFrame([("Duck Lake",), ("!",), (None,), ("ghost",)], "query string")
    few = fulltext.staged_lookup(aliases, asked, entities, limit=3)
    assert rows(few, "rank", "id", "score") == [(1, 1, 3.1), (2, 2, 2.5), (3, 3, 1.51)]
    many = fulltext.staged_lookup(aliases, asked, entities, limit=10)
    assert rows(many, "rank", "id", "score", "matched") == [(1, 1, 3.1, ["duck lake"]), (2, 2, 2.5, ["duck lake band"]), (3, 3, 1.51, ["old duck lake"]), (4, 4, 1.01, ["lake of the duck"]), (5, 5, 0.52, ["aducklak"])]


@pytest.mark.parametrize(
    ("columns", "title", "kind"),
    [(["Number in Band", "Acres", "Hay"], None, "census"), (["Anglican", "Pagan", "Acres", "Hay", "Seed"], "", "census"), (["Anglican", "Acres"], None, "agri"), (["Male", "Births"], "Acres", "census"), (["Name", None], None, "unknown"), (None, "Religions", "census"), (None, None, "unknown")],
)
def test_headers(spark, columns, title, kind):
    frame = spark.createDataFrame([(columns, title)], "c array<string>, t string")
    assert frame.select(G.header_class(F.col("c"), F.col("t")).alias("k")).first().k == kind


def plain_fates(left, matched, registry):
    share = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    like = lambda a, b: max(share(set(a.split()), set(b.split())), SequenceMatcher(None, a.replace(" ", ""), b.replace(" ", "")).ratio()) if a and b else 0.0
    e = lambda x: x or ""
    close = lambda a, b: a is not None and b is not None and abs(float(a.replace(",", "").replace(" ", ".")) - float(b.replace(",", "").replace(" ", "."))) < 0.01
    out = []
    for r in left:
        no, name, band = e(r["no"]), e(r["name"]), e(r["band"])
        dup = [m["entry"] for m in matched if m["edition"] == r["edition"] and e(m["no"]) == no and r["page"] is not None and abs(m["page"] - r["page"]) <= 2 and (like(name, e(m["name"])) >= 0.7 or (name and name == m["name"]))]
        mine = [g for g in registry if g["region"] == r["region"]]
        steal = [g["entry"] for g in mine if no and name and e(g["no"]) == no and e(g["name"]) == name]
        near = [g["entry"] for g in mine if band and (e(g["band"]) == band or like(band, e(g["band"])) >= 0.75) and (like(name, e(g["name"])) >= 0.6 or close(r["acres"], g["acres"]))]
        east = [g["entry"] for g in mine if r["region"] in ("NS", "NB", "PE", "QC") and name and (like(name, e(g["name"])) >= 0.7 or (len(name) >= 5 and name in e(g["name"])) or (len(e(g["name"])) >= 5 and g["name"] in name))]
        if not no + name + band:
            out.append((r["id"], "degenerate_row", "high", None))
        elif dup:
            out.append((r["id"], "duplicate_emission", "high", min(dup)))
        elif len(steal) == 1:
            out.append((r["id"], "greedy_steal", "medium", steal[0]))
        elif len(near) == 1:
            out.append((r["id"], "renumbered_link", "medium", near[0]))
        elif len(east) == 1:
            out.append((r["id"], "renumbered_link", "low", east[0]))
        else:
            out.append((r["id"], "absence_candidate", "low", None))
    return sorted(out, key=str)


def test_leftover_rows(spark):
    import random

    rng = random.Random(2)
    one = lambda: {"region": rng.choice(["NS", "BC", "QC"]), "no": rng.choice(["1", "2", "3", "4", None]), "name": rng.choice(["orwell", "port orwell river", "oak", "oak hill", "hill oak", "ash", None]), "band": rng.choice(["cree", "crees", "micmac", None]), "acres": rng.choice(["10", "10 00", "57.42", None])}
    left = [{"id": i, "edition": rng.choice([1, 2]), "page": rng.choice([1, 2, 5, 9, None]), **one()} for i in range(150)]
    left.append({"id": 150, "edition": 1, "page": 1, **one(), "no": None, "name": None, "band": None})
    matched = [{"edition": rng.choice([1, 2]), "page": rng.randrange(12), "no": rng.choice(["1", "2", "7", None]), "name": rng.choice(["oak", "oak hill", "orwell", None]), "entry": 100 + i} for i in range(12)]
    registry = [{"entry": i, **one()} for i in range(14)]
    frames = [spark.createDataFrame(x, s) for x, s in ((left, "id long, edition int, page int, region string, no string, name string, band string, acres string"), (matched, "edition int, page int, no string, name string, entry long"), (registry, "entry long, region string, no string, name string, band string, acres string"))]
    want = plain_fates(left, matched, registry)
    assert rows(G.leftover_fates(*frames)) == want and len({w[1:3] for w in want}) == 6
    assert G.leftover_fates(frames[0].limit(0), *frames[1:]).count() == 0


def test_overlaps_and_agreements(spark):
    members = spark.createDataFrame([(1, "Piapot", "file hills", 1880, 1890), (2, "Piapot", "hills", 1885, 1895), (3, "Piapot", "birtle", 1885, 1895), (4, "Ontario total", "", 1880, 1890), (5, "Piapot", None, 1880, 1884), (6, None, "", 1886, 1889)], "id int, name string, agency string, first int, last int")
    figures = spark.createDataFrame([(1, 1886, 50.0), (2, 1886, 50.4), (5, 1883, 9.0), (1, 1883, 50.0), (6, 1886, 70.0), (2, 1899, 1.0), (1, 1899, 9.0)], "id int, year int, value double")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (2, 5), (1, 77)], "a int, b int")
    assert rows(linking.compatible_overlaps(pairs, members, figures), "a", "b", "compatible", "note") == [
        (1, 2, True, "identical population in shared years"), (1, 3, False, "different agencies"), (1, 4, False, "province/recap line"), (1, 5, False, "population differs in a shared year"), (1, 6, False, "population differs in a shared year"), (2, 5, True, "no conflicting population"),
    ]
    ours = spark.createDataFrame([(1, "a b c d e f g h i j", 1.0), (2, None, None), (3, "x", 2.0)], "id int, t string, v double")
    other = spark.createDataFrame([(11, "A b-c d e f g h i j!", 1.001), (12, "", None), (13, "y", None)], "id int, t string, v double")
    matched = spark.createDataFrame([(1, 11), (2, 12), (3, 13)], "left_id int, right_id int")
    assert rows(linking.field_agreements(matched, ours, other, ["t"], ["v"])) == [("t", 3, 2, 2), ("v", 3, 2, 2)]


@pytest.mark.parametrize(
    ("text", "region"),
    [("PARRY SOUND, ONT., 14th September", "ON"), ("Fort, N.-W.T., and B.C.", "PR"), ("Montreal, P.Q.", "QC"), ("Hope, British Columbia", "BC"), ("Montane and Ontology", None), ("x" * 498 + " Ont.", None), ("x " * 200 + "Alta", "PR"), ("", None), (None, None)],
)
def test_regions_of_datelines(spark, text, region):
    assert spark.createDataFrame([(text,)], "t string").select(M.dateline_region("t").alias("r")).first().r == region


def test_regions_of_chains(spark):
    letters = spark.createDataFrame([("c", "Ont."), ("c", "Que."), ("c", "Quebec"), ("d", "N.B."), ("d", "Ont."), ("e", "none"), (None, "Ont."), ("f", None)], "c string, t string")
    assert rows(series.chain_regions(letters, "c", "t")) == [("c", "QC", 2), ("d", "NB", 1)]


def test_emitted_observations(spark):
    seen = spark.createDataFrame([("b1", 1890, 1.0), ("b2", 1891, 2.0), (None, None, 3.0)], "id string, year int, value double")
    units = spark.createDataFrame([("b2",), ("b2",), (None,)], "id string")
    papers = spark.createDataFrame([(1890.0, "p18"), (1890.0, "p19"), (None, "p20")], "report_year double, paper_id string")
    assert rows(series.emitted(seen, "id", "band", units, papers), "id", "value", "entity_type", "paper_id") == [("b1", 1.0, "band", "p19"), ("b2", 2.0, "unit", ""), (None, 3.0, "band", "")]


def test_pages_of_entities(spark):
    """Sections in order, ties by name, runs of years, at most 25 names; unknown entities have no lines."""
    one = "type string, id string"
    entities = spark.createDataFrame([("band", "b", "Piapot", "a band"), ("band", "c", None, " ")], f"{one}, name string, summary string")
    aliases = spark.createDataFrame([(f"n{i:02d}", "band", "b", 1) for i in range(30)] + [("big", "band", "b", 9), (None, "band", "b", 99), ("x", "band", "zz", 1)], f"alias string, {one}, n int")
    edges = spark.createDataFrame([("band", "b", "IN", "agency", "a", y) for y in (1890, 1891, 1894, None)] + [("agency", "a", "HAS", "band", "b", None)], "src_type string, src_id string, edge string, dst_type string, dst_id string, year int")
    observed = spark.createDataFrame([("band", "b", "pop", 1890), ("band", "b", "pop", 1899)], "entity_type string, entity_id string, series_id string, year int")
    seen = spark.createDataFrame([("d", "s1", 1890, "band", "b", "high"), ("d", "s2", 1890, "band", "b", "medium"), ("d", "s2", 1890, "band", "b", "medium"), ("d", "s3", 1890, "band", "b", "low")], "doc_id string, segment_id string, report_year int, entity_type string, entity_id string, confidence string")
    got = hubs.hub_sections(entities, aliases, edges, observed, seen)
    assert got.where("section = 'names'").count() == 25
    kept = rows(got.where("section <> 'names' or rank <= 2"), "section", "rank", "item", "n", "years")
    assert kept == sorted([("names", 1, "big", 9, ""), ("names", 2, "n00", 1, ""), ("relations", 1, "IN agency:a", 3, "1890–1891, 1894"), ("referenced", 1, "HAS agency:a", 0, ""), ("series", 1, "pop", 2, "1890–1899"), ("years", 1, "1890", 3, ""), ("segments", 1, "d / s2", 2, "1890"), ("segments", 2, "d / s1", 1, "1890")], key=str)
    pages = {r.id: r.text for r in hubs.hub_texts(entities, got.where("section <> 'names'")).collect()}
    assert pages["c"] == "# c" and pages["b"].startswith("# Piapot\n\na band\n\n## relations\n- IN agency:a (3; 1890–1891, 1894)\n\n## referenced")
