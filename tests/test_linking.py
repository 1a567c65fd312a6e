"""Links, clusters, ledgers, segments and readers on small made cases, against brute force where there is one."""

import itertools
import json
import random

from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.operators import fulltext, identity, ledger, linking, passages, relational, segmentation
from quillgraph.sources import readers


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_redirects_of_a_long_chain_and_of_circles(spark):
    steps = [(i, i + 1) for i in range(1000)] + [(2001, 2002), (2002, 2001), (2000, 2001), (3000, 3000)]
    got = dict(rows(identity.redirect_closure(spark.createDataFrame(steps, "id long, target long"))))
    assert all(got[i] == 1000 for i in range(1000))
    assert {i: got[i] for i in (2000, 2001, 2002, 3000)} == {2000: 2000, 2001: 2001, 2002: 2002, 3000: 3000}
    assert rows(identity.redirect_closure(spark.createDataFrame([], "id long, target long"))) == []


def greedy(spans):
    last, out = None, []
    for s, e in sorted(set(spans), key=lambda x: (x[0], -x[1])):
        if last is None or s >= last:
            out.append((s, e))
            last = e
    return out


def test_spans_against_brute_force(spark):
    rng = random.Random(3)
    spans = [(k, s := rng.randrange(60), s + rng.randrange(1, 9)) for k in range(5) for _ in range(30)]
    got = rows(identity.non_overlapping(spark.createDataFrame(spans, "k long, s long, e long"), "k", "s", "e"))
    assert got == sorted((k, *x) for k in range(5) for x in greedy([(s, e) for q, s, e in spans if q == k]))


def test_mentions_from_the_left(spark):
    docs = spark.createDataFrame([(1, "Of the land, of THE land"), (2, None), (3, "land of")], "doc_id long, text string")
    names = spark.createDataFrame([("of the", 1), ("the land", 2), ("land", 3), ("land", 4), ("the land of", 5)], "surface string, entity_id long")
    got = rows(passages.mentions(docs, names, 3).select("doc_id", "pos", "surface", "entity_id"))
    assert got == [(1, 0, "of the", 1), (1, 2, "land", 3), (1, 2, "land", 4), (1, 3, "of the", 1), (1, 5, "land", 3), (1, 5, "land", 4), (3, 0, "land", 3), (3, 0, "land", 4)]


def test_suffixes_keep_clear_of_natural_ids(spark):
    frame = spark.createDataFrame([("x", i) for i in range(4)] + [("x-2", 9), ("x-4", 9)], "base string, n long")
    assert [r[-1] for r in rows(relational.suffixed(frame, "base", ["n"], "id"))] == ["x", "x-3", "x-5", "x-6", "x-2", "x-4"]


def test_tiers_and_claims(spark):
    pairs = spark.createDataFrame([("a", 1, 0.9, True), ("a", 2, 0.95, False), ("b", 1, 0.7, False), ("b", 2, 0.65, False), ("c", 3, 0.2, False), ("d", 4, 1.0, False), ("d", 5, 0.99, False)], "k string, c long, s double, num boolean")
    tiers = [("T1", F.col("num")), ("T2", F.col("s") >= 0.9)]
    assert rows(linking.only_in_tier(pairs, "k", "c", "s", tiers, 0.6)) == [("a", "T1", 1, 0.9), ("b", "ambiguous", None, 0.7), ("c", "no_match", None, 0.2), ("d", "ambiguous", None, 1.0)]
    claims = linking.best_claims(pairs, "k", "c", "s", 0.86, 0.02, 0.7, 0.04)
    assert rows(claims) == [(1, "b", 0.7), (2, "a", 0.95), (4, "d", 1.0), (5, "d", 1.0)]
    assert rows(linking.margin_tiers(pairs, "k", "c", "s", [("M1", F.col("num"), 0.5, 0.0), ("M2", F.lit(True), 0.6, 0.05)])) == [("a", "M1", 1, 0.9), ("b", "M2", 1, 0.7)]


def test_guarded_clusters(spark):
    keys = [("p", "six nations no 1", "1", []), ("p", "six nations no 2", "2", []), ("p", "kuper island", "", ["cowichan"]), ("p", "kuper isld", "", ["cowichan"]), ("p", "kuper isl", "", ["babine"]), ("q", "kuper isld", "", [])]
    got = {r.key: r.cluster for r in linking.guarded_clusters(spark.createDataFrame(keys, "p string, k string, no string, places array<string>"), "p", "k", 0.9, "no", "places", 0.7).withColumnRenamed("k", "key").where("p = 'p'").collect()}
    assert got["six nations no 1"] != got["six nations no 2"] and got["kuper island"] == got["kuper isld"] != got["kuper isl"]


def test_pruned_components(spark):
    members = [("g", 1, 1890, 1900, 9, "x"), ("g", 2, 1895, 1899, 5, "y"), ("g", 3, 1901, 1905, 4, "y"), ("g", 4, 1890, 1891, 3, None)]
    got = rows(linking.pruned(spark.createDataFrame(members, "g string, m long, a long, b long, n long, c string"), "g", "m", "a", "b", "n", "c"))
    assert got == [("g", 1, True), ("g", 2, False), ("g", 3, True), ("g", 4, True)]


def test_people_of_one_name(spark):
    seen = [(1, "a", "ON", "m"), (2, "a", "ON", ""), (3, "a", "ON", "f"), (4, "a", "QC", "m"), (2, "a", "QC", ""), (9, None, "ON", "")]
    frame = spark.createDataFrame(seen, "id long, name string, region string, kind string")
    assert rows(linking.merged_people(frame, "id", "name", "region", "kind")) == [(1, 1), (2, 1), (4, 1)]


def test_records_in_passes(spark):
    schema = "id long, block long, page long, number string, name string, amount double"
    left = spark.createDataFrame([(1, 1, 5, "7", "star blanket", 10.0), (2, 1, 5, "7", "star blanket", 11.0), (3, 1, 9, "8", "alone here", None), (4, 1, 6, "9", "tat sel", 3.0), (5, 2, 1, "1", "other", None)], schema)
    right = spark.createDataFrame([(11, 1, 6, "7", "star blanket", 11.0), (12, 1, 5, "7", "star blanket", 10.0), (13, 1, 2, "0", "alone here", None), (14, 1, 7, "9", "tatsel", 3.0)], schema)
    got = rows(linking.matched_records(left, right, "block", "page", "number", "name", "amount"))
    assert got == [(1, 12, "exact"), (2, 11, "relaxed"), (3, 13, "name"), (4, 14, "fuzzy")]


def test_samples_don_t_depend_on_partitions(spark):
    frame = spark.range(200).withColumn("kind", F.col("id") % 3)
    a, b = (rows(linking.sampled(frame.repartition(n), "kind", "id", 4, 11)) for n in (1, 7))
    assert a == b and len(a) == 12


def test_ledgers(spark):
    assert [r[0] for r in spark.createDataFrame([(["Debit", "Credit"], None), (["Debit", "Credit"], "Cash account"), (["Capital", "Interest"], "x"), (None, None)], "c array<string>, t string").select(ledger.shape(F.col("c"), F.col("t"))).collect()] == ["ledger_debit_2", None, "ledger_split_3", None]
    printed = spark.createDataFrame([("a", "To Balance, 1890", ["1", "2", "3", "4"], "ledger_debit_2"), ("a", "x", ["5"], "ledger_debit_2"), ("b", "y", ["(1.50)", "2 25"], "ledger_debit_2")], "a string, l string, v array<string>, d string")
    shaped = ledger.effective_shape(printed, "a", "v", "d")
    got = sorted(ledger.entries(shaped, "a", "l", "v", "shape").collect(), key=str)
    assert sorted((r.a, r.side, r.capital, r.interest) for r in got if r.a == "b") == [("b", "Cr", 2.25, None), ("b", "Dr", -1.5, None)]
    assert {(r.side, r.capital, r.interest) for r in got if r.description == "To Balance, 1890" or r.interest == 4} == {("Dr", 1.0, 2.0), ("Cr", 3.0, 4.0)}
    assert rows(ledger.balances(ledger.entries(shaped, "a", "l", "v", "shape"), "a")) == [("a", "closing", 1890, 1.0)]
    lines = spark.createDataFrame([("f", i, k, s) for i, (k, s) in enumerate([("headers", None), ("row", "A"), ("total", None), ("row", None), ("carried", None), ("row", "B"), ("row", None)])], "f string, n long, kind string, s string")
    assert [r.block for r in ledger.account_blocks(lines, "f", "n", "kind", "s").orderBy("n").collect()] == [0, 0, 0, 1, 1, 2, 2]


def volume(n_letters):
    parts = ["TITLE", "<!-- page 1 -->", "ONTARIO.", ""]
    for i in range(n_letters):
        parts += [f"<!-- page {i + 2} -->", f"UNIT {i} AGENCY,", "Some Place, June 1890.", "", "SIR,—I have sent the return. " + "It was a year of good crops. " * 6, "I have the honour to be, Sir,", "Your obedient servant,", "A. NAME,", "Agent.", ""]
    return "\n".join([*parts, "RETURN A (1).", "figures " * 20])


def test_letters_of_a_volume(spark):
    docs = spark.createDataFrame([(1, volume(12)), (2, volume(3)), (3, ""), (4, None)], "doc_id long, text string")
    got = segmentation.segmented(docs).orderBy("doc_id", "char_start").collect()
    one = [r for r in got if r.doc_id == 1]
    assert [r.kind for r in one] == ["agency_letter"] * 12 + ["return"] and [r.heading for r in one[:2]] == ["UNIT 0 AGENCY", "UNIT 1 AGENCY"]
    assert all(a.char_end == b.char_start for a, b in itertools.pairwise(one)) and one[-1].char_end == len(volume(12))
    assert {r.province for r in one} == {"ONTARIO"} and len({r.segment_id for r in one}) == len(one)
    assert [r.kind for r in got if r.doc_id == 2].count("agency_letter") == 0 and not [r for r in got if r.doc_id > 2]


def test_large_segments_are_cut(spark):
    body = "RETURN A (1).\n" + "".join(f"<!-- page {p} -->\n" + ("QUEBEC.\n" if p == 30 else "") + "word " * 400 + "\n" for p in range(1, 200))
    got = segmentation.segmented(spark.createDataFrame([(1, body)], "doc_id long, text string")).orderBy("char_start").collect()
    assert len(got) > 3 and got[0].char_start == 0 and got[-1].char_end == len(body)
    assert all(a.char_end == b.char_start for a, b in itertools.pairwise(got)) and any(r.heading.endswith("Quebec") for r in got)
    assert max(b.page_start - a.page_start for a, b in itertools.pairwise(got)) <= 60


def test_readers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\ta,b\n")
    assert rows(readers.optional(spark, str(tmp_path / "a.tsv"), "x int, y string")) == [(1, "a,b")]
    assert readers.delimited(spark, str(tmp_path / "a.tsv")).dtypes == [("x", "string"), ("y", "string")]
    (tmp_path / "ids.txt").write_text("a b\n\nb c\n")
    assert rows(readers.id_list(spark, str(tmp_path / "ids.txt"))) == [("a",), ("b",), ("c",)]
    (tmp_path / "v1899").mkdir()
    (tmp_path / "v1899" / "pages.tsv").write_text("1\tp1.html\t20\n")
    (tmp_path / "v1899" / "out.jsonl").write_text('{"k": 1}\nbroken\n{"k": 3}\n')
    assert rows(readers.page_manifest(spark, str(tmp_path / "v*" / "*.tsv"))) == [("v1899", 1, "p1.html", 20)]
    got = readers.json_files(spark, str(tmp_path / "v*" / "*.jsonl"), "k int").select("year", "line", "k")
    assert rows(got) == [(1899, 0, 1), (1899, 2, 3)]
    (tmp_path / "rules.yaml").write_text("# rules\nseries:\n  - id: crop_{x}\n    match: '^(?P<x>[a-z]+) acres$'\n    years: [1890, 9999]\n  - id: price\n    match: ^price$\n")
    assert readers.rule_list(spark, str(tmp_path / "rules.yaml")) == [("crop_{x}", "^(?<x>[a-z]+) acres$", 1890, 9999), ("price", "^price$", 0, 9999)]
    out = str(tmp_path / "decided")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    assert readers.append_decided(frame.where("id = 1"), out, "id") == 1 and readers.append_decided(frame, out, "id") == 1
    assert rows(spark.read.json(out).select("id")) == [(1,), (2,)]
    readers.write_review(spark.createDataFrame([(1, ["a", "b"])], "id long, xs array<string>"), str(tmp_path / "review"))
    assert rows(readers.delimited(spark, str(tmp_path / "review"))) == [("1", "a|b")]
    readers.write_parts(spark.createDataFrame([(1, "a" * 25 + "\n\nb")], "doc_id long, text string"), str(tmp_path / "parts"), 10)
    parts = sorted(spark.read.json(str(tmp_path / "parts")).collect(), key=lambda r: r.part)
    assert all(len(p.text) <= 10 for p in parts) and "".join(p.text for p in parts).replace("\n", "") == "a" * 25 + "b"


def test_search_cuts_texts_once(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (4, "d")], "doc_id long, text string")
    asked = spark.createDataFrame([("a b", "a"), ("a b", "b"), ("x", "x")], "query string, term string")
    few = rows(fulltext.bm25(docs, asked))
    limit, fulltext.TERMS_IN_PLAN = fulltext.TERMS_IN_PLAN, 1
    try:
        assert rows(fulltext.bm25(docs, asked)) == few and [r[:2] for r in few] == [("a b", 1), ("a b", 2)]
    finally:
        fulltext.TERMS_IN_PLAN = limit
    assert json.dumps(few)


def test_school_headers(spark):
    frame = spark.createDataFrame([(["Number on Roll", "Grant"],), (["Name", "Salary"],), (None,)], "c array<string>")
    assert [r[0] for r in frame.select(M.is_school_header(F.col("c"))).collect()] == [True, False, False]


def test_captions_of_volumes(spark):
    """Statements by letter, school statements and named appendices begin segments; a letter keeps the line that it shares with a caption."""
    fill = "figures " * 20
    body = f"STATEMENT A Showing Lands\n{fill}\nSCHOOL STATEMENT, 1902.\n{fill}\nAPPENDIX to the Report\n{fill}\nSTATEMENT of no kind\n{fill}\nMANITOBA AND THE NORTH-WEST\n{fill}"
    got = segmentation.segmented(spark.createDataFrame([(1, body)], "doc_id long, text string")).orderBy("char_start").collect()
    assert [(r.kind, r.heading) for r in got] == [("tabular_statement", "STATEMENT A Showing Lands"), ("tabular_statement", "SCHOOL STATEMENT, 1902"), ("appendix", "APPENDIX to the Report")]
    letters = volume(12).replace("UNIT 3 AGENCY,\nSome Place, June 1890.\n", "long " * 30 + "\nAPPENDIX B.")
    kinds = {r.kind for r in segmentation.segmented(spark.createDataFrame([(1, letters)], "doc_id long, text string")).collect() if "APPENDIX" in r.heading}
    assert kinds == {"agency_letter"}
    lines = segmentation.volume_lines(spark.createDataFrame([(1, "MANITOBA AND THE NORTH-WEST")], "doc_id long, text string"))
    assert lines.where(F.col("line").rlike(segmentation.PROVINCE)).count() == 1


def test_widths_of_ledgers(spark):
    """Total rows take part in an account's width and give no entries."""
    printed = spark.createDataFrame([("a", "x", ["5", "6"], False), ("a", "Total", ["5", "0", "6", "0"], True)], "a string, l string, v array<string>, t boolean").withColumn("d", F.lit("ledger_debit_2"))
    shaped = ledger.effective_shape(printed, "a", "v", "d")
    assert {r.shape for r in shaped.collect()} == {"ledger_dr_cr_4"}
    assert rows(ledger.entries(shaped, "a", "l", "v", "shape", F.col("t")).select("side", "capital", "interest")) == [("Dr", 5.0, 6.0)]
    heads = [(["Dr.", "Cr."], "Return C"), (["Capital", "Interest", "Cr.", "Capital", "Interest"], ""), (["Capital", "Interest", "Other", "x"], ""), (["Debit", "Credit"], "none")]
    got = [r[0] for r in spark.createDataFrame(heads, "c array<string>, t string").select(ledger.shape(F.col("c"), F.col("t"))).collect()]
    assert got == ["ledger_debit_2", "ledger_dr_cr_5", None, "ledger_debit_2"]


def test_records_by_division_and_score(spark):
    schema = "id long, block long, page long, number string, name string, amount double, division string"
    left = spark.createDataFrame([(1, 1, 5, "7", "lake", None, "a"), (2, 1, 5, "7", "lake", None, "b"), (3, 1, 5, "9", "long hill point", 2.0, "a"), (4, 1, 5, "9", "long hill", 9.0, "a"), (5, 1, 8, None, None, None, None), (6, 1, 3, "4", "twin", None, "a"), (7, 1, 3, "4", "twin", None, "a")], schema)
    right = spark.createDataFrame([(11, 1, 5, "7", "lake", None, "b"), (12, 1, 5, "9", "long hill points", 9.0, "a"), (13, 1, 6, "9", "hill long", None, "a"), (14, 1, 2, "4", "twin", None, "a"), (15, 1, 4, "4", "twin", None, "a"), (16, 1, 9, None, None, None, None)], schema)
    got = rows(linking.matched_records(left, right, "block", "page", "number", "name", "amount", "division"))
    assert got == [(2, 11, "exact"), (3, 13, "fuzzy"), (4, 12, "fuzzy"), (5, 16, "relaxed"), (6, 14, "relaxed"), (7, 15, "relaxed")]
