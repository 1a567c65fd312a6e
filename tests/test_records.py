"""Graph assembly, gates and narrative operators on small made rows."""

from pyspark.sql import functions as F

from quillgraph.functions import numbers as U
from quillgraph.functions import similarity as S
from quillgraph.operators import assembly as A
from quillgraph.operators import fulltext as T
from quillgraph.operators import gates as G
from quillgraph.operators import linking as K
from quillgraph.operators import narrative as N


def rows(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def test_edges_need_both_ends_and_come_once(spark):
    school = spark.createDataFrame([("s", "a", None, 1890, "x"), ("s", "a", "r", 1890, "w"), (None, "a", "r", 1890, "x")], "school_id string, agency_id string, reserve_id string, year int, printed string")
    got = rows(A.graph_edges({"school_years": school}), "edge", "src_id", "dst_id", "evidence")
    assert got == [("IN_AGENCY", "s", "a", "w"), ("ON_RESERVE", "s", "r", "w")]


def test_postings_are_spread_over_their_years(spark):
    posts = spark.createDataFrame([("p", "a", 1880, 1882, ""), ("p", "b", 1880, None, ""), ("p", "c", 1800, 1900, ""), ("p", "d", None, 1900, ""), ("p", "e", 1890, 1880, "")], "person_id string, agency_id string, first_year int, last_year int, printed string")
    got = rows(A.graph_edges({"postings": posts}), "dst_id", "year")
    assert [y for d, y in got if d == "a"] == [1880, 1881, 1882]
    assert [y for d, y in got if d == "b"] == [1880]
    assert [y for d, y in got if d == "c"] == list(range(1800, 1846))
    assert [y for d, y in got if d == "d"] == []
    assert [y for d, y in got if d == "e"] == [1890]


def test_signers_report_on_the_school_and_sign_for_the_context(spark):
    segments = spark.createDataFrame([("g", None, "s", 1890, "")], "segment string, agency_id string, school_id string, year int, heading string")
    mentions = spark.createDataFrame([("g", "person", "p", "high", "a", 1890), ("g", "person", "q", "low", "a", 1890), ("g", "band", "b", "high", "a", 1890), ("h", "person", "p", "medium", "c", 1891)], "segment string, entity_type string, entity_id string, confidence string, context_agency string, year int")
    got = rows(A.graph_edges({"segments": segments, "mentions": mentions}), "edge", "src_id", "dst_id")
    assert got == [("REPORTED_IN", "s", "g"), ("REPORTED_ON", "p", "s"), ("SIGNED_FOR", "p", "a"), ("SIGNED_FOR", "p", "c")]


def test_entities_take_the_first_source_and_widen(spark):
    shape = "type string, id string, name string, region string, first_year int, last_year int, n_years long"
    a = spark.createDataFrame([("band", "1", "Old", "ON", 1902, 1902, 1)], shape)
    b = spark.createDataFrame([("band", "1", "New", "QC", 1880, 1899, 4), ("band", "2", "Other", None, None, None, None)], shape)
    got = {r.id: r for r in A.entities([("curated", a), ("census", b)]).collect()}
    assert tuple(got["1"]) == ("band", "1", "Old", "ON", "curated+census", 1880, 1902, 5)
    assert tuple(got["2"]) == ("band", "2", "Other", None, "census", None, None, None)


def test_only_one_of_a_name_counts(spark):
    names = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3), ("z", 4), ("z", 4)], "key string, id int")
    asked = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "k string")
    got = {r.k: r.found for r in A.one_of_a_name(asked, F.col("k"), names, "found").collect()}
    assert got == {"x": 1, "y": None, "z": 4, None: None}


def test_chains_meet_within_the_gap(spark):
    chains = spark.createDataFrame([("a", "Fort Pelly", 1880, 1885), ("b", "Pelly West", 1888, 1890), ("c", "Pelly East", 1889, 1890), ("d", "Fort", 1886, 1890)], "chain string, name string, first_year int, last_year int")
    assert rows(A.chain_events(chains), "before", "after", "year") == [("a", "b", 1888), ("a", "d", 1886)]


def test_row_kinds(spark):
    named = {"Battle River Agency": "unit", "Agency Day School": "school", "Carlton Day School District": "school", "- Ontario. -": "province", "Rev. J. Smith": "person", "Carter, Thos.": "person", "": "blank", None: "blank", "Moose Woods": "school", "Grand total": "province"}
    frame = spark.createDataFrame([(k,) for k in named], "n string")
    assert {r.n: r.k for r in frame.select("n", G.row_kind(F.col("n")).alias("k")).collect()} == named


def test_gated_rows(spark):
    shape = "year int, page int, name string, teacher string, denomination string, values array<string>, extracted string"
    frame = spark.createDataFrame([
        (1890, 1, "A", "t", None, ["3"], "boarding"), (1890, 4, "B", "t", None, None, "day"), (1890, 5, "C", "t", None, [None], "day"), (1890, 3, "D", "t", None, [], "day"),
        (1890, 1, "E", None, "", [None, "$1,200.50"], "day"), (1891, 99, "F", "t", None, ["3"], "day"), (1890, None, "G", "t", None, ["3"], "day"),
    ], shape)
    pages = spark.createDataFrame([(1890, 1, "industrial"), (1890, 2, "staff"), (1890, 3, "end")], "year int, page int, type string")
    got = {r.name: (r.printed, r.type, r.fate) for r in G.gated_rows(frame, pages).collect()}
    assert got == {"A": ("industrial", "industrial", "kept"), "B": ("", "day", "kept"), "C": ("", "day", "end"), "D": ("", "day", "end"), "E": ("industrial", "industrial", "sale"), "F": ("", "day", "kept"), "G": ("", "day", "kept")}


def test_pages_read_as_their_statement(spark):
    frame = spark.createDataFrame([("aaabb",), ("aaabbb",), ("a",), ("ab",), ("",), (None,)], "t string")
    assert [r[0] for r in frame.select(G.reads_as(F.col("t"), "a", "b")).collect()] == [True, False, True, False, False, False]


def test_area_changes(spark):
    frame = spark.createDataFrame([(100.0, 1000.0), (100.0, 150.0), (100.0, 5000.0), (None, 3.0), (0.0, 0.0)], "a double, b double")
    got = [tuple(r.f) for r in frame.select(G.area_change(F.col("a"), F.col("b"), F.lit(False)).alias("f")).collect()]
    real = "real_change_candidate"
    assert got == [("ocr_digit", "medium"), (real, "medium"), (real, "low"), (real, "low"), (real, "medium")]


def signals(spark, *found):
    return spark.createDataFrame(list(found), "year int, page int, n int, kind string, strength string, rank double")


def test_page_types(spark):
    after = {"day": "boarding"}
    got = rows(G.page_types(signals(
        spark, (1, 1, 0, "day", "title", None), (1, 2, 0, None, None, None), (1, 3, 0, None, None, 7.0), (1, 4, 0, None, None, 0.0),
        (1, 5, 0, "residential", "title", None), (1, 6, 0, "day", "header", None), (1, 7, 0, "day", "title", None), (1, 7, 1, "industrial", "title", None), (1, 8, 0, None, None, None), (1, 10, 0, None, None, None),
    ), after), "page", "type")
    assert got == [(1, "day"), (2, "day"), (3, "day"), (4, "boarding"), (5, "residential"), (6, "residential"), (7, "mixed"), (8, "industrial"), (10, "")]


def test_signatures(spark):
    docs = spark.createDataFrame([(1, "Sir,\n  J. R. STEVENSON,\n Indian Agent.\nEND OF REPORT\nof the year"), (2, "Agent"), (3, None), (4, "")], "doc_id long, text string")
    found = N.signatures(docs)
    assert rows(found, "doc_id", "char_start", "name", "surname", "initial", "office") == [(1, 7, "J. R. STEVENSON", "STEVENSON", "J", "Agent")]
    agents = spark.createDataFrame([("x", "STEVENSON", "J", 1893), ("y", "STEVENSON", "K", None), ("z", "STEVENSON", None, None)], "agent string, surname string, initial string, year int")
    dated = found.withColumn("year", F.lit(1890))
    assert rows(N.signed(dated, agents), "fate", "person") == [("link", "z")]
    assert rows(N.signed(dated, agents.where("agent = 'y'")), "fate", "person") == [("mint", "PERSON-j-r-stevenson")]
    assert rows(N.minted_people(N.signed(dated, agents.where("agent = 'y'"))), "person", "first_year", "n_signatures") == [("PERSON-j-r-stevenson", 1890, 1)]
    two = N.signed(dated.withColumn("year", F.lit(1891)), agents).collect()[0]
    assert (two.fate, two.person, two.candidates) == ("residual", None, ["x", "z"])


def test_contexts_at_the_ends_of_a_text(spark):
    docs = spark.createDataFrame([(1, "ab  cd\nef")], "doc_id int, text string")
    spans = spark.createDataFrame([(1, 0, 2), (1, 4, 6), (1, 7, 9)], "doc_id int, char_start int, char_end int")
    assert rows(N.in_context(spans, docs, 3), "char_start", "context") == [(0, "[[ab]] c"), (4, "b [[cd]] ef"), (7, "cd [[ef]]")]


def test_decisions(spark):
    items = spark.createDataFrame([(1, ["agency:AG-1", "reserve:9"]), (2, ["band:B"])], "item int, candidates array<string>")
    told = [(1, "AG-1", "high", None), (1, "9", "low", ""), (1, "agency:AG-2", "high", ""), (1, None, "high", "a band"), (2, " none ", "sure", "a band"), (3, "x", "high", "")]
    decisions = spark.createDataFrame(told, "item int, choice string, confidence string, reason string")
    assert rows(N.decided(items, decisions), "item", "choice", "fate") == [(1, "agency:AG-1", "linked"), (1, "agency:AG-2", "unoffered"), (1, "none", "band_not_offered"), (1, "reserve:9", "unverified"), (2, "none", "none"), (3, "x", "orphan")]


def test_school_sentences(spark):
    said = "Number of children of school age, 1,020; number of pupils enrolled, 30; average attendance, 20"
    docs = spark.createDataFrame([(1, f"x\n{said}.\nnumber attending Elkhorn, 12"), (2, "none"), (3, None), (4, said.replace("1,020", "2"))], "doc_id int, text string")
    assert rows(N.school_sentences(docs), "doc_id", "school_age", "enrolled", "attendance", "elsewhere", "schools", "plausible") == [(1, 1020, 30, 20, 12, "Elkhorn 12", True), (4, 2, 30, 20, 0, "", False)]


def test_several_school_sentences_of_a_text(spark):
    """Each entry has its own pupils: up to the words that end it, the next sentence, or 900 characters."""
    one = "Number of children of school age, 40; number of pupils enrolled, 30; average attendance, 20"
    text = f"<b>Fort A</b>. {one}; number attending Hilltop, 5. The Indian agent saw number attending Nowhere, 7. <a href='/x'>Fort B</a> {one}; number attending Lakeside, 999. {one}" + "; more" * 200 + "; number attending Far, 3"
    docs = spark.createDataFrame([(1, text), (2, one + " reports on the number attending Z, 4")], "doc_id int, text string")
    got = rows(N.school_sentences(docs), "doc_id", "entry", "unit", "school_age", "elsewhere", "schools")
    assert got == [(1, 0, "Fort A", 40, 5, "Hilltop 5"), (1, 1, "Fort B", 40, 999, "Lakeside 999"), (1, 2, "", 40, 0, ""), (2, 0, "", 40, 0, "")]


def test_surnames_and_given_names(spark):
    frame = spark.createDataFrame([(["macdonald", "donald"], ["donald"]), (["smith"], ["smith"]), ([], ["x"]), (None, ["x"])], "a array<string>, b array<string>")
    assert [r[0] for r in frame.select(S.surname_score("a", "b")).collect()] == [1.0, 1.0, 0.0, 0.0]
    given = spark.createDataFrame([(["agnes"], ["angus"]), (["agnes"], ["mary"]), (["tom"], ["thomas"]), (["wm"], ["william"]), (["will"], ["william"]), ([], ["x"])], "a array<string>, b array<string>")
    assert [r[0] for r in given.select(S.given_conflict(F.col("a"), F.col("b"))).collect()] == [0.1, 0.0, 0.1, None, None, None]


def test_acres_and_bars(spark):
    frame = spark.createDataFrame([("57 42", "57.42"), ("1,057 42", "1057.42"), ("57 4", "57.4"), (None, "1"), ("1", "2")], "a string, b string")
    assert [r[0] for r in frame.select(U.acres_close_text("a", "b")).collect()] == [True, True, False, False, False]
    bars = spark.createDataFrame([([1.0, None, 8.0],), ([2.0, 2.0],), ([],), (None,)], "v array<double>")
    assert [r[0] for r in bars.select(U.sparkline(F.col("v"))).collect()] == ["▁ █", "▁▁", "", None]


def test_accounts_settled_by_number(spark):
    shape = "id int, no string, t string, name string, s double, w int"
    accounts = spark.createDataFrame([(1, "7", "A", "sampson", 0.9, 3), (2, "7", "B", "samson", 0.9, 5), (3, "7", None, "x", None, None), (4, "8", "A", "enoch", 1.0, 1), (5, "8", "C", "paspaschase", 1.0, 1), (6, "8", None, "y", None, None), (7, "", "A", "z", 1.0, 1), (8, None, None, "z", 1.0, 1)], shape)
    got = rows(K.settled_by_number(accounts, "id", "no", "t", "name", "s", "w", 0.7).fillna("-"), "id", "t", "fate")
    assert got == [(1, "B", "settled"), (2, "B", "linked"), (3, "B", "propagated"), (4, "A", "conflict"), (5, "C", "conflict"), (6, "-", "conflict"), (7, "A", "linked"), (8, "-", "unlinked")]


def test_chosen_units(spark):
    named = spark.createDataFrame([(1, "u1", "x"), (2, "u1", "x"), (2, "AG-a", "y"), (3, "AG-a", "SARCEE"), (3, "AG-b", "OFFICE, SARCEE"), (4, "AG-a", "X"), (4, "AG-b", "Y"), (5, "u1", "a"), (5, "u2", "b")], "k int, unit string, name string")
    assert rows(K.chosen_unit(named, "k", "unit", F.startswith("unit", F.lit("AG-")), "name").fillna("-"), "k", "unit") == [(1, "u1"), (2, "AG-a"), (3, "AG-a"), (4, "-"), (5, "-")]


def test_dateline_candidates(spark):
    frame = spark.createDataFrame([(1, "TREATY No. 4, INDIAN HEAD AGENCY.  Sask; 1890"), (2, ""), (3, "Brandon")], "i int, line string")
    got = {r.i: r.c for r in frame.select("i", N.dateline_candidates(F.col("line")).alias("c")).collect()}
    assert got[1][:4] == ["TREATY No. 4", "INDIAN HEAD AGENCY", "Sask", "1890"]
    assert got[1][4] == "TREATY No. 4, INDIAN HEAD AGENCY" and got[1][-1] == "INDIAN HEAD AGENCY, Sask, 1890" and len(got[1]) == 9
    assert got[2] == [] and got[3] == ["Brandon"]


def test_harvested_figures(spark):
    docs = spark.createDataFrame([(1, "5 schools: 1,200 pupils. Ten years ago 6 schools: 300 pupils, 20 present. On June 30 7 schools: 400 pupils. 8 schools: 99 pupils."), (2, None)], "doc_id int, text string")
    got = rows(N.harvested(docs, [("day", r"(\d+) schools: (\d[\d,]*) pupils(?:, (\d+) present)?")]).fillna(-1), "units", "enrolled", "attendance", "note")
    assert got == [(5, 1200, -1, ""), (6, 300, 20, "retrospective"), (7, 400, -1, "point_in_time")]


def test_field_positions_and_weights(spark):
    docs = spark.createDataFrame([(1, "Head head", "a head"), (2, None, "b"), (3, "c", None), (4, "d", "d")], "doc_id int, h string, t string")
    got = {(r.term, r.doc_id, r.field): r.positions for r in T.field_postings(docs, ("h", "t")).collect()}
    assert got[("head", 1, "h")] == [0, 1] and got[("head", 1, "t")] == [1] and ("b", 2, "t") in got and len(got) == 7
    asked = spark.createDataFrame([("q", "head"), ("q", "d")], "query string, term string")
    scores = {r.doc_id: r.score for r in T.bm25_fields(docs, asked, {"h": 2.0, "t": 1.0}).collect()}
    assert set(scores) == {1, 4} and scores[1] > 0
