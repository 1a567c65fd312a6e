"""Steps whose work or memory must not outgrow the tables."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillgraph.functions import names, numbers
from quillgraph.operators import cues, fulltext, graph, hubs, identity, ledger, linking, passages, relational, segmentation
from quillgraph.operators.lineage import cut
from quillgraph.plans import evidence


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def tasks(frame):
    return frame.rdd.getNumPartitions()


def test_lines_of_a_page_are_cut_before_they_meet_the_entities(spark):
    edges = spark.range(600).select(F.lit("c").alias("src_type"), F.col("id").alias("src_id"), F.lit("e").alias("edge"), F.lit("c").alias("dst_type"), F.lit(7).cast("long").alias("dst_id"), (F.col("id") % 3 + 1990).cast("int").alias("year"))
    entities = spark.createDataFrame([("c", 7, "n", None)], "type string, id long, name string, summary string")
    empty = lambda schema: spark.createDataFrame([], schema)
    got = hubs.hub_sections(entities, empty("alias string, type string, id long, n long"), edges, empty("entity_type string, entity_id long, series_id string, year int"), empty("doc_id string, segment_id string, report_year int, entity_type string, entity_id long, confidence string"))
    found = [(r.section, r.rank, r.n, r.years) for r in got.collect()]
    assert len(found) == 201 and ("referenced", 200, 1, "1990") in {(s, k, n, y.replace("1991", "1990").replace("1992", "1990")) for s, k, n, y in found}
    text = plan(got)
    assert "Expand" not in text  # years are counted from their set, without a second copy of the rows
    assert all("Window" in branch for branch in text.split("Join LeftSemi")[1:])


def test_texts_of_pages_are_made_in_many_tasks(spark):
    sections = spark.createDataFrame([("c", 1, "names", 2, "b", 1, ""), ("c", 1, "names", 1, "a", 2, "1990")], "type string, id long, section string, rank int, item string, n long, years string")
    got = hubs.hub_texts(spark.createDataFrame([("c", 1, "N", "s")], "type string, id long, name string, summary string"), sections)
    assert got.first().text == "# N\n\ns\n\n## names\n- a (2; 1990)\n- b (1)"
    assert f", {hubs.PARTS}" in plan(got)


def test_longest_span_goes_through_a_nation_once(spark, small):
    got = entry.queries()["longest_span"](spark, small)
    assert "unboundedfollowing" not in plan(got)


def test_readings_of_accounts_are_made_in_many_tasks(spark, small):
    assert tasks(entry.queries()["account_readings"](spark, small)) > 8
    x = "Enoch's-Band (Stony-Plain) 135, Treaty No. 6"
    got = spark.createDataFrame([(x,)], "x string").select(names.account_readings("x").alias("v"), names.modern_variants("x").alias("m")).first()
    assert len(got.v) == len(set(got.v)) and got.m[1:3] == ["enochs 135 treaty", "stony plain"] or len(got.m) == len(set(got.m))


def test_figures_of_a_ledger_are_read_once(spark):
    rows = spark.createDataFrame([(1, "To Balance, 1890", ["5 25", "(3.50)", "By Balance, 1889", None, "x"], "ledger_dr_cr_5")], "a int, label string, values array<string>, s string")
    got = ledger.entries(rows, "a", "label", "values", "s")
    assert [tuple(r) for r in got.collect()] == [(1, "Dr", "To Balance, 1890", 5.25, -3.5)]
    text = plan(got)
    assert all("regexp" not in line for line in text.split("\n") if "Filter" in line)
    cells = ["1,234.5", "12 34", "(12 34)", "$7", "1 234", "", None, "12 3", "4.", " 5 "]
    got = spark.createDataFrame([(c,) for c in cells], "c string").select(numbers.parse_money("c").alias("v")).collect()
    assert [r.v for r in got] == [1234.5, 12.34, -12.34, 7.0, None, None, None, None, None, 5.0]


def test_neighbours_are_grouped_in_many_tasks(spark):
    edges = spark.createDataFrame([("c", 1, "e", "p", 2, 1990), ("c", 1, "e", "p", 2, 1991), ("c", 1, "e", "p", 2, None)], "src_type string, src_id long, edge string, dst_type string, dst_id long, year int")
    got = graph.neighbours(edges, "in")
    assert [tuple(r) for r in got.collect()] == [("p", 2, "e", "c", 1, 2, 1990, 1991)]
    assert "RepartitionByExpression" in plan(got)


def test_records_are_moved_once_before_the_fuzzy_pass(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(linking, "cut", lambda x: cuts.append(x) or x)
    schema = "block long, id long, page long, number string, name string, amount double"
    left = [(1, 1, 5, "7", "a", 1.0), (1, 2, 5, "7", "b", 2.0), (1, 3, 5, "8", "c", 3.0), (1, 4, 5, "9", "e f", 4.0), (None, 5, 5, "1", "g", 5.0), (1, 6, 6, "7", "c", 3.0)]
    right = [(1, 11, 5, "7", "a", 1.0), (1, 12, 6, "7", "b", 2.0), (1, 13, 9, "4", "c", 3.0), (1, 14, 5, "9", "f g e", 8.0), (None, 15, 5, "1", "g", 5.0)]
    got = linking.matched_records(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "block", "page", "number", "name", "amount")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 11, "exact"), (2, 12, "relaxed"), (4, 14, "fuzzy")]  # the name c stands twice on one side
    assert len(cuts) == 2 - 1
    assert "Join" not in plan(cuts[0])


def test_pages_of_a_volume_are_cut_in_one_pass(spark, tmp_path):
    texts = ["", "x" * 400, "ab " * 300, "é\n" * 401]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = evidence._volumes(spark, str(tmp_path))
    got = {r.doc_id: r.text.count("<!-- page") for r in docs.collect()}
    assert got == {i: len(t) // 400 + 1 for i, t in enumerate(texts)}
    assert "substr" not in plan(docs)


def test_words_of_a_document_are_grouped_where_it_lies(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, t string")
    got = fulltext.field_postings(docs, ["t"])
    assert sorted((r.term, r.tf, r.positions) for r in got.collect()) == [("a", 2, [0, 2]), ("b", 1, [1])]
    text = got._jdf.queryExecution().sparkPlan().toString()
    assert text.index("Generate") < text.index("Exchange" if "Exchange" in text else "RepartitionByExpression")


def test_places_are_made_for_a_few_texts_at_a_time(spark):
    n = 3 * cues.SLICE + 5
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("Aa, the bb "), F.col("id").cast("string")).alias("text"))
    spans = docs.select("doc_id", F.lit(2).alias("pos"), F.lit(2).alias("n_tokens"), F.concat(F.lit("bb "), F.col("doc_id").cast("string")).alias("surface"))
    got = {r.doc_id: (r.char_start, r.char_end, r.left, r.right) for r in cues.placed(docs, spans).collect()}
    assert got == {i: (8, 11 + len(str(i)), " ", "") for i in range(n)}


def test_pairs_of_a_key_are_dealt_by_their_number(spark):
    a = spark.range(300).select("id", F.when(F.col("id") < 250, 0).when(F.col("id") < 299, F.col("id")).alias("b"))
    b = spark.range(90).select((F.col("id") + 250).alias("other"), F.when(F.col("id") < 40, 0).when(F.col("id") < 89, F.col("id") + 250).alias("b"))
    few, many = (relational.dealt_join(a, b, ["b"], "id", pairs) for pairs in (10_000, 100))
    want = sorted([(i, j + 250) for i in range(250) for j in range(40)] + [(i, i) for i in range(290, 299)])
    for got in (few, many):
        assert sorted((r.id, r.other) for r in got.collect()) == want
    assert ", 17" in plan(few) and f", {(len(want)) // 100 + 16}" in plan(many)  # tasks grow with the pairs
    assert "_part" not in plan(few) and "_part" in plan(many)
    assert relational.dealt_join(a.limit(0), b, ["b"], "id").count() == 0


def test_tasks_of_parts_paired_follow_their_pairs(spark, small):
    for name in ("pairs_self", "blocked_pairs"):
        text = plan(entry.queries()[name](spark, small))
        assert text.count(", 16") == 2 and "explode" not in text  # few pairs, so no copies of rows


def test_lines_of_volumes_are_made_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(segmentation, "cut", lambda x: made.append(cut(x)) or made[-1])
    letter = "<!-- page 4 -->\n\nCHIPPEWA AGENCY,\nSARNIA, 1 July, 1899.\n\nSIR, - I have the honour to report.\n" + "x " * 30 + "\nI am, Sir,\nYour obedient servant\n"
    docs = spark.createDataFrame([(1, letter * 10), (2, "\nTHE ISLANDS\n\n" + "y " * 40)], "doc_id long, text string")
    got = segmentation.segmented(docs).orderBy("doc_id", "char_start")
    assert [(r.doc_id, r.kind) for r in got.select("doc_id", "kind").collect()] == [(1, "agency_letter")] * 10 + [(2, "thematic_section")]
    assert len(made) == 2 and "split" not in plan(got)


def test_roles_are_told_in_volumes_of_letters_alone(spark):
    lines = segmentation.volume_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    text = plan(segmentation.anchors(lines))
    assert ">= 10)" in text[text.index("collect_list") :].split("Filter", 1)[1].split("\n")[0]


def test_words_that_are_no_surface_are_not_moved(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the six nations of the grand river"), (2, None), (3, "six grand nations")], "doc_id long, text string")
    names = spark.createDataFrame([("six", 8), ("six nations", 7), ("grand river", 9), (None, 1)], "surface string, entity_id long")
    want = [(1, 1, 2, "six nations", 7), (1, 5, 2, "grand river", 9), (3, 0, 1, "six", 8)]
    for slots in (1, passages.SLOTS):  # with one number for all, the exact joins decide alone
        monkeypatch.setattr(passages, "SLOTS", slots)
        got = passages.mentions(docs, names, 2)
        assert sorted(tuple(r) for r in got.collect()) == want
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_slot" in text and text.count("LeftSemi") == 4


def test_overlaps_are_settled_in_one_sorted_pass(spark, small):
    spans = [(None, 0, 3, "x"), (None, 2, 4, "y"), ("a", 0, 0, "z"), ("a", 0, 0, None), ("a", 0, 5, "n"), ("a", 0, 5, "m"), ("a", 4, 9, "o"), ("a", 5, 5, "p"), ("a", 5, 5, "q"), ("b", 1, 2, None)]
    got = identity.non_overlapping(spark.createDataFrame(spans, "k string, s int, e int, x string"), "k", "s", "e", "x")
    want = {(None, 0, 3, "x"), ("a", 0, 5, "m"), ("a", 5, 5, "p"), ("b", 1, 2, None)}
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in ("1", batch):  # what came before is known from batch to batch
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            found = [tuple(r) for r in got.collect()]
            assert set(found) == want and len(found) == 4
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    text = plan(entry.queries()["region_guard"](spark, small))
    assert "collect_list" not in text and "Window" not in text and text.count("Join Inner") == 1  # no second reading of the documents


def test_mentions_bring_columns_of_their_document(spark):
    docs = spark.createDataFrame([(1, "L'École d'été", "fr"), (2, "ecole", None)], "doc_id long, text string, lang string")
    names = spark.createDataFrame([("ecole", 5), ("d ete", 6)], "surface string, entity_id long")
    got = passages.mentions(docs, names, 2, ["lang"])
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, "ecole", 5, "fr"), (1, 2, 2, "d ete", 6, "fr"), (2, 0, 1, "ecole", 5, None)]
