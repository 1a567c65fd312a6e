"""Operators on small frames: ties, nulls, cycles, empty tables."""

from pyspark.sql import functions as F

from quillgraph.operators import identity, passages, relational, series
from quillgraph.sources import readers
from quillgraph.streaming import ingest


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_redirects_end_or_come_back(spark):
    moves = spark.createDataFrame([("a", "b"), ("b", "c"), ("p", "q"), ("q", "p")], "id string, target string")
    assert rows(identity.redirect_closure(moves)) == [("a", "c"), ("b", "c"), ("p", "p"), ("q", "q")]


def test_components_of_a_chain_and_a_star(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 200), (100, 300), (300, 300)], "a long, b long")
    got = dict(rows(identity.components(links)))
    assert {got[i] for i in range(1, 31)} == {1} and got[300] == got[200] == 100


def test_margin_gate(spark):
    scored = spark.createDataFrame([("a", 1, 0.95), ("a", 2, 0.94), ("b", 1, 0.95), ("b", 2, 0.5), ("c", 1, 0.2)], "k string, c long, s double")
    got = {r.k: r.decision for r in relational.margin_gate(scored, "k", "c", "s", 0.9, 0.03).collect()}
    assert got == {"a": "ambiguous", "b": "accepted", "c": "below_gate"}


def test_vote_needs_three_to_one(spark):
    votes = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")] * 2 + [("b", "y")] + [("c", "z")], "k string, v string")
    assert {r.k: r.verdict for r in relational.vote(votes, "k", "v").collect()} == {"a": "clear", "b": "review", "c": "single"}


def test_carry_forgets_at_a_change(spark):
    data = spark.createDataFrame([(1, "r1", "p"), (2, None, None), (3, "r2", None), (4, None, "q")], "n long, zone string, head string").withColumn("f", F.lit(1))
    got = [r.head for r in relational.carried(data, ["f"], ["n"], "head", "zone").orderBy("n").collect()]
    assert got == ["p", "p", None, "q"]


def test_complete_linkage_wants_all_members(spark):
    names = spark.createDataFrame([("x", n) for n in ("abcdef", "abcdeg", "zzzz", None)], "pool string, name string")
    got = dict((r.name, r.cluster) for r in identity.complete_linkage(names, "pool", "name", 0.7).collect())
    assert got["abcdef"] == got["abcdeg"] != got["zzzz"] and None not in got


def test_overlaps_keep_the_earliest_and_longest(spark):
    spans = spark.createDataFrame([("a", 0, 5), ("a", 0, 9), ("a", 8, 12), ("a", 9, 10)], "k string, s int, e int")
    assert rows(identity.non_overlapping(spans, "k", "s", "e")) == [("a", 0, 9), ("a", 9, 10)]


def test_mentions_prefer_the_longer_surface(spark):
    docs = spark.createDataFrame([(1, "At the Six Nations reserve, six men"), (2, None), (3, "")], "doc_id long, text string")
    names = spark.createDataFrame([("six nations", 7), ("six", 8), ("nations", 9)], "surface string, entity_id long")
    assert rows(passages.mentions(docs, names, 2)) == [(1, 2, 2, "six nations", 7), (1, 5, 1, "six", 8)]


def test_ledger_rows_split_into_two_sides(spark):
    data = spark.createDataFrame([(1, "wheat", ["5", "1", "cash", None, "2"]), (2, "oats", [None, None, "cash", "", "x"])], "account long, label string, values array<string>")
    assert rows(series.ledger_entries(data, "account", "label", "values")) == [(1, "Cr", "cash", None, 2.0), (1, "Dr", "wheat", 5.0, 1.0)]


def test_readers(spark, tmp_path):
    (tmp_path / "out_1894.jsonl").write_text('{"k": 1}\nbroken\n[1]\n{"k": 2}\n')
    assert [(r.k, r.year) for r in readers.json_files(spark, str(tmp_path / "*.jsonl"), "k int").collect()] == [(1, 1894), (2, 1894)]
    (tmp_path / "v.md").write_text('---\ntitle: "A: b"\nyear: 1894\n---\nbody\n')
    found = readers.front_matter(spark, str(tmp_path / "v.md")).first()
    assert found["keys"] == {"title": "A: b", "year": "1894"} and found["body"] == "body\n"
    assert readers.optional(spark, str(tmp_path / "none.parquet"), "a int").columns == ["a"]
    out = str(tmp_path / "parts")
    for family, n in (("a", 1), ("b", 2), ("a", 3)):
        readers.write_partition(spark.createDataFrame([(n, family)], "n int, family string"), out, "family")
    assert rows(spark.read.parquet(out)) == [(2, "b"), (3, "a")]
    readers.write_parts(spark.createDataFrame([(1, "aaaa\n\nbbbb\n\ncc")], "doc_id long, text string"), str(tmp_path / "j"), 10)
    assert [r.text for r in spark.read.json(str(tmp_path / "j")).orderBy("part").collect()] == ["aaaa\n\nbbbb", "cc"]


def test_streaming_index_is_that_of_the_batch(spark, small, tmp_path):
    from quillgraph.operators import fulltext

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_tables(spark, str(tmp_path / "in"), "doc_id long, text string")
    ingest.index_into(stream, str(tmp_path / "index"), str(tmp_path / "state")).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "index")).drop("batch")) == rows(fulltext.postings(docs))


def test_lookup_by_one_or_two_letters(spark):
    from quillgraph.operators import fulltext

    names = ["ab", "abc", "abcde", "a", "ba", "Äbel", "xab"]
    aliases = spark.createDataFrame([(n, i, 1) for i, n in enumerate(names)], "alias string, id long, n long")
    queries = spark.createDataFrame([("a",), ("ab",), ("abc",)], "query string")
    got = {}
    for r in fulltext.lookup(aliases, queries, 10).collect():
        got.setdefault(r.query, {})[names[r.id]] = r.match
    assert got["a"] == {"a": 1, "ab": 3, "abc": 3, "abcde": 3, "Äbel": 3}
    assert got["ab"] == {"ab": 1, "abc": 3, "abcde": 3, "Äbel": 3}
    assert got["abc"] == {"abc": 1, "abcde": 3}


def test_span_markup_reads_whole_texts(spark, tmp_path):
    from quillgraph import catalog
    from quillgraph.operators import passages

    text = "A license. " + "x " * 300 + "at the end of the text"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.queries()["span_markup"](spark, str(tmp_path)).first().marked
    first, last = text.index("the"), text.rindex("the")
    assert got == passages.marked_up(text, [(first, first + 3, "w"), (last, last + 3, "w")]) and len(got) > len(text)
