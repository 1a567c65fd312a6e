"""The seven tools on a small archive."""

import pytest

from quillgraph.api import SCHEMAS, Archive
from quillgraph.operators import querylang as Q


@pytest.fixture(scope="module")
def archive(spark):
    rows = {
        "entities": [("band", "b1", "Piapot", "u/b1", 9, 40, "a band"), ("band", "b2", "Piapot's", "u/b2", 2, 3, ""), ("agency", "a1", "File Hills", "u/a1", 5, 9, "")],
        "redirects": [("b9", "b1")],
        "aliases": [("piapot", "band", "b1", 30), ("pi a pot", "band", "b1", 2), ("piapot band", "band", "b2", 1), ("file hills", "agency", "a1", 5)],
        "documents": [("d1", "v1", 1894, "Report")],
        "segments": [
            ("d1", "s1", 1, 1894, "File Hills Agency", "letter", "a1", None, 1, 3, "The wheat of Piapot was good. Wheat and oats."),
            ("d1", "s2", 2, 1894, "Table", "tabular_statement", None, None, 2, 2, "oats barley"),
            ("d1", "s3", 3, 1894, None, "letter", None, None, 4, 5, None),
        ],
        "mentions": [("d1", "s1", 1894, "band", "b1", "Piapot", "high"), ("d1", "s1", 1894, "band", "b1", "piapot", "low")],
        "edges": [("band", "b1", "IN", "agency", "a1", y) for y in (1894, 1895, 1897)] + [("band", "b2", "IN", "agency", "a1", None)],
        "observations": [("band", "b1", "pop", 1894, 10.0, "n", 2), ("band", "b9", "pop", 1895, 11.0, "n", 7)],
    }
    return Archive(spark, **{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()})


def got(frame, *columns):
    return [tuple(r[c] for c in columns) for r in frame.collect()]


def test_lookup(archive):
    assert got(archive.lookup_entity("Piapot"), "id", "score") == [("b1", 3.3), ("b2", 2.01)]
    assert got(archive.lookup_entity("hills file"), "id", "score") == [("a1", 1.05)]
    assert got(archive.lookup_entity("zpiapot"), "id") == [("b1",), ("b2",)]
    assert archive.lookup_entity(" ").columns == ["error"]


def test_search(archive):
    assert got(archive.search("oats"), "segment_id") == [("s2",), ("s1",)]
    assert got(archive.search('"wheat and oats"'), "address") == [("d1 / s1",)]
    assert got(archive.search("oat* NOT wheat"), "segment_id") == [("s2",)]
    assert got(archive.search("barley OR agency", agency="File Hills"), "segment_id") == [("s1",)]
    assert got(archive.search("oats", kind="letter", year_from=1894, year_to=1894), "segment_id") == [("s1",)]
    assert "«Wheat»" in archive.search("wheat").first().snippet
    assert got(archive.search("AND (oats"), "segment_id") == [("s1",)]  # read as the words and, oats
    assert archive.search("!!").columns == ["error"]


def test_graph(archive):
    assert got(archive.neighbors("band:b1"), "side", "id", "name", "years") == [("out", "a1", "File Hills", "1894–1895, 1897")]
    assert got(archive.neighbors("u/a1", year=1896), "side", "id") == [("in", "b2")]
    assert got(archive.mentioned_in("piapot"), "report_year", "primary", "all") == [(1894, 1, 2)]
    assert archive.neighbors("nobody").columns == ["error"]


def test_documents(archive):
    assert got(archive.get_document("1894"), "segment_id", "n_mentions") == [("s1", 1), ("s2", 0), ("s3", 0)]
    segment = archive.get_segment("d1", "s1").first()
    assert [(e.entity_id, e.n, e.primary, e.surfaces) for e in segment.entities] == [("b1", 2, 1, "Piapot, piapot")]
    assert archive.get_segment("d1", "none").columns == archive.get_document("none").columns == ["error"]


def test_series(archive):
    assert got(archive.series("piapot"), "series_id", "n", "first_year", "last_year") == [("pop", 2, 1894, 1895)]
    assert got(archive.series("piapot", "pop"), "year", "value", "address") == [(1894, 10.0, "d1 / s2"), (1895, 11.0, "")]
    assert got(archive.open_page("b1"), "name", "n_edges", "n_series", "names") == [("Piapot", 3, 1, ["piapot", "pi a pot"])]


def test_an_empty_archive(spark):
    empty = Archive(spark)
    assert empty.search("word").count() == 0 and empty.lookup_entity("x").count() == 0
    assert empty.series("x").columns == ["error"]


@pytest.mark.parametrize(
    ("query", "tree"),
    [
        ("", None),
        ("a b", ("and", ("leaf", "a", False), ("leaf", "b", False))),
        ('"Côté x" OR y*', ("or", ("leaf", "cote x", False), ("leaf", "y", True))),
        ("a OR", ("and", ("leaf", "a", False), ("leaf", "or", False))),
        ("(a OR b) NOT c", ("not", ("or", ("leaf", "a", False), ("leaf", "b", False)), ("leaf", "c", False))),
    ],
)
def test_query_language(query, tree):
    assert Q.parsed(query) == tree
