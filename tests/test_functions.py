"""Golden examples of the scalar functions, with nulls and empty texts."""

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.functions import numbers as N
from quillgraph.functions import similarity as S
from quillgraph.functions import text as X
from quillgraph.operators.passages import marked_up


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column).collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (X.norm, {"Côté  & Fils": "cote fils", "": "", None: None, "--": ""}),
        (X.squash, {"Six Nations": "sixnations"}),
        (X.slug, {"TOUCHWOOD HILLS AGENCY": "touchwood-hills-agency", "!!": "section", "a" * 29 + " b": "a" * 29}),
        (X.skeleton, {"FILE HILLS AGENCY": "FLHLS"}),
        (X.absent, {" ": None, "nan": None, "...": None, " x ": "x", None: None}),
        (X.text_version, {"": "da39a3ee5e6b"}),
        (X.title_case, {"STAR OF THE EAST": "Star of the East"}),
        (N.parse_value, {"1,204": 1204.0, "...": None, "-": None, "*": None, "": None, "12a": 12.0, "1 204": None, "1 204*": 1204.0, None: None}),
        (N.parse_money, {"1,017 25": 1017.25, "398.40": 398.40, "12,052": 12052.0, "(5.00)": -5.0, "nil": None, None: None}),
        (N.word_number, {"fifty-four": 54, "1,612": 1612, "some": None}),
        (N.year_of, {"1894-05": 1894, "c. 1894": None, None: None}),
        (X.html_to_text, {"<p>a &amp;amp; b<br>c</p><script>x</script>": "a &amp; b c"}),
    ],
)
def test_examples(spark, function, cases):
    assert values(spark, list(cases), function("x")) == list(cases.values())


@pytest.mark.parametrize(("years", "want"), [([1894, 1895, 1896, 1899], "1894–1896, 1899"), ([], ""), ([1900, 1900], "1900")])
def test_year_ranges(spark, years, want):
    assert spark.createDataFrame([(years,)], "y array<int>").select(N.year_ranges(F.col("y"))).first()[0] == want


@pytest.mark.parametrize(("a", "b", "want"), [("abcd", "abxy", 0.666667), ("mcniell", "mcneill", 0.966667), ("", "a", 0.0), ("a", "a", 1.0), ("", "", 1.0)])
def test_jaro_winkler(a, b, want):
    assert round(S._jaro_winkler(a, b), 6) == want


@pytest.mark.parametrize(
    ("function", "a", "b", "want"),
    [
        (S.jaccard, "", "", 1.0),
        (S.dice, "", "", 0.0),
        (S.dice, "aaa", "aa", 2 / 3),
        (S.containment, "ab", "xaby", 1.0),
        (S.band_similarity, "halalt", "haltkum adams lake", None),
        (S.initials_score, "f", "fw", 0.95),
        (S.initials_score, "wlb", "wbl", 0.9),
        (S.initials_score, "fh", "fr", 0.75),
        (S.initials_score, "a", "", 0.5),
        (S.initials_score, "j", "k", 0.0),
    ],
)
def test_similarity(spark, function, a, b, want):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(function(F.col("a"), F.col("b"))).first()[0]
    assert got < 1 if want is None else got == pytest.approx(want)


def test_markup_from_the_right():
    assert marked_up("the band at the lake", [(0, 3, "x"), (12, 15, "y")]) == "[the](x) band at [the](y) lake"


# Printed names and what is made of them.
_BANDS = [("The Band of Birdtail", "birdtail"), ("Birdtail - Sioux (2)", "birdtail - sioux"), ("Beardy's Band.", "beardy"), ("Indians of Lac La Côte", "lac la cote"), ("Band", None), ("", None), (None, None)]
_ALIASES = [("Six Nations on Grand River", "sixnationsgrandriver"), ("Six Nations on the Grand River (No. 2)", "sixnationsgrandriver"), ("Pi-a-pot", "piapot"), ("tlie Piapot Band", "piapot"), ("", "")]
_NUMBERS = [("31H and pt. of 31G", "31H"), ("24A", "24A"), ("No. 12 B", "12B"), ("none.", "NONE"), (None, "")]
_REGION = [("Province of Ontario", "ON"), ("North - West Territories", "MBNWT"), ("Yukon District", "YT"), ("Elsewhere", "?"), (None, "?")]
_NAMED = [("STAR BLANKET I.R. 83D", "STAR BLANKET", "83D"), ("SIX NATIONS INDIAN RESERVE NO. 40", "SIX NATIONS", "40"), ("CHIPEWYAN 201a", "CHIPEWYAN", "201A"), ("Round Lake Reserve", "Round Lake", ""), ("40", "40", "")]
_UNITS = [("ASSINIBOIA - FILE HILLS AGENCY", "FILE HILLS AGENCY"), ("Report of the Touchwood and Nut Lake Agency, 1899", "TOUCHWOOD - NUT LAKE AGENCY"), ("TREATY NO. 4, INDIAN HEAD AGENCY", "INDIAN HEAD AGENCY"), ("AGENCY", None), ("Letter", None)]
_TEACHERS = [("Rev. J. Smith", "J. Smith", "rev", "m", "teacher"), ("Miss Agnes Deans Cameron", "Agnes Deans Cameron", "miss", "f", "teacher"), ("A. Jones, Farmer.", "A. Jones", "", "", "farmer"), ("Sister Mary", "Mary", "sister", "f", "teacher")]
_LABELS = [("crop_other_roots_acres_sown", "Other roots, acres sown"), ("pop_total", "Total"), ("hay_tons", "Hay, tons")]
_PEOPLE = [
    ("Hugh R. Colby, M.D.", "colby", "hr", "hugh|r"), ("Jas. Ten Broeck", "tenbroeck|broeck", "j", "jas"), ("Nairn T.", "nairn", "t", "t"), ("Pell-Murray, G.O., C.M.G.", "pellmurray|murray|pell", "go", "g|o"),
    ("D'Arcy, L.", "darcy|arcy", "l", "l"), ("", "", "", ""), (None, "", "", ""), ("Ven. Archdeacon", "archdeacon", "", ""), ("Col. Sir Owen St. Clair, K.C.M.G., V.D.", "stclair|clair", "o", "owen"),
    ("Lane, M.A.", "lane", "ma", "m|a"), ("Lane, B.A., M.D.", "lane", "ba", "b|a"), ("Rev. Father", "father", "", ""), ("Quill, Rev. P.", "quill", "p", "p"), ("Vander Meer, Chief Amos", "vandermeer|meer", "a", "amos"),
]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (M.band_key, _BANDS), (M.alias_key, _ALIASES), (M.first_number, _NUMBERS), (M.region_group, _REGION), (M.name_and_number, _NAMED), (M.unit_name, _UNITS), (M.titled, _TEACHERS), (M.series_label, _LABELS),
        (M.generation, [("Dreaver, J., sr.", "sr"), ("A. Junior", "jr"), ("Dreaver, John", None)]),
        (M.registry_key, [("Nicola (Lower) Band", "nicola lower"), (None, "")]),
        (M.province, [("PROVINCE OF ONTARIO", "Ontario"), ("Alberta Inspectorate", "Alberta"), ("QUEBEC - Con.", "Quebec"), ("North-West", "North-West Territories"), (None, None)]),
        (M.school_key, [("2Deer Lake Day School", "deer lake"), ("(t)Alert Bay (Continued)", "alert bay"), (None, "")]),
        (M.school_number, [("six nations no 10", "10"), ("six nations 3b", "3b"), ("six nations", "")]),
        (M.division, [("Treaty No. 6.", "treaty", "TREATY NO. 6"), ("Kamloops-Okanagan Agency, British Columbia", "agency", "KAMLOOPS - OKANAGAN AGENCY"), ("Kent County", "county", "KENT")]),
    ],
)
def test_printed_names(spark, function, cases):
    got = values(spark, [c[0] for c in cases], function("x"))
    assert [tuple(g) if isinstance(g, tuple) else (g,) for g in got] == [c[1:] for c in cases]


def test_readings_of_names(spark):
    assert values(spark, ["Nim-keesh Band"], M.registry_variants("x")) == [["nim keesh", "nimkeesh"]]
    assert values(spark, ["Spahamin (Douglas Lake)"], M.modern_variants("x")) == [["spahamin", "douglas lake"]]
    assert "enoch" in values(spark, ["Enoch's Band"], M.account_readings("x"))[0]


def test_persons(spark):
    more = [("Norah, K.L. Tremblay", "norah|tremblay", "kl", "k|l"), ("Kit, K.L. Tremblay", "kit", "klt", "k|l|tremblay"), ("Mac Rae, J.", "macrae|rae", "j", "j"), ("Rev. John Smith, Jr.", "smith", "j", "john"), ("Sister", "sister", "", "")]
    cases = _PEOPLE + more
    rows = M.persons(spark.createDataFrame([(c[0],) for c in cases], "x string"), "x").collect()
    assert [(r.x, r.surnames, r.initials, r.given) for r in rows] == cases
