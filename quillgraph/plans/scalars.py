"""Queries of the scalar functions: text, numbers, years, similarities, ordered rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import numbers as N
from quillgraph.functions import similarity as S
from quillgraph.functions import text as X
from quillgraph.operators import classify, gates
from quillgraph.operators import relational as R
from quillgraph.plans.registry import query, table

_NORM = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"
_SQUASH = f"replace({_NORM}, ' ', '')"


def _names(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").selectExpr("p_name as raw").union(table(spark, d, "part").selectExpr("p_type as raw"))
    return part.union(table(spark, d, "documents").selectExpr("text as raw")).distinct()


_NAMES = "names AS (SELECT DISTINCT raw FROM (SELECT p_name AS raw FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT text FROM documents))"


@query(f"WITH {_NAMES} SELECT raw, {_NORM.format('raw')} AS key FROM names")
def norm_index_key(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("raw", X.norm("raw").alias("key"))


@query(f"WITH {_NAMES} SELECT raw, {_SQUASH.format('raw')} AS key FROM names")
def norm_squash(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("raw", X.squash("raw").alias("key"))


@query(f"""
    WITH {_NAMES}, s AS (SELECT raw, rtrim(substring(trim(regexp_replace(strip_accents(lower(raw)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 30), '-') AS s FROM names)
    SELECT raw, CASE WHEN s = '' THEN 'section' ELSE s END AS slug FROM s
""")
def norm_slug(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("raw", X.slug("raw").alias("slug"))


@query(rf"""
    WITH {_NAMES}, u AS (
        SELECT raw, replace(regexp_replace(upper(regexp_replace(strip_accents(lower(raw)), '[^a-z0-9]+', ' ', 'g')), '\b(AGENCY|DISTRICT|RESERVE|BAND|THE|OF|OR)\b', '', 'g'), ' ', '') AS u FROM names
    ), c AS (SELECT raw, u, regexp_extract_all(regexp_replace(u, '[AEIOUY]', '', 'g'), '.') AS c FROM u)
    SELECT raw, u AS squashed, array_to_string(list_filter(c, lambda x, i: i = 1 OR x <> c[i - 1]), '') AS skeleton FROM c
""")
def norm_skeleton(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("raw", X.unit_squash("raw").alias("squashed"), X.skeleton("raw").alias("skeleton"))


@query("""
    SELECT doc_id, CASE WHEN trim(cell) IN ('', 'nan', 'None', '...') THEN NULL ELSE trim(cell) END AS value
    FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' nan ' WHEN 2 THEN 'None' WHEN 3 THEN '...' WHEN 4 THEN NULL ELSE ' ' || source END AS cell FROM documents)
""")
def null_normalise(spark: SparkSession, d: str) -> DataFrame:
    cell = F.expr("CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' nan ' WHEN 2 THEN 'None' WHEN 3 THEN '...' WHEN 4 THEN NULL ELSE ' ' || source END")
    return table(spark, d, "documents").select("doc_id", X.absent(cell).alias("value"))


@query("""
    SELECT p_partkey, len(l)::INTEGER AS n, array_to_string(l, ';') AS parts
    FROM (SELECT p_partkey, list_filter(string_split(p_type || '||' || p_brand || '| |' || p_name, '|'), lambda x: trim(x) <> '') AS l FROM part)
""")
def listify_pipe(spark: SparkSession, d: str) -> DataFrame:
    parts = X.listed(F.expr("p_type || '||' || p_brand || '| |' || p_name"))
    return table(spark, d, "part").select("p_partkey", F.size(parts).alias("n"), F.array_join(parts, ";").alias("parts"))


@query("""
    SELECT DISTINCT p_type AS raw, list_reduce(list_transform(string_split(lower(p_type), ' '), lambda w, i: CASE WHEN i > 1 AND w IN ('a','an','and','at','by','for','in','of','on','or','the','to','with') THEN w ELSE upper(w[1]) || substring(w, 2) END), lambda a, b: a || ' ' || b) AS title FROM part
""")
def title_cased(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_type").alias("raw"), X.title_case("p_type").alias("title")).distinct()


@query(r"SELECT doc_id, trim(regexp_split_to_array(text, '[.:;]| - ')[1]) AS clause FROM documents")
def leading_clauses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.leading_clause("text").alias("clause"))


_CELL = """CASE l_orderkey % 8 WHEN 0 THEN '1,' || lpad((l_partkey % 1000)::VARCHAR, 3, '0') WHEN 1 THEN '...' WHEN 2 THEN '-' WHEN 3 THEN (l_suppkey::VARCHAR) || 'a'
    WHEN 4 THEN '1 204' WHEN 5 THEN '1 204*' WHEN 6 THEN '' ELSE (l_partkey::VARCHAR) || '.5' END"""


@query(rf"""
    WITH c AS (SELECT l_orderkey, l_linenumber, {_CELL} AS cell FROM lineitem)
    SELECT l_orderkey, l_linenumber, cell, CASE WHEN trim(cell) IN ('', '...', '-', '*', 'nil') THEN NULL
        WHEN regexp_matches(cell, '^[0-9][0-9, ]*(\.[0-9]+)?$') AND cell LIKE '% %' THEN NULL
        ELSE try_cast(replace(replace(regexp_extract(cell, '^([0-9][0-9, ]*(\.[0-9]+)?)', 1), ',', ''), ' ', '') AS DOUBLE) END AS value FROM c
""")
def parse_value_cells(spark: SparkSession, d: str) -> DataFrame:
    cell = F.expr(_CELL.replace("::VARCHAR", "").replace("(l_partkey % 1000)", "cast(l_partkey % 1000 as string)"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell")).withColumn("value", N.parse_value("cell"))


_MONEY = """CASE o_orderkey % 6 WHEN 0 THEN '1,017 25' WHEN 1 THEN '398.40' WHEN 2 THEN '12,' || lpad({key}, 3, '0') WHEN 3 THEN '(5.00)' WHEN 4 THEN 'nil' ELSE '$' || {key} || ' 07' END"""


@query(rf"""
    WITH c AS (SELECT o_orderkey, {_MONEY.format(key="(o_custkey % 1000)::VARCHAR")} AS cell FROM orders),
    b AS (SELECT *, replace(regexp_replace(cell, '[()$]', '', 'g'), ',', '') AS body FROM c)
    SELECT o_orderkey, cell, (CASE WHEN cell LIKE '(%' THEN -1.0 ELSE 1.0 END)::DOUBLE * CASE WHEN regexp_matches(body, '^[0-9]+ [0-9]{{2}}$') THEN replace(body, ' ', '.')::DOUBLE
        WHEN regexp_matches(body, '^[0-9]+(\.[0-9]+)?$') THEN body::DOUBLE END AS amount FROM b
""")
def parse_money_cells(spark: SparkSession, d: str) -> DataFrame:
    cell = F.expr(_MONEY.format(key="cast(o_custkey % 1000 as string)"))
    return table(spark, d, "orders").select("o_orderkey", cell.alias("cell")).withColumn("amount", N.parse_money("cell"))


_UNITS = "one two three four five six seven eight nine".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


@query(f"""
    WITH c AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {_TENS!r}[(p_size % 8 + 1)::INT] || '-' || {_UNITS!r}[(p_size % 9 + 1)::INT] WHEN 1 THEN '1,' || (100 + p_size)::VARCHAR ELSE 'twelve moons' END AS words, p_size FROM part)
    SELECT p_partkey, words, CASE p_partkey % 3 WHEN 0 THEN (p_size % 8 + 2) * 10 + p_size % 9 + 1 WHEN 1 THEN 1100 + p_size END::INTEGER AS number FROM c
""")
def word_numbers(spark: SparkSession, d: str) -> DataFrame:
    tens, units = (F.array(*map(F.lit, x)) for x in (_TENS, _UNITS))
    key = F.col("p_partkey") % 3
    words = F.when(key == 0, F.concat(F.get(tens, (F.col("p_size") % 8)), F.lit("-"), F.get(units, F.col("p_size") % 9))).when(key == 1, F.concat(F.lit("1,"), (F.col("p_size") + 100).cast("string"))).otherwise(F.lit("twelve moons"))
    return table(spark, d, "part").select("p_partkey", words.alias("words")).withColumn("number", N.word_number("words"))


@query(r"""
    SELECT o_orderkey, try_cast(regexp_extract(trim(raw), '^([0-9]{4})', 1) AS INTEGER) AS year, try_cast(regexp_extract('vol' || raw, '([0-9]{4})', 1) AS INTEGER) AS tag_year
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'c. ' ELSE ' ' END || strftime(o_orderdate, '%Y-%m') AS raw FROM orders)
""")
def lenient_year(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "c. ").otherwise(" "), F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, d, "orders").select("o_orderkey", N.year_of(raw).alias("year"), N.tag_year(F.concat(F.lit("vol"), raw)).alias("tag_year"))


@query("""
    WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INTEGER AS y FROM orders),
    g AS (SELECT o_custkey, y, y - row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS g FROM y),
    r AS (SELECT o_custkey, min(y) AS a, max(y) AS b FROM g GROUP BY o_custkey, g)
    SELECT o_custkey, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a::VARCHAR || '–' || b::VARCHAR END, ', ' ORDER BY a) AS years FROM r GROUP BY o_custkey
""")
def year_ranges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(N.year_ranges(F.collect_set(F.year("o_orderdate"))).alias("years"))


@query("SELECT s_suppkey, lpad(regexp_extract((s_suppkey::DOUBLE)::VARCHAR, '^([0-9]+)', 1), 5, '0') AS padded FROM supplier")
def padded_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", N.padded_id(F.col("s_suppkey").cast("double")).alias("padded"))


@query("SELECT doc_id, substring(sha1(text), 1, 12) AS version FROM documents")
def text_version(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.text_version("text").alias("version"))


@query("SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS html FROM documents")
def escape_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.escaped("text").alias("html"))


_BOXES = [("west", 0.0, 40.0, 0.0, 60.0), ("east", 35.0, 100.0, 0.0, 60.0), ("north", 0.0, 100.0, 60.0, 100.0)]
_BOX_SQL = "boxes(region, x0, x1, y0, y1) AS (VALUES " + ", ".join(f"('{b[0]}', {b[1]}::DOUBLE, {b[2]}::DOUBLE, {b[3]}::DOUBLE, {b[4]}::DOUBLE)" for b in _BOXES) + ")"


@query(f"""
    WITH {_BOX_SQL}, p AS (SELECT c_custkey, (c_custkey * 7 % 100)::DOUBLE AS x, (c_custkey * 13 % 100)::DOUBLE AS y FROM customer)
    SELECT c_custkey, min(region) AS region FROM p JOIN boxes ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY c_custkey HAVING count(*) = 1
""")
def bbox_unique_region(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "customer").selectExpr("c_custkey", "cast(c_custkey * 7 % 100 as double) as x", "cast(c_custkey * 13 % 100 as double) as y")
    return classify.unique_box(points, _BOXES, "x", "y").select("c_custkey", "region")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(F.lower("p_name"))).alias("names"))
    left = names.select("p_brand", "names", F.explode("names").alias("a"))
    return left.select("p_brand", "a", F.explode(F.expr("filter(names, x -> x > a)")).alias("b"))


_PAIRS = "n AS (SELECT DISTINCT p_brand, lower(p_name) AS v FROM part), pairs AS (SELECT x.p_brand, x.v AS a, y.v AS b FROM n x JOIN n y ON x.p_brand = y.p_brand AND x.v < y.v)"
_GRAMS = "CASE WHEN length({0}) < 2 THEN []::VARCHAR[] ELSE list_transform(range(1, length({0})), lambda i: substring({0}, i, 2)) END"
_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> ''))"
_JACCARD = f"(len(list_intersect({_WORDS.format('a')}, {_WORDS.format('b')}))::DOUBLE / len(list_distinct(list_concat({_WORDS.format('a')}, {_WORDS.format('b')}))))"


@query(f"WITH {_PAIRS} SELECT p_brand, a, b, round({_JACCARD}, 6) AS score FROM pairs")
def sim_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("score", F.round(S.jaccard(F.col("a"), F.col("b")), 6))


@query(f"""
    WITH {_PAIRS}, g AS (SELECT *, list_distinct({_GRAMS.format('a')}) AS x, list_distinct({_GRAMS.format('b')}) AS y FROM pairs)
    SELECT p_brand, a, b, round(greatest({_JACCARD}, len(list_intersect(x, y))::DOUBLE / least(len(x), len(y))), 6) AS score FROM g
""")
def sim_containment(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, d).withColumn("score", F.round(F.greatest(S.jaccard(a, b), S.containment(a, b)), 6))


_DICE = """(SELECT 2.0::DOUBLE * coalesce(sum(least(m.n, k.n)), 0)::DOUBLE FROM
    (SELECT g, count(*) AS n FROM (SELECT unnest(x) AS g) GROUP BY g) m JOIN (SELECT g, count(*) AS n FROM (SELECT unnest(y) AS g) GROUP BY g) k USING (g)) / (len(x) + len(y))"""


@query(f"WITH {_PAIRS}, g AS (SELECT *, {_GRAMS.format('a')} AS x, {_GRAMS.format('b')} AS y FROM pairs) SELECT p_brand, a, b, round({_DICE}, 6) AS score FROM g")
def sim_dice(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("score", F.round(S.dice(F.col("a"), F.col("b")), 6))


@query(f"""
    WITH {_PAIRS}, g AS (SELECT *, {_GRAMS.format('a')} AS x, {_GRAMS.format('b')} AS y, least(length(a), length(b))::DOUBLE / greatest(length(a), length(b)) AS r FROM pairs)
    SELECT p_brand, a, b, round(greatest({_JACCARD}, {_DICE}) * CASE WHEN r >= 0.6 THEN 1.0::DOUBLE ELSE r / 0.6::DOUBLE END, 6) AS score FROM g
""")
def sim_band(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("score", F.round(S.band_similarity(F.col("a"), F.col("b")), 6))


@query(f"WITH {_PAIRS} SELECT p_brand, a, b, round(jaro_winkler_similarity(a, b), 6) AS score FROM pairs")
def sim_jaro_winkler(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("score", F.round(S.jaro_winkler("a", "b"), 6))


@query()
def sim_ratcliff(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("score", F.round(S.ratcliff("a", "b"), 6))


_INITIAL_RULES = """CASE WHEN a = '' OR b = '' THEN 0.5 WHEN a = b THEN 1 WHEN starts_with(a, b) OR starts_with(b, a) THEN 0.95 WHEN list_sort(string_split(a, '')) = list_sort(string_split(b, '')) THEN 0.9
    WHEN a[1] = b[1] THEN CASE WHEN list_has_all(string_split(a, ''), string_split(b, '')) OR list_has_all(string_split(b, ''), string_split(a, '')) THEN 0.85 WHEN length(a) = length(b) AND hamming(a, b) = 1 THEN 0.75 ELSE 0.6 END
    WHEN list_has_any(string_split(a, ''), string_split(b, '')) THEN 0.15 ELSE 0 END::DOUBLE"""


@query(f"""
    WITH i AS (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: x[1]), '') || p_name[2:1 + p_size % 3] AS a, lower(array_to_string(list_transform(string_split(p_type, ' '), lambda x: x[1]), '')) || p_name[1:p_size % 2] AS b FROM part),
    w AS (SELECT p_partkey, a, b FROM i UNION ALL SELECT p_partkey, a, a[2:] || a[1] FROM i UNION ALL SELECT p_partkey, a, a[1:2] || b FROM i UNION ALL SELECT p_partkey, a, a[1:length(a) - 1] || 'q' FROM i)
    SELECT a, b, count(*) AS n, CASE WHEN length(a) = length(b) THEN {_INITIAL_RULES} ELSE {_INITIAL_RULES.replace('length(a) = length(b) AND hamming(a, b) = 1', 'false')} END AS score FROM w GROUP BY a, b
""")
def initials_score(spark: SparkSession, d: str) -> DataFrame:
    """Initials from the words of parts' names and types, against one another and turned, lengthened or with one misread."""
    heads = lambda c: F.array_join(F.transform(F.split(c, " "), lambda x: F.substring(x, 1, 1)), "")
    a = F.concat(heads("p_name"), F.substr("p_name", F.lit(2), (F.col("p_size") % 3).cast("int")))
    b = F.concat(F.lower(heads("p_type")), F.substr("p_name", F.lit(1), (F.col("p_size") % 2).cast("int")))
    rows = table(spark, d, "part").select(a.alias("a"), b.alias("b"))
    ways = F.array("b", F.concat(F.substr("a", F.lit(2)), F.substring("a", 1, 1)), F.concat(F.substring("a", 1, 2), "b"), F.concat(F.substr("a", F.lit(1), F.length("a") - 1), F.lit("q")))
    pairs = rows.select("a", F.explode(ways).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    return pairs.withColumn("score", S.initials_score(F.col("a"), F.col("b")))


@query(f"""
    WITH p AS (SELECT DISTINCT nation, a, b FROM (SELECT c_nationkey AS nation, lower(c_name)[-9:] AS a FROM customer) c JOIN (SELECT s_nationkey AS nation, lower(s_name)[-9:] AS b FROM supplier) s USING (nation)),
    n AS (SELECT nation, a AS x, b AS y, 's' || a[1:6] AS sa, 's' || b[1:6] AS sb, a[7:9] AS a, b[7:9] AS b FROM p), j AS (SELECT *, least(1, jaro_winkler_similarity(sa, sb) + 0.02) AS sur, CASE WHEN length(a) = length(b) THEN {_INITIAL_RULES} ELSE 0 END AS ini FROM n)
    SELECT nation, x, y, round(CASE WHEN sur < 0.87 THEN 0 ELSE 0.65 * sur + 0.35 * ini END::DOUBLE, 6) AS score FROM j
""")
def person_score(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers of a nation as people: the digits of their numbers are surname and initials."""
    surname, initials = lambda n: F.concat(F.lit("s"), F.substring(n, 1, 6)), lambda n: F.substr(n, F.lit(7))
    none = F.array().cast("array<string>")

    def people(t: str, name: str, nation: str, n: str) -> DataFrame:
        """The names of each surname, which is scored once for all of them, by whether their initials are plain."""
        rows = table(spark, d, t).select(F.col(nation).alias("nation"), F.right(F.lower(name), F.lit(9)).alias(n)).distinct().withColumn(f"{n}_plain", F.coalesce(initials(F.col(n)).rlike(S.PLAIN), F.lit(False)))
        rows = rows.withColumn("_c", F.struct(n, *S.initials_code(initials(F.col(n)))))
        return rows.groupBy("nation", surname(F.col(n)).alias(f"_{n}"), f"{n}_plain").agg(F.collect_list("_c").alias(f"{n}s"), F.count("*").alias(f"{n}_n"))

    def scored(xs: DataFrame, ys: DataFrame, score: Callable[[Column, Column], Column]) -> DataFrame:
        met = R.dealt_join(xs, ys, ["nation"], "_x", weights=("x_n", "y_n")).withColumn("_surname", S.surname_score(F.array("_x"), F.array("_y")))
        known = F.transform(F.array(*map(F.lit, S.INITIALS)), lambda i: F.round(S.person_score_at(F.col("_surname"), i, none, none), 6))
        met = met.withColumn("_known", known)  # all that the names of two surnames may score
        rows = met.select("nation", "_surname", "_known", F.explode("xs").alias("_x"), "ys").select("nation", "_surname", "_known", "_x", F.explode("ys").alias("_y"))
        return rows.select("nation", "_x.x", "_y.y", score(F.col("_x"), F.col("_y")).alias("score"))

    x, y = people("customer", "c_name", "c_nationkey", "x"), people("supplier", "s_name", "s_nationkey", "y")
    out = scored(x.where("x_plain"), y.where("y_plain"), lambda a, b: F.get("_known", S.initials_rule(a, b)))
    plainly = lambda a, b: F.round(S.person_score_of(F.col("_surname"), initials(a["x"]), initials(b["y"]), none, none), 6)
    for a, b, odd in ((x.where("not x_plain"), y, "not x_plain"), (x.where("x_plain"), y.where("not y_plain"), "not y_plain")):
        if not (a if odd == "not x_plain" else b).isEmpty():
            out = out.unionByName(scored(a, b, plainly))
    return out


_CANON = ("ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE")


@query(f"""
    WITH t AS (SELECT DISTINCT p_type AS raw, lower(regexp_extract(p_type, '^([A-Za-z]+)', 1)) || CASE WHEN length(p_type) % 2 = 0 THEN 's' ELSE '' END AS v FROM part),
    c(name) AS (VALUES {', '.join(f"('{c.lower()}')" for c in _CANON)}),
    g AS (SELECT raw, v, name, {_GRAMS.format('v')} AS x, {_GRAMS.format('name')} AS y FROM t CROSS JOIN c),
    s AS (SELECT raw, v, name, round({_DICE}, 6) AS score FROM g),
    r AS (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY score DESC, name) AS n FROM s)
    SELECT raw, CASE WHEN score >= 0.85 THEN name ELSE '' END AS snapped FROM r WHERE n = 1
""")
def canonical_snap(spark: SparkSession, d: str) -> DataFrame:
    v = F.concat(F.lower(F.regexp_extract("p_type", "^([A-Za-z]+)", 1)), F.when(F.length("p_type") % 2 == 0, "s").otherwise(""))
    raw = table(spark, d, "part").select(F.col("p_type").alias("raw"), v.alias("v")).distinct()
    return classify.snapped(raw, "v", [c.lower() for c in _CANON], 0.85).select("raw", "snapped")


_RULES = [("licence", r"licen[sc]e"), ("address", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|@"), ("shout", r"!!"), ("table", r" \| "), ("prose", r"[a-z]+ [a-z]+")]


@query("SELECT doc_id, " + "CASE " + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{n}'" for n, p in _RULES) + " ELSE 'other' END AS kind FROM documents")
def ordered_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", classify.first_rule(F.lower("text"), _RULES, "other").alias("kind"))


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{n}' END" for n, p in _RULES) + "], lambda x: x IS NOT NULL), ',') AS kinds FROM documents")
def contains_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(classify.every_rule(F.lower("text"), _RULES), ",").alias("kinds"))


_LABELS = ("Number in Band", "Anglican", "Roman Catholic", "Methodist", "Acres sown", "Bushels of Wheat harvested", "Male", "Female", "Live Stock", "Houses", "Name", "Pagan", "Hay", "Births and Deaths", "Under crop", "Remarks", "Census Return.", "Value of Produce")


@query(f"""
    WITH l AS (SELECT p_partkey, list_transform(range(0, 1 + p_size % 5), lambda i: {_LABELS!r}[(p_partkey // 3 * (i + 1) + p_size * i) % {len(_LABELS)} + 1]) AS c, CASE WHEN p_size % 9 = 0 THEN 'Agricultural and Industrial Statistics, acres' WHEN p_size % 9 = 1 THEN 'CENSUS' ELSE p_name END AS t FROM part),
    x AS (SELECT p_partkey, array_to_string(c, ' | ') || ' ' || t AS h FROM l),
    n AS (SELECT p_partkey, h, len(list_distinct(regexp_extract_all(lower(h), '{gates.DENOMINATIONS}'))) AS d, len(regexp_extract_all(lower(h), '{gates.CENSUS_LABELS}')) AS c, len(regexp_extract_all(lower(h), '{gates.FARM_LABELS}')) AS a FROM x)
    SELECT p_partkey, CASE WHEN regexp_matches(lower(h), '{gates.CENSUS_ALONE}') OR d >= 2 THEN 'census' WHEN c = 0 AND a = 0 THEN 'unknown' WHEN c > a THEN 'census' ELSE 'agri' END AS class FROM n
""".replace(repr(_LABELS), "[" + ", ".join(f"'{x}'" for x in _LABELS) + "]"))
def header_classify(spark: SparkSession, d: str) -> DataFrame:
    """Headers of one to five labels and a title, drawn by the part's numbers."""
    k, size = F.col("p_partkey"), F.col("p_size")
    labels = F.array(*map(F.lit, _LABELS))
    columns = F.transform(F.sequence(F.lit(0), size % 5), lambda i: F.element_at(labels, (F.pmod(F.floor(k / 3) * (i + 1) + size * i, F.lit(len(_LABELS))) + 1).cast("int")))
    title = F.when(size % 9 == 0, "Agricultural and Industrial Statistics, acres").when(size % 9 == 1, "CENSUS").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", gates.header_class(columns, title).alias("class"))
