"""Queries of tiers, claims, guarded clusters, record matching, ledgers and segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.functions.similarity import dice
from quillgraph.operators import identity as I
from quillgraph.operators import ledger as L
from quillgraph.operators import linking as K
from quillgraph.operators import relational as R
from quillgraph.operators import segmentation as S
from quillgraph.plans.registry import query, table

#: Names of parts as printed names: three ways to print them, by size.
_PRINTED = "CASE p_size % 3 WHEN 0 THEN initcap_w2 || ', ' || upper(w1[1]) || '.' WHEN 1 THEN upper(w1[1]) || '. ' || initcap_w2 ELSE initcap_w2 || ' ' || upper(w1[1]) || '.' END"
_WORDS = "w AS (SELECT p_partkey, p_size, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2, upper(split_part(p_name, ' ', 2)[1]) || substring(split_part(p_name, ' ', 2), 2) AS initcap_w2 FROM part)"


def _printed(spark: SparkSession, d: str) -> DataFrame:
    words = F.split("p_name", " ")
    first, last = F.upper(F.substring(words[0], 1, 1)), F.initcap(words[1])
    way = F.col("p_size") % 3
    raw = F.when(way == 0, F.concat(last, F.lit(", "), first, F.lit("."))).when(way == 1, F.concat(first, F.lit(". "), last)).otherwise(F.concat(last, F.lit(" "), first, F.lit(".")))
    return table(spark, d, "part").select("p_partkey", "p_brand", "p_size", raw.alias("raw"))


@query(f"WITH {_WORDS} SELECT p_partkey, {_PRINTED} AS raw, w2 AS surnames, w1[1] AS initials, w1[1] AS given FROM w")
def person_parse(spark: SparkSession, d: str) -> DataFrame:
    return M.persons(_printed(spark, d).select("p_partkey", "raw"), "raw")


#: Pairs of parts of one brand: the number is the size, the name its two words, and the likeness of names a Dice.
_GRAMS = "list_transform(range(1, length({0})), lambda i: substring({0}, i, 2))"
_DICE = f"""(2.0::DOUBLE * list_sum(list_transform(list_distinct({_GRAMS.format('{0}')}), lambda g: least(len(list_filter({_GRAMS.format('{0}')}, lambda h: h = g)), len(list_filter({_GRAMS.format('{1}')}, lambda h: h = g)))))
    / (length({{0}}) + length({{1}}) - 2))""".replace("{{", "{").replace("}}", "}")
_NAMED = "n AS (SELECT p_brand, p_name, min(p_partkey) AS id, min(p_size) AS no, count(*) AS n FROM part GROUP BY ALL)"
_PAIRS = f"{_NAMED}, p AS (SELECT a.p_brand || '/' || a.p_name AS k, b.id AS c, a.no = b.no AS num, split_part(a.p_name, ' ', 2) = split_part(b.p_name, ' ', 2) AS same, round({_DICE.format('a.p_name', 'b.p_name')}, 6) AS score FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_name <> b.p_name)"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("id"), F.min("p_size").alias("no"))
    a, b = n.toDF("p_brand", "a", "a_id", "a_no"), n.toDF("p_brand", "b", "c", "b_no")
    rows = a.join(b, "p_brand").where("a <> b")
    noun = lambda x: F.split(x, " ")[1]
    return rows.select(F.concat("p_brand", F.lit("/"), "a").alias("k"), "c", (F.col("a_no") == F.col("b_no")).alias("num"), (noun("a") == noun("b")).alias("same"), F.round(dice(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"""
    WITH {_PAIRS}, g AS (SELECT k, max(score) AS best, count(*) FILTER (num AND score >= 0.6) AS n1, count(*) FILTER (num) AS n2, count(*) FILTER (same AND score >= 0.8) AS n3, count(*) FILTER (score >= 0.6) AS n4,
        arg_max(c, (c, score)) FILTER (num AND score >= 0.6) AS c1, arg_max(c, (c, score)) FILTER (num) AS c2, arg_max(c, (c, score)) FILTER (same AND score >= 0.8) AS c3, arg_max(c, (c, score)) FILTER (score >= 0.6) AS c4 FROM p GROUP BY k),
    t AS (SELECT k, best, CASE WHEN n1 = 1 THEN 'T1' WHEN n2 = 1 THEN 'T2' WHEN n3 = 1 THEN 'T3' WHEN n4 = 1 THEN 'T4' WHEN best >= 0.6 THEN 'ambiguous' ELSE 'no_match' END AS tier, CASE WHEN n1 = 1 THEN c1 WHEN n2 = 1 THEN c2 WHEN n3 = 1 THEN c3 WHEN n4 = 1 THEN c4 END AS c FROM g)
    SELECT t.k, tier, t.c, coalesce(p.score, best) AS score FROM t LEFT JOIN p ON p.k = t.k AND p.c = t.c
""")
def evidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("score")
    tiers = [("T1", F.col("num") & (s >= 0.6)), ("T2", F.col("num")), ("T3", F.col("same") & (s >= 0.8)), ("T4", s >= 0.6)]
    return K.only_in_tier(_pairs(spark, d), "k", "c", "score", tiers, 0.6)


@query(f"""
    WITH {_PAIRS}, x AS (SELECT 0 AS r, 'M1' AS tier, * FROM p WHERE num UNION ALL SELECT 1, 'M2', * FROM p WHERE same UNION ALL SELECT 2, 'M3', * FROM p),
    w AS (SELECT *, row_number() OVER (PARTITION BY r, k ORDER BY score DESC, c) AS n, coalesce(lead(score) OVER (PARTITION BY r, k ORDER BY score DESC, c), 0) AS next FROM x),
    ok AS (SELECT * FROM w WHERE n = 1 AND score >= CASE r WHEN 0 THEN 0.5 WHEN 1 THEN 0.6 ELSE 0.7 END AND score - next >= CASE r WHEN 0 THEN 0 WHEN 1 THEN 0.02 ELSE 0.05 END - 1e-9)
    SELECT k, arg_min(tier, r) AS tier, arg_min(c, r) AS c, arg_min(score, r) AS score FROM ok GROUP BY k
""")
def tiers_by_margin(spark: SparkSession, d: str) -> DataFrame:
    return K.margin_tiers(_pairs(spark, d), "k", "c", "score", [("M1", F.col("num"), 0.5, 0.0), ("M2", F.col("same"), 0.6, 0.02), ("M3", F.lit(True), 0.7, 0.05)])


@query(f"""
    WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, c) AS n, coalesce(lead(score) OVER (PARTITION BY k ORDER BY score DESC, c), 0) AS next, max(score) OVER (PARTITION BY k) AS best, count(*) FILTER (score >= 0.8) OVER (PARTITION BY k) AS ties FROM p),
    q AS (SELECT k, c, best FROM r WHERE CASE WHEN best >= 0.8 AND ties > 1 THEN score >= 0.8 ELSE n = 1 AND ((score >= 0.6 AND score - next > 0.02) OR (score >= 0.5 AND score - next >= 0.1)) END),
    b AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY best DESC, k) AS n FROM q)
    SELECT c, k, best AS score FROM b WHERE n = 1
""")
def claims_settled(spark: SparkSession, d: str) -> DataFrame:
    return K.best_claims(_pairs(spark, d), "k", "c", "score", 0.6, 0.02, 0.5, 0.1, same=0.8)


@query("SELECT p_partkey, first_value(p_partkey) OVER (PARTITION BY p_brand, p_name ORDER BY p_size DESC, p_partkey) AS keeper FROM part")
def folded_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return K.folded(table(spark, d, "part"), "p_brand", "p_name", "p_partkey", "p_size")


@query("""
    WITH m AS (SELECT o_custkey, count(*) AS n, min(year(o_orderdate)) AS y FROM orders GROUP BY 1), c AS (SELECT c_nationkey, o_custkey, n, y FROM customer JOIN m ON c_custkey = o_custkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, y, o_custkey) AS k FROM c)
    SELECT c_nationkey, o_custkey AS canonical FROM r WHERE k = 1
""")
def canonical_member(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min(F.year("o_orderdate")).alias("y"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(m, "o_custkey")
    return K.canonical(c, "c_nationkey", "o_custkey", "n", "y")


@query()
def guarded_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Names of a brand, kept apart by the number in them and by their types, which corroborate weaker likeness."""
    rows = table(spark, d, "part").groupBy("p_brand", "p_name").agg(F.sort_array(F.collect_set("p_type")).alias("places"), F.min(F.col("p_size") % 2).cast("string").alias("number"))
    return K.guarded_clusters(rows, "p_brand", "p_name", 0.7, "number", "places", 0.5)


@query()
def pruned_components(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a nation and segment as name groups; their order years may not overlap in unlike order statuses."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"), F.count("*").alias("n"), F.min("o_orderpriority").alias("clash"))
    rows = table(spark, d, "customer").select(F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("g"), F.col("c_custkey").alias("o_custkey")).join(o, "o_custkey")
    return K.pruned(rows, "g", "o_custkey", "first", "last", "n", "clash")


@query("""
    WITH RECURSIVE s AS (SELECT p_partkey AS node, p_name AS name, p_brand AS region, CASE p_size % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'm' ELSE '' END AS kind FROM part),
    f AS (SELECT *, first_value(node) OVER w AS a, first_value(kind) OVER w AS ka FROM s WINDOW w AS (PARTITION BY name, region ORDER BY node))
    SELECT DISTINCT a, node AS b FROM f WHERE a <> node AND NOT (ka <> '' AND kind <> '' AND ka <> kind)
""")
def same_name_links(spark: SparkSession, d: str) -> DataFrame:
    way = F.col("p_size") % 3
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", F.when(way == 0, "f").when(way == 1, "m").otherwise("").alias("kind"))
    return K.same_name_links(rows, "p_partkey", "p_name", "p_brand", "kind")


@query()
def matched_records(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders against a second reading of them, with some pages, numbers and names misread."""
    line = table(spark, d, "lineitem")
    key = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    left = line.select(F.floor(F.col("l_orderkey") / 100).alias("block"), key.alias("id"), (F.col("l_orderkey") % 40).alias("page"), (F.col("l_partkey") % 97).alias("number"), F.concat_ws(" ", "l_returnflag", F.col("l_suppkey").cast("string")).alias("name"), F.col("l_extendedprice").alias("amount"))
    odd = F.pmod("id", F.lit(5))
    right = left.withColumn("page", F.col("page") + F.when(odd == 1, 1).otherwise(0)).withColumn("name", F.when(odd == 2, F.concat("name", F.lit(" x"))).otherwise(F.col("name"))).withColumn("number", F.when(odd == 3, F.lit(-1)).otherwise(F.col("number")))
    return K.matched_records(left, right, "block", "page", "number", "name", "amount")


@query("""
    WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id::VARCHAR), doc_id) AS n FROM documents)
    SELECT doc_id, lang FROM r WHERE n <= 5
""")
def sampled_kinds(spark: SparkSession, d: str) -> DataFrame:
    return K.sampled(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 5, 7)


@query("""
    SELECT o_orderkey, head, row_number() OVER (PARTITION BY o_custkey ORDER BY head ASC NULLS LAST, o_orderdate DESC, o_orderkey)::INTEGER AS place
    FROM (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderstatus END AS head FROM orders)
""")
def nulls_last_order(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's sheet in its printed order, with rows that have no head at its end."""
    rows = table(spark, d, "orders").withColumn("head", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderstatus")))
    w = Window.partitionBy("o_custkey").orderBy(F.asc_nulls_last("head"), F.desc("o_orderdate"), "o_orderkey")
    return rows.select("o_orderkey", "head", F.row_number().over(w).alias("place"))


@query("""
    WITH c AS (SELECT p_partkey AS id, first_value(p_partkey) OVER (PARTITION BY p_brand, p_name ORDER BY p_size DESC, p_partkey) AS canonical FROM part)
    SELECT DISTINCT l_returnflag, canonical, l_partkey AS observed FROM lineitem JOIN c ON id = l_partkey WHERE canonical <> l_partkey
""")
def observed_ids(spark: SparkSession, d: str) -> DataFrame:
    closure = K.folded(table(spark, d, "part"), "p_brand", "p_name", "p_partkey", "p_size").toDF("id", "canonical")
    return K.observed_ids(table(spark, d, "lineitem"), closure, "l_returnflag", "l_partkey")


@query("""
    WITH c AS (SELECT p_partkey AS id, first_value(p_partkey) OVER (PARTITION BY p_brand, p_name ORDER BY p_size DESC, p_partkey) AS canonical FROM part)
    SELECT canonical, lower(p_name) AS alias, count(*) AS n FROM lineitem JOIN c ON id = l_partkey JOIN part ON p_partkey = l_partkey GROUP BY ALL
""")
def alias_reaggregate(spark: SparkSession, d: str) -> DataFrame:
    """Counts of names as used, taken to the canonical ids by the closure of the redirects."""
    p = table(spark, d, "part")
    folded = K.folded(p, "p_brand", "p_name", "p_partkey", "p_size").toDF("id", "target").where("id <> target")
    closure = I.redirect_closure(folded).toDF("l_partkey", "canonical")
    used = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    rows = used.join(closure, "l_partkey", "left").join(p.select(F.col("p_partkey").alias("l_partkey"), F.lower("p_name").alias("alias")), "l_partkey")
    return rows.groupBy(F.coalesce("canonical", "l_partkey").alias("canonical"), "alias").agg(F.sum("n").alias("n"))


@query("""
    WITH ch AS (SELECT p_name AS name, min(p_brand) AS chain FROM part WHERE p_size > 45 GROUP BY 1), u AS (SELECT replace(lower(p_name), ' ', '') AS key, min(p_type) AS unit, count(DISTINCT p_type) AS n FROM part WHERE p_size < 4 GROUP BY 1)
    SELECT p_partkey, p_name, coalesce(chain, CASE WHEN n = 1 THEN unit END) AS unit, CASE WHEN chain IS NOT NULL THEN 'chain' WHEN n = 1 THEN 'unit' END AS how FROM part LEFT JOIN ch ON name = p_name LEFT JOIN u ON key = replace(lower(p_name), ' ', '')
""")
def unit_for(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    chains = p.where("p_size > 45").groupBy(F.col("p_name").alias("name")).agg(F.min("p_brand").alias("chain"))
    units = p.where("p_size < 4").select(F.replace(F.lower("p_name"), F.lit(" "), F.lit("")).alias("key"), F.col("p_type").alias("unit"))
    return K.unit_for(p.select("p_partkey", "p_name"), "p_name", chains, units)


# ---- names, over the columns of the tables; what each is printed with is taken off again

_N = "lower(p_name)"


@query(f"SELECT p_partkey, {_N} AS key FROM part")
def norm_band(spark: SparkSession, d: str) -> DataFrame:
    """Names of parts printed as bands, in four ways."""
    way, name = F.col("p_size") % 4, F.initcap("p_name")
    raw = F.when(way == 0, F.concat(F.lit("The Band of "), name)).when(way == 1, F.concat(name, F.lit(" Band."))).when(way == 2, F.concat(name, F.lit(" (2)"))).otherwise(F.concat(F.lit("Indians of "), name, F.lit("'s")))
    return table(spark, d, "part").select("p_partkey", M.band_key(raw).alias("key"))


@query(f"SELECT p_partkey, replace({_N}, ' ', '') AS key FROM part")
def fold_alias(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("p_name")
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("tlie "), F.replace(name, F.lit(" "), F.lit("-")), F.lit(" Band"))).otherwise(F.concat(name, F.lit(" (No. 2)")))
    return table(spark, d, "part").select("p_partkey", M.alias_key(raw).alias("key"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey::VARCHAR || CASE l_returnflag WHEN 'N' THEN '' ELSE l_returnflag END AS no FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem)")
def norm_number(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("No. "), F.col("l_partkey").cast("string"), F.when(F.col("l_returnflag") != "N", F.concat(F.lit(" "), "l_returnflag")).otherwise(""), F.lit(" and pt. of 31"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct()
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", M.first_number(raw).alias("no"))


@query("SELECT n_nationkey, ['ON', 'QC', 'MBNWT', 'YT', '?'][n_nationkey % 5 + 1] AS region, ['Ontario', 'Quebec', 'North-West Territories', 'Yukon', 'Elsewhere'][n_nationkey % 5 + 1] AS province FROM nation")
def province_group(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, ("PROVINCE OF ONTARIO", "Quebec - Con.", "NORTH - WEST", "District of Yukon", "ELSEWHERE")))
    return table(spark, d, "nation").withColumn("raw", names[F.col("n_nationkey") % 5]).select("n_nationkey", M.region_group("raw").alias("region"), M.province("raw").alias("province"))


@query("SELECT p_partkey, upper(p_name) AS name, p_size::VARCHAR || 'A' AS number FROM part")
def split_name_no(spark: SparkSession, d: str) -> DataFrame:
    word = F.when(F.col("p_size") % 2 == 0, " I.R. ").otherwise(" INDIAN RESERVE NO. ")
    raw = F.concat(F.upper("p_name"), word, F.col("p_size").cast("string"), F.lit("a"))
    return table(spark, d, "part").select("p_partkey", M.name_and_number(raw).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, upper(replace(p_name, ' ', ' - ')) || ' AGENCY' AS unit FROM part")
def canonical_unit(spark: SparkSession, d: str) -> DataFrame:
    name = F.replace("p_name", F.lit(" "), F.lit(" and "))
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Report of the "), name, F.lit(" Agency, 1899"))).otherwise(F.concat(F.lit("TREATY NO. 4, "), name, F.lit(" AGENCY")))
    return table(spark, d, "part").select("p_partkey", M.unit_name(raw).alias("unit"))


@query("SELECT p_partkey, p_name AS name, ['rev', 'miss', ''][p_size % 3 + 1] AS title, ['m', 'f', ''][p_size % 3 + 1] AS class, CASE p_size % 3 WHEN 2 THEN 'farmer' ELSE 'teacher' END AS role FROM part")
def clean_teacher(spark: SparkSession, d: str) -> DataFrame:
    way = F.col("p_size") % 3
    raw = F.when(way == 0, F.concat(F.lit("Rev. "), "p_name")).when(way == 1, F.concat(F.lit("Miss "), "p_name", F.lit(","))).otherwise(F.concat("p_name", F.lit(", Farmer.")))
    return table(spark, d, "part").select("p_partkey", M.titled(raw).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, upper(p_name[1]) || substring(p_name, 2) || CASE WHEN p_size % 2 = 0 THEN ', acres sown' ELSE '' END AS label FROM part")
def series_labels(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("crop_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.when(F.col("p_size") % 2 == 0, "_acres_sown").otherwise(""))
    return table(spark, d, "part").select("p_partkey", M.series_label(raw).alias("label"))


@query(f"SELECT p_partkey, array_to_string(list_sort(list_distinct([{_N}, replace({_N}, ' ', '')])), '|') AS variants FROM part")
def registry_variants(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("The "), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" First Nation"))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(M.registry_variants(raw)), "|").alias("variants"))


@query(f"SELECT p_partkey, array_to_string(list_sort(list_distinct([{_N}, lower(p_type)])), '|') AS variants FROM part")
def modern_variants(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat("p_name", F.lit(" Indian Band No. 4 ("), "p_type", F.lit(")"))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(M.modern_variants(raw)), "|").alias("variants"))


@query(f"SELECT p_partkey, array_to_string(list_sort([{_N}, {_N} || ' treaty', 'indians of ' || {_N}, 'indians of ' || {_N} || ' treaty']), '|') AS variants FROM part")
def account_readings(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("Indians of the "), "p_name", F.lit(" Band, Treaty No. 2"))
    return R.spread(table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey").select("p_partkey", F.array_join(F.array_sort(M.account_readings(raw)), "|").alias("variants"))


@query(f"SELECT p_partkey, {_N} || ' no ' || p_size::VARCHAR AS key, p_size::VARCHAR AS number FROM part")
def school_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("2"), F.initcap("p_name"), F.lit(" Day School (Continued) No. "), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", M.school_key(raw).alias("key")).withColumn("number", M.school_number("key"))


@query("SELECT p_partkey, upper(p_name) || ' Agency' AS name, lower(p_name) AS key FROM part")
def agency_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.upper("p_name"), F.when(F.col("p_size") % 2 == 0, "  AGENCY. -").otherwise(" AGENCY AT"))
    name = M.agency_name(F.regexp_replace(raw, r"\. -$", " -"))
    return table(spark, d, "part").select("p_partkey", name.alias("name"), M.agency_key(name).alias("key"))


@query("SELECT p_partkey, ['treaty', 'agency', 'county'][p_size % 3 + 1] AS type, CASE p_size % 3 WHEN 0 THEN 'TREATY NO. ' || p_size::VARCHAR WHEN 1 THEN upper(replace(p_name, ' ', ' - ')) || ' AGENCY' ELSE upper(p_name) END AS name FROM part")
def divisions(spark: SparkSession, d: str) -> DataFrame:
    way = F.col("p_size") % 3
    raw = F.when(way == 0, F.concat(F.lit("Bands of Treaty No. "), F.col("p_size").cast("string"), F.lit("."))).when(way == 1, F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" Agency, British Columbia"))).otherwise(F.concat("p_name", F.lit(" County.")))
    return table(spark, d, "part").select("p_partkey", M.division(raw).alias("x")).select("p_partkey", "x.*")


@query("""
    SELECT conv_id, turn, CASE WHEN regexp_matches(upper(text), 'AUDIT') THEN 'audit' WHEN regexp_matches(upper(text), 'COMMISSION') THEN 'commission' WHEN regexp_matches(upper(text), 'INSPECTOR') THEN 'inspection'
        WHEN regexp_matches(upper(text), 'SURVEY|D\\.?L\\.?S\\.') THEN 'survey' WHEN role = 'user' AND regexp_matches(upper(text), 'RECAPITULATION|STATEMENT|TABLE|SUMMARY') THEN 'table_fragment' WHEN role = 'assistant' THEN 'agency_report' ELSE 'unknown' END AS kind FROM conversations
""")
def letter_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", M.letter_kind(F.upper("text"), F.lit(None), F.when(F.col("role") == "assistant", "agency")).alias("kind"))


# ---- ledgers

_SHAPES = "CASE l_orderkey % 4 WHEN 0 THEN 'ledger_dr_cr_5' WHEN 1 THEN 'ledger_dr_cr_4' WHEN 2 THEN 'ledger_split_3' ELSE 'ledger_debit_2' END"
_MONEY = "l_extendedprice::DECIMAL(18,2)::VARCHAR"


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    way = F.col("l_orderkey") % 4
    columns = F.when(way == 0, F.array(*map(F.lit, ("Capital", "Interest", "Cr.", "Capital", "Interest")))).when(way == 1, F.array(*map(F.lit, ("Capital", "Interest", "CR Capital", "Interest")))).when(way == 2, F.array(*map(F.lit, ("Capital", "Interest")))).otherwise(F.array(*map(F.lit, ("Debit", "Credit"))))
    price, tax = F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.col("l_tax").cast("decimal(18,2)").cast("string")
    none = F.lit(None).cast("string")
    values = F.when(way == 0, F.array(price, tax, F.lit("By Balance, 1889"), none, tax)).when(way == 1, F.array(price, none, tax, none)).when(way == 2, F.array(price, F.lit("By sale"), tax)).otherwise(F.array(none, price))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit("To Balance on 30th June, 1890").alias("label"), columns.alias("columns"), values.alias("values"))
    return rows.withColumn("declared", L.shape(F.col("columns"), F.lit("Return B")))


@query(f"SELECT DISTINCT l_orderkey, {_SHAPES} AS declared, {_SHAPES} AS shape FROM lineitem")
def ledger_shapes(spark: SparkSession, d: str) -> DataFrame:
    return L.effective_shape(_ledger(spark, d), "l_orderkey", "values", "declared").select("l_orderkey", "declared", "shape").distinct()


@query(f"""
    WITH l AS (SELECT l_orderkey, l_orderkey % 4 AS w, {_MONEY}::DOUBLE AS price, l_tax::DECIMAL(18,2)::DOUBLE AS tax FROM lineitem), b AS (SELECT 'To Balance on 30th June, 1890' AS t)
    SELECT l_orderkey, 'Dr' AS side, t AS description, price AS capital, CASE WHEN w = 0 THEN tax END AS interest FROM l, b WHERE w < 3
    UNION ALL SELECT l_orderkey, 'Cr', CASE w WHEN 0 THEN 'By Balance, 1889' WHEN 1 THEN NULL WHEN 2 THEN 'By sale' ELSE t END, CASE w WHEN 0 THEN NULL WHEN 3 THEN price ELSE tax END, CASE WHEN w = 0 THEN tax END FROM l, b
""")
def ledger_sides(spark: SparkSession, d: str) -> DataFrame:
    return L.entries(_ledger(spark, d), "l_orderkey", "label", "values", "declared")


@query(f"""
    WITH l AS (SELECT l_orderkey, l_orderkey % 4 AS w, {_MONEY}::DOUBLE AS price, l_tax::DECIMAL(18,2)::DOUBLE AS tax FROM lineitem)
    SELECT l_orderkey, 'closing' AS kind, 1890 AS stated_year, price AS amount FROM l WHERE w < 3
    UNION ALL SELECT l_orderkey, 'opening', 1889, tax FROM l WHERE w = 0 UNION ALL SELECT l_orderkey, 'opening', 1890, price FROM l WHERE w = 3
""")
def balance_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.balances(L.entries(_ledger(spark, d), "l_orderkey", "label", "values", "declared"), "l_orderkey")


@query("""
    WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'total' WHEN 'signup' THEN 'headers' ELSE 'row' END AS kind, CASE WHEN event_id % 5 = 0 THEN (event_id // 50 % 3)::VARCHAR END AS section FROM events),
    p AS (SELECT *, lag(kind) OVER w AS before, last_value(section IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last, row_number() OVER w AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, event_id, sum(CASE WHEN n > 1 AND (coalesce(before = 'total', false) OR kind = 'headers' OR coalesce(section <> last, false)) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS block FROM p
""")
def ledger_blocks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "total").when(F.col("event_type") == "signup", "headers").otherwise("row")
    section = F.when(F.col("event_id") % 5 == 0, (F.floor(F.col("event_id") / 50) % 3).cast("string"))
    return L.account_blocks(e.select("user_id", "event_id", kind.alias("kind"), section.alias("section")), "user_id", "event_id", "kind", "section").select("user_id", "event_id", "block")


# ---- segments of volumes


@query()
def volume_segments(spark: SparkSession, d: str) -> DataFrame:
    """Twenty documents bound as a volume, a page each, with headings and captions between them; every other volume is one of letters, and some have an opening or front matter."""
    docs = table(spark, d, "documents").where("text is not null").withColumn("volume", F.floor(F.col("doc_id") / 20))
    way = F.col("doc_id") % 4
    head = F.when(way == 0, F.concat(F.lit("\nINDIAN OFFICE NO "), F.col("doc_id").cast("string"), F.lit("\n\n"))).when(way == 1, F.lit("RETURN A (1).\n")).when(way == 2, F.lit("ONTARIO.\n")).otherwise("")
    letter = F.col("volume") % 2 == 1
    body = F.concat(F.when(letter, "SIR,—").otherwise(""), "text", F.when(letter, "\nI am, Sir,\nYour obedient servant,\nA. NAME,\nAgent.\n").otherwise("\n"))
    part = F.concat(F.lit("<!-- page "), (F.col("doc_id") % 1000).cast("string"), F.lit(" -->\n"), head, body)
    bound = docs.select("volume", "doc_id", part.alias("part")).groupBy("volume").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "part"))), lambda x: x["part"]), "").alias("text"))
    front = F.when(F.col("volume") % 8 == 7, '---\ndocument_type: "schedule"\n---\n').otherwise("")
    opening = F.when(F.col("volume") % 3 == 0, "Annual report of the Department\nfor the year, with its returns\nTo His Excellency the Governor General\n\nCONTENTS.\nLetters of the year, 1\nReturns, 2\n" + "The Department reports on the year. " * 6 + "\n\n").otherwise("")
    return S.segmented(bound.select(F.col("volume").alias("doc_id"), F.concat(front, opening, "text").alias("text")))
