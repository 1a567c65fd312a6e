"""Queries of graph assembly, row and page gates, and what running text states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import names as M
from quillgraph.functions import numbers as U
from quillgraph.functions import similarity as S
from quillgraph.functions.similarity import dice
from quillgraph.functions.text import norm
from quillgraph.operators import assembly as A
from quillgraph.operators import fulltext as T
from quillgraph.operators import gates as G
from quillgraph.operators import graph as H
from quillgraph.operators import linking as K
from quillgraph.operators import narrative as N
from quillgraph.plans import links, retrieval
from quillgraph.plans.registry import query, table


def _one_of(index: Column, *values: object) -> Column:
    """The value at a place, from 0."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), index.cast("int"))


# ---- the tables of a graph


def _graph_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The star schema as a graph's tables: parts are reserves, brands bands, suppliers schools, customers people, documents segments."""
    t = {n: table(spark, d, n) for n in ("nation", "part", "supplier", "orders", "lineitem", "documents", "conversations")}
    line = t["lineitem"].join(t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    taught = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").join(t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), "o_orderkey")
    year = lambda c: F.year(c)
    brands = t["part"].groupBy("p_brand").agg(F.min("p_partkey").alias("q"), F.min("p_name").alias("label"))
    succeeded = brands.select(F.lit("band").alias("type"), F.col("p_brand").alias("id"), F.concat(F.lit("Q"), F.col("q").cast("string")).alias("qid"), "label")
    return {
        "events": t["nation"].select(F.col("n_nationkey").alias("from_chain"), _one_of(F.col("n_regionkey") % 2, "MERGED_INTO", "RENAMED_TO").alias("event_type"), ((F.col("n_nationkey") + 5) % 25).alias("to_chain"), (F.col("n_nationkey") + 1880).alias("year"), F.col("n_name").alias("evidence")),
        "reserves": t["part"].select(F.col("p_partkey").alias("reserve_id"), F.col("p_brand").alias("band_id"), F.col("p_type").alias("agency_id"), F.lit(1902).alias("year")),
        "successors": succeeded.union(t["part"].where("p_size = 1").select(F.lit("reserve"), F.col("p_partkey").cast("string"), F.concat(F.lit("Q"), F.col("p_partkey").cast("string")), "p_name")),
        "band_years": t["lineitem"].join(t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").select(F.col("p_brand").alias("band_id"), F.col("l_returnflag").alias("agency_id"), year("l_shipdate").alias("year"), F.col("l_returnflag").alias("printed")),
        "school_years": line.select(F.col("l_suppkey").alias("school_id"), F.col("s_nationkey").alias("agency_id"), F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("reserve_id"), year("l_shipdate").alias("year"), F.col("l_returnflag").alias("printed")),
        "teachers": taught.select(F.col("o_custkey").alias("person_id"), F.col("l_suppkey").alias("school_id"), year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("printed")),
        "postings": t["orders"].groupBy("o_custkey", "o_orderpriority").agg(F.min(year("o_orderdate")).alias("first_year"), F.max(year("o_orderdate")).alias("last_year")).select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("agency_id"), "first_year", "last_year", F.col("o_orderpriority").alias("printed")),
        "segments": t["documents"].select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("segment"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("agency_id"), F.col("source").alias("school_id"), (F.col("doc_id") % 10 + 1990).alias("year"), F.col("lang").alias("heading")),
        "mentions": t["conversations"].select(F.concat(F.lit("doc"), F.col("conv_id").cast("string")).alias("segment"), _one_of(F.col("turn") % 2, "person", "band").alias("entity_type"), F.concat(F.lit("P"), (F.col("conv_id") % 50).cast("string")).alias("entity_id"), _one_of(F.col("turn") % 3, "high", "low", "medium").alias("confidence"), F.col("role").alias("context_agency"), (F.col("turn") + 1990).alias("year")),
    }


@query("""
    WITH seg AS (SELECT 'doc' || doc_id::VARCHAR AS segment, CASE WHEN doc_id % 3 > 0 THEN lang END AS agency, source AS school, 1990 + doc_id % 10 AS y, lang FROM documents),
    men AS (SELECT c.*, 'doc' || conv_id::VARCHAR AS segment, 'P' || (conv_id % 50)::VARCHAR AS who FROM conversations c WHERE turn % 2 = 0 AND turn % 3 <> 1),
    post AS (SELECT o_custkey, o_orderpriority, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders GROUP BY ALL),
    e(src_type, src_id, edge, dst_type, dst_id, year, evidence, source) AS (
        SELECT 'agency', n_nationkey::VARCHAR, CASE WHEN n_regionkey % 2 = 0 THEN 'MERGED_INTO' ELSE 'RENAMED_TO' END, 'agency', ((n_nationkey + 5) % 25)::VARCHAR, 1880 + n_nationkey, n_name, 'events' FROM nation
        UNION ALL SELECT 'reserve', p_partkey::VARCHAR, 'ADMINISTERED_BY', 'agency', p_type, 1902, NULL, 'reserves' FROM part
        UNION ALL SELECT 'band', p_brand, 'OCCUPIES', 'reserve', p_partkey::VARCHAR, 1902, NULL, 'reserves' FROM part
        UNION ALL SELECT 'band', p_brand, 'SUCCEEDED_BY', 'wikidata', 'Q' || min(p_partkey)::VARCHAR, NULL, min(p_name), 'successors' FROM part GROUP BY p_brand
        UNION ALL SELECT 'reserve', p_partkey::VARCHAR, 'SUCCEEDED_BY', 'wikidata', 'Q' || p_partkey::VARCHAR, NULL, p_name, 'successors' FROM part WHERE p_size = 1
        UNION ALL SELECT 'band', p_brand, 'ADMINISTERED_BY', 'agency', l_returnflag, year(l_shipdate), l_returnflag, 'band_years' FROM lineitem JOIN part ON p_partkey = l_partkey
        UNION ALL SELECT 'school', l_suppkey::VARCHAR, 'IN_AGENCY', 'agency', s_nationkey::VARCHAR, year(l_shipdate), l_returnflag, 'school_years' FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        UNION ALL SELECT 'school', l_suppkey::VARCHAR, 'ON_RESERVE', 'reserve', l_partkey::VARCHAR, year(l_shipdate), l_returnflag, 'school_years' FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'R'
        UNION ALL SELECT 'person', o_custkey::VARCHAR, 'TAUGHT_AT', 'school', l_suppkey::VARCHAR, year(o_orderdate), o_orderpriority, 'teachers' FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        UNION ALL SELECT 'person', o_custkey::VARCHAR, 'POSTED_TO', 'agency', o_orderpriority, unnest(range(a, b + 1)), o_orderpriority, 'postings' FROM post
        UNION ALL SELECT 'school', school, 'REPORTED_IN', 'segment', segment, y, lang, 'segments' FROM seg
        UNION ALL SELECT 'person', who, 'SIGNED_FOR', 'agency', coalesce(agency, role), 1990 + turn, segment, 'mentions' FROM men LEFT JOIN seg USING (segment)
        UNION ALL SELECT 'person', who, 'REPORTED_ON', 'school', school, 1990 + turn, segment, 'mentions' FROM men JOIN seg USING (segment))
    SELECT src_type, src_id, edge, dst_type, dst_id, year::INTEGER AS year, min(evidence) AS evidence, min(source) AS source FROM e WHERE src_id IS NOT NULL AND dst_id IS NOT NULL GROUP BY ALL
""")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return A.graph_edges(_graph_tables(spark, d))


@query("""
    WITH c AS (SELECT l_partkey AS id, min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b, count(DISTINCT year(l_shipdate)) AS n FROM lineitem GROUP BY 1), p AS (SELECT * FROM part WHERE p_size < 20)
    SELECT 'reserve' AS type, coalesce(p_partkey, id)::VARCHAR AS id, coalesce(p_name, 'as counted') AS name, p_brand AS region, CASE WHEN id IS NULL THEN 'schedule' WHEN p_partkey IS NULL THEN 'census' ELSE 'schedule+census' END AS kind,
        least(a, CASE WHEN p_partkey IS NOT NULL THEN 1995 END)::INTEGER AS first_year, greatest(b, CASE WHEN p_partkey IS NOT NULL THEN 1995 END)::INTEGER AS last_year, coalesce(n, 0) + CASE WHEN p_partkey IS NULL THEN 0 ELSE 1 END AS n_years
    FROM p FULL JOIN c ON id = p_partkey
""")
def entity_sources(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a schedule of 1995, and parts as counted in the years of the lines."""
    known = table(spark, d, "part").where("p_size < 20").select(F.lit("reserve").alias("type"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("region"), F.lit(1995).alias("first_year"), F.lit(1995).alias("last_year"), F.lit(1).cast("long").alias("n_years"))
    y = F.year("l_shipdate")
    counted = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.count_distinct(y).alias("n_years"))
    counted = counted.select(F.lit("reserve").alias("type"), "id", F.lit("as counted").alias("name"), F.lit(None).cast("string").alias("region"), "first_year", "last_year", "n_years")
    return A.entities([("schedule", known), ("census", counted)])


@query("""
    WITH n AS (SELECT p_name AS name, min(p_size) + 1880 AS a, max(p_size) % 7 AS w FROM part GROUP BY 1), c AS (SELECT name, a, a + w AS b, list_distinct(list_filter(regexp_extract_all(lower(name), '[a-z]+'), lambda x: length(x) >= 4)) AS ws FROM n)
    SELECT x.name AS before, y.name AS after, y.a::INTEGER AS year FROM c x JOIN c y ON x.name <> y.name AND y.a BETWEEN x.b AND x.b + 3 AND list_has_any(x.ws, y.ws)
""")
def chain_events(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg((F.min("p_size") + 1880).cast("int").alias("first_year"), (F.max("p_size") % 7).cast("int").alias("w"))
    return A.chain_events(n.select(F.col("name").alias("chain"), "name", "first_year", (F.col("first_year") + F.col("w")).alias("last_year")))


@query("""
    SELECT user_id, event_type AS section, event_type || '_' || (event_id % 2)::VARCHAR AS label, min(hour(ts))::INTEGER AS first_year, max(hour(ts))::INTEGER AS last_year, count(*) AS n,
        string_agg(hour(ts)::VARCHAR || ':' || event_id::VARCHAR, '|' ORDER BY hour(ts), event_id) AS cells FROM events GROUP BY ALL
""")
def series_sections(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.concat("event_type", F.lit("_"), (F.col("event_id") % 2).cast("string")).alias("series"), F.hour("ts").alias("year"), "event_id")
    return A.series_sections(e, "user_id", "series", "year", "event_id")


@query("""
    WITH k AS (SELECT lower(p_name) AS key, min(p_partkey) AS id FROM part WHERE p_size < 10 GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1)
    SELECT p_partkey, id AS reserve FROM part LEFT JOIN k ON key = lower(p_name)
""")
def reserve_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Parts printed as reserves, by the only small part of that name."""
    p = table(spark, d, "part")
    names = p.where("p_size < 10").select(norm("p_name").alias("key"), F.col("p_partkey").alias("id"))
    key = M.reserve_key(F.concat("p_name", F.lit(" I.R. No. 4")))
    return A.one_of_a_name(p.select("p_partkey", "p_name"), key, names, "reserve").drop("p_name")


# ---- gates


@query("""
    WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderkey % 60 AS page, o_orderkey % 7 AS way, o_custkey % 2 = 0 AS nobody, o_orderpriority LIKE '1%' AS money, CASE o_orderstatus WHEN 'F' THEN 'day' ELSE 'boarding' END AS extracted FROM orders),
    p AS (SELECT y, page, any_value(CASE WHEN page = 10 THEN 'end' WHEN page < 20 THEN 'day' WHEN page < 35 THEN 'industrial' ELSE 'staff' END) AS type FROM o WHERE page < 50 GROUP BY y, page), l AS (SELECT y, max(page) AS last FROM p WHERE type <> 'end' GROUP BY y)
    SELECT o_orderkey, CASE WHEN type IN ('day', 'industrial') THEN type ELSE '' END AS printed, CASE WHEN type IN ('day', 'industrial') THEN type ELSE extracted END AS type,
        CASE way WHEN 1 THEN 'unit' WHEN 2 THEN 'province' WHEN 3 THEN 'person' WHEN 4 THEN 'blank' ELSE CASE WHEN coalesce(type = 'end' OR page > last + 2, page > last + 2) THEN 'end' WHEN nobody AND money THEN 'sale' ELSE 'kept' END END AS fate
    FROM o LEFT JOIN p USING (y, page) LEFT JOIN l USING (y)
""")
def gated_rows(spark: SparkSession, d: str) -> DataFrame:
    way, page = F.col("o_orderkey") % 7, F.col("o_orderkey") % 60
    name = _one_of(way, "Moose Woods", "Battle River Agency", "Ontario.", "Rev. J. Smith", " ", "Carlton Day School District", "Crooked Lakes")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    values = F.when(F.col("o_orderpriority").startswith("1"), F.array(price, F.lit(None).cast("string"))).otherwise(F.array(F.lit("30"), F.lit("21")))
    rows = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), page.alias("page"), name.alias("name"), F.when(F.col("o_custkey") % 2 == 1, "Miss Bell").alias("teacher"), F.lit(None).cast("string").alias("denomination"), values.alias("values"), F.when(F.col("o_orderstatus") == "F", "day").otherwise("boarding").alias("extracted"))
    kind = F.when(F.col("page") == 10, "end").when(F.col("page") < 20, "day").when(F.col("page") < 35, "industrial").otherwise("staff")
    return G.gated_rows(rows, rows.where("page < 50").select("year", "page", kind.alias("type")).distinct()).select("o_orderkey", "printed", "type", "fate")


@query("SELECT o_orderkey, o_orderstatus = 'F' AS school FROM orders")
def school_headers(spark: SparkSession, d: str) -> DataFrame:
    cols = lambda *c: F.array(*map(F.lit, c))
    columns = F.when(F.col("o_orderstatus") == "F", cols("Name", "Number on Roll")).when(F.col("o_orderstatus") == "O", cols("Number of Schools", "Number on Roll")).otherwise(cols("Tribe"))
    return table(spark, d, "orders").select("o_orderkey", M.is_school_header(columns).alias("school"))


_COUNTED = "SELECT page_id, len(regexp_extract_all(coalesce(html, ''), '<p[ >]')) AS n, len(regexp_extract_all(coalesce(html, ''), '<li|class=\"ad\"')) AS m FROM pages"


@query(f"SELECT page_id, (n >= 3 AND m < 12) OR (n >= 1 AND m = 0) AS article FROM ({_COUNTED})")
def page_gate(spark: SparkSession, d: str) -> DataFrame:
    """Pages that read as articles by their paragraphs, against lists and adverts."""
    return table(spark, d, "pages").select("page_id", G.reads_as(F.col("html"), "<p[ >]", '<li|class="ad"', 3, 12).alias("article"))


@query("""
    WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity AS a, l_quantity * [1.1, 10, 100, 50, 1000][(l_orderkey % 5 + 1)::INTEGER]::DOUBLE AS b FROM lineitem WHERE l_quantity > 0)
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN 'unit_mismatch' WHEN l_orderkey % 5 IN (1, 2, 4) THEN 'ocr_digit' ELSE 'real_change_candidate' END AS disposition, CASE WHEN l_linenumber = 3 THEN 'high' WHEN l_orderkey % 5 = 3 THEN 'low' ELSE 'medium' END AS confidence FROM l
""")
def area_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_quantity > 0").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("a")).distinct()
    b = F.col("a") * _one_of(F.col("l_orderkey") % 5, 1.1, 10.0, 100.0, 50.0, 1000.0)
    return rows.select("l_orderkey", "l_linenumber", G.area_change(F.col("a"), b, F.col("l_linenumber") == 3).alias("f")).select("l_orderkey", "l_linenumber", "f.*")


@query(f"""
    WITH r AS (SELECT p_partkey AS id, p_partkey % 2 AS edition, CASE WHEN p_partkey % 3 = 0 THEN 'QC' ELSE p_brand END AS region, p_partkey % 100 AS page, CASE WHEN p_partkey % 11 > 0 THEN p_size::VARCHAR ELSE '' END AS no, CASE WHEN p_partkey % 11 > 0 THEN lower(p_name) ELSE '' END AS name, CASE WHEN p_partkey % 11 > 0 AND p_partkey % 4 > 0 THEN lower(p_type) ELSE '' END AS band, floor(p_retailprice)::VARCHAR AS acres FROM part),
    m AS (SELECT p_partkey % 2 AS edition, p_partkey % 100 + p_size % 2 * 10 AS page, p_size::VARCHAR AS no, lower(p_name) AS name, p_partkey AS entry FROM part WHERE p_size BETWEEN 10 AND 30),
    g AS (SELECT p_partkey AS entry, CASE WHEN p_partkey % 5 = 0 THEN 'QC' ELSE p_brand END AS region, (p_size + 1)::VARCHAR AS no, lower(p_name) || CASE WHEN p_partkey % 7 = 0 THEN ' river' ELSE '' END AS name, lower(p_type) AS band, floor(p_retailprice)::VARCHAR AS acres FROM part WHERE p_size <= 40),
    d AS (SELECT r.id, min(entry) AS e FROM r JOIN m ON r.edition = m.edition AND r.no = m.no AND abs(r.page - m.page) <= 2 WHERE {links._DICE.format('r.name', 'm.name')} >= 0.7 OR (r.name <> '' AND r.name = m.name) GROUP BY 1),
    s AS (SELECT r.id, min(entry) AS e, count(*) AS n FROM r JOIN g ON r.region = g.region AND r.no = g.no AND r.name = g.name WHERE r.no <> '' AND r.name <> '' GROUP BY 1),
    b AS (SELECT r.id, min(entry) AS e, count(*) AS n FROM r JOIN g ON r.region = g.region AND r.band <> '' AND (r.band = g.band OR {links._DICE.format('r.band', 'g.band')} >= 0.75) WHERE {links._DICE.format('r.name', 'g.name')} >= 0.6 OR r.acres = g.acres GROUP BY 1),
    w AS (SELECT r.id, min(entry) AS e, count(*) AS n FROM r JOIN g ON r.region = g.region AND r.region = 'QC' AND r.name <> '' WHERE {links._DICE.format('r.name', 'g.name')} >= 0.7 OR (length(r.name) >= 5 AND contains(g.name, r.name)) OR (length(g.name) >= 5 AND contains(r.name, g.name)) GROUP BY 1),
    f AS (SELECT r.id, CASE WHEN no || name || band = '' THEN 0 WHEN d.e IS NOT NULL THEN 1 WHEN s.n = 1 THEN 2 WHEN b.n = 1 THEN 3 WHEN w.n = 1 THEN 4 ELSE 5 END AS f, d.e AS e1, s.e AS e2, b.e AS e3, w.e AS e4 FROM r LEFT JOIN d ON d.id = r.id LEFT JOIN s ON s.id = r.id LEFT JOIN b ON b.id = r.id LEFT JOIN w ON w.id = r.id)
    SELECT id, ['degenerate_row', 'duplicate_emission', 'greedy_steal', 'renumbered_link', 'renumbered_link', 'absence_candidate'][f + 1] AS disposition, ['high', 'high', 'medium', 'medium', 'low', 'low'][f + 1] AS confidence, CASE f WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 WHEN 4 THEN e4 END AS proposed FROM f
""")
def leftover_fates(spark: SparkSession, d: str) -> DataFrame:
    """All parts as rows left over, against matched rows and a registry whose numbers and names drifted; likeness is Dice, which SQL has."""
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    known = lambda c, when=k % 11 > 0: F.when(when, F.col(c))
    edition, page, acres = (k % 2).alias("edition"), k % 100, F.floor("p_retailprice").cast("string").alias("acres")
    region = lambda n: F.when(k % n == 0, "QC").otherwise(F.col("p_brand")).alias("region")
    rows = p.select(k.alias("id"), edition, region(3), page.alias("page"), known("p_size").cast("string").alias("no"), known("p_name").alias("name"), known("p_type", (k % 11 > 0) & (k % 4 > 0)).alias("band"), acres)
    matched = p.where("p_size between 10 and 30").select(edition, (page + F.col("p_size") % 2 * 10).alias("page"), F.col("p_size").cast("string").alias("no"), F.col("p_name").alias("name"), k.alias("entry"))
    registry = p.where("p_size <= 40").select(k.alias("entry"), region(5), (F.col("p_size") + 1).cast("string").alias("no"), F.concat("p_name", F.when(k % 7 == 0, " river").otherwise("")).alias("name"), F.col("p_type").alias("band"), acres)
    return G.leftover_fates(rows, matched, registry, like=dice)


@query()
def page_types(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages of years; their length and number stand for titles, headers and provinces."""
    n = F.col("doc_id")
    kind = F.when(n % 7 == 0, _one_of(n % 3, "day", "boarding", "residential")).when(n % 11 == 0, "day")
    rows = table(spark, d, "documents").select((n % 10 + 1990).cast("int").alias("year"), F.floor(n / 10).cast("int").alias("page"), F.lit(0).alias("n"), kind.alias("kind"), F.when(n % 7 == 0, "title").otherwise("header").alias("strength"), F.when(n % 5 == 0, F.col("n_chars") % 9).cast("double").alias("rank"))
    return G.page_types(rows, {"day": "boarding", "boarding": "industrial"})


# ---- what texts state


@query("""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, (1990 + doc_id % 12)::INTEGER AS year, ['J.R. STEVENSON', 'THOMAS GORDON', 'A. GORDON'][(doc_id % 4 + 1)::INTEGER] AS name, ['J', 'T', 'A'][(doc_id % 4 + 1)::INTEGER] AS initial, ['STEVENSON', 'GORDON', 'GORDON'][(doc_id % 4 + 1)::INTEGER] AS surname FROM documents WHERE doc_id % 4 < 3),
    a(agent, surname, i, y) AS (VALUES ('a1', 'STEVENSON', 'J', NULL), ('a2', 'GORDON', 'T', 1991), ('a3', 'GORDON', 'T', 1992), ('a4', 'GORDON', '', 1999)),
    h AS (SELECT doc_id, list(agent ORDER BY agent) AS c FROM t JOIN a ON a.surname = t.surname AND (y IS NULL OR abs(y - year) <= 2) AND (i = '' OR i = initial) GROUP BY doc_id)
    SELECT doc_id, (length(text) + 1)::BIGINT AS char_start, name, year, CASE WHEN c IS NULL THEN 'mint' WHEN len(c) = 1 THEN 'link' ELSE 'residual' END AS fate,
        CASE WHEN c IS NULL THEN 'PERSON-' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') WHEN len(c) = 1 THEN c[1] END AS person, coalesce(array_to_string(c, '|'), '') AS candidates FROM t LEFT JOIN h USING (doc_id)
""")
def signatures_signed(spark: SparkSession, d: str) -> DataFrame:
    """Documents as letters with a signature below; who signed, among four agents."""
    n = F.col("doc_id")
    name = _one_of(n % 4, "J.R. STEVENSON", "THOMAS GORDON", "A. GORDON")
    letters = table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.coalesce(F.concat(F.lit("\n"), name, F.lit(",\nIndian Agent.\n")), F.lit(""))).alias("text"))
    found = N.signatures(letters).withColumn("year", (n % 12 + 1990).cast("int"))
    agents = spark.createDataFrame([("a1", "STEVENSON", "J", None), ("a2", "GORDON", "T", 1991), ("a3", "GORDON", "T", 1992), ("a4", "GORDON", "", 1999)], "agent string, surname string, initial string, year int")
    return N.signed(found, agents).select("doc_id", "char_start", "name", "year", "fate", "person", F.array_join("candidates", "|").alias("candidates"))


@query("""
    WITH e AS (SELECT event_id, user_id, event_type = 'click' AS lone, 'agency:AG-' || (user_id % 5)::VARCHAR AS a, 'band:BAND-' || (user_id % 3)::VARCHAR AS b, ['high', 'low', 'low'][(event_id % 3 + 1)::INTEGER] AS confidence FROM events),
    c AS (SELECT *, CASE event_id % 6 WHEN 1 THEN a WHEN 2 THEN 'band:BAND-1' WHEN 3 THEN 'reserve:R-1' WHEN 4 THEN CASE WHEN lone THEN substring(b, 6) ELSE b END ELSE 'none' END AS choice FROM e)
    SELECT event_id AS item, choice, confidence, CASE WHEN choice = 'none' THEN CASE WHEN event_id % 2 = 1 AND lone THEN 'band_not_offered' ELSE 'none' END WHEN choice <> a AND (lone OR choice <> b) THEN 'unoffered' WHEN confidence = 'low' THEN 'unverified' ELSE 'linked' END AS fate FROM c
""")
def residual_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on the mentions that events stand for: two candidates, or one where it is a click."""
    e, n, u = table(spark, d, "events"), F.col("event_id"), F.col("user_id")
    agency, band = F.concat(F.lit("AG-"), (u % 5).cast("string")), F.concat(F.lit("BAND-"), (u % 3).cast("string"))
    a, b = F.concat(F.lit("agency:"), agency), F.concat(F.lit("band:"), band)
    items = e.select(n.alias("item"), F.when(F.col("event_type") == "click", F.array(a)).otherwise(F.array(a, b)).alias("candidates"))
    choice = _one_of(n % 6, "none", agency, "band:BAND-1", "reserve:R-1", band, None)
    return N.decided(items, e.select(n.alias("item"), choice.alias("choice"), _one_of(n % 3, "high", "low", "sure").alias("confidence"), F.when(n % 2 == 1, "the band is meant").otherwise("unclear").alias("reason")))


@query("""
    WITH d AS (SELECT doc_id, text, length(text) // 2 AS a FROM documents WHERE text IS NOT NULL), s AS (SELECT *, least(a + 5, length(text)) AS b FROM d)
    SELECT doc_id, md5(trim(regexp_replace(substring(text, greatest(a - 350, 0) + 1, a - greatest(a - 350, 0)) || '[[' || substring(text, a + 1, b - a) || ']]' || substring(text, b + 1, 350), '\\s+', ' ', 'g'))) AS context FROM s
""")
def residual_contexts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    at = F.floor(F.length("text") / 2)
    spans = docs.select("doc_id", at.alias("char_start"), F.least(at + 5, F.length("text").cast("long")).alias("char_end"))
    return N.in_context(spans, docs).select("doc_id", F.md5("context").alias("context"))


@query("""
    WITH t AS (SELECT doc_id, 10 + doc_id % 50 AS school_age, doc_id % 70 AS enrolled, doc_id % 40 AS attendance, doc_id % 2 = 0 AS more, coalesce(lang, 'und') AS lang FROM documents WHERE doc_id % 3 > 0)
    SELECT doc_id, 0 AS entry, lang || ' agency' AS unit, school_age, enrolled, attendance, (CASE WHEN more THEN 1019 ELSE 0 END)::BIGINT AS elsewhere, CASE WHEN more THEN 'Elkhorn School 1012; Red Deer 7' ELSE '' END AS schools,
        enrolled <= 1.3 * school_age AND attendance <= 1.2 * enrolled AND NOT more AS plausible FROM t
    UNION ALL SELECT doc_id, 1, '', attendance + 1000, enrolled, school_age, enrolled, 'St. Mary''s ' || enrolled, school_age <= 1.2 * enrolled FROM t WHERE doc_id % 5 < 3
""")
def school_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Two stock sentences below two thirds of the documents: one under a unit, ended by its agent, and one at the end or before the rest of the text."""
    n = F.col("doc_id")
    number = lambda c: c.cast("string")
    said = F.concat(F.lit(" <b>"), F.coalesce("lang", F.lit("und")), F.lit(" agency</b>. Number of children of school age, "), number(n % 50 + 10), F.lit("; number of pupils enrolled at day schools, "), number(n % 70), F.lit("; average attendance, "), number(n % 40), F.when(n % 2 == 0, "; number attending Elkhorn School, 1,012; number attending <i>Red Deer</i>, 7.").otherwise("."))
    said = F.concat(said, F.lit(" The Indian agent counts, as number attending Nowhere, 5."))
    again = F.concat(F.lit(" NUMBER OF CHILDREN of school age 1,"), F.lpad(number(n % 40), 3, "0"), F.lit(", number of pupils enrolled "), number(n % 70), F.lit(". average attendance at day schools "), number(n % 50 + 10), F.lit("; number attending St. Mary's, "), number(n % 70))
    body = F.coalesce("text", F.lit(""))
    text = F.when(n % 3 == 0, body).when(n % 5 == 0, F.concat(said, again, F.lit(" reports on the "), body)).when(n % 5 < 3, F.concat(body, said, again)).otherwise(F.concat(body, said))
    return N.school_sentences(table(spark, d, "documents").select("doc_id", text.alias("text")))


@query("""
    SELECT p_partkey, ['', 'jr', 'sr'][p_size % 3 + 1] AS generation, p_size % 3 > 0 AND p_partkey % 3 > 0 AND p_size % 3 <> p_partkey % 3 AS conflict FROM (SELECT p_partkey, p_size FROM part)
""")
def title_conflicts(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat("p_name", _one_of(F.col("p_size") % 3, "", ", Jr.", " Senr."))
    kind = lambda c: _one_of(F.col(c) % 3, "", "f", "m")
    return table(spark, d, "part").select("p_partkey", F.coalesce(M.generation(raw), F.lit("")).alias("generation"), M.title_conflict(kind("p_size"), kind("p_partkey")).alias("conflict"))


# ---- names, numbers and units against one another


@query("SELECT p_partkey, round(greatest(least(1, jaro_winkler_similarity(a, b) + 0.02), jaro_winkler_similarity(a, d), jaro_winkler_similarity(c, b), jaro_winkler_similarity(c, d)), 6) AS score FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, lower(p_brand) AS c, lower(p_type) AS d FROM part)")
def surname_scores(spark: SparkSession, d: str) -> DataFrame:
    w = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", F.round(S.surname_score(F.array(w[0], F.lower("p_brand")), F.array(w[1], F.lower("p_type"))), 6).alias("score"))


@query("""
    WITH n AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, CASE p_size % 3 WHEN 0 THEN split_part(p_name, ' ', 1)[1:4] WHEN 1 THEN split_part(p_name, ' ', 2) ELSE split_part(p_name, ' ', 2)[1:1] END AS b FROM part)
    SELECT p_partkey, CASE WHEN length(a) >= 3 AND length(b) >= 3 AND NOT starts_with(a, b) AND NOT starts_with(b, a) THEN CASE WHEN a[1] = b[1] THEN 0.1 ELSE 0.0 END::DOUBLE END AS conflict FROM n
""")
def given_conflicts(spark: SparkSession, d: str) -> DataFrame:
    w, way = F.split("p_name", " "), F.col("p_size") % 3
    other = F.when(way == 0, F.substring(w[0], 1, 4)).when(way == 1, w[1]).otherwise(F.substring(w[1], 1, 1))
    return table(spark, d, "part").select("p_partkey", S.given_conflict(F.array(w[0]), F.array(other)).alias("conflict"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND o_custkey % 100 < 10) AS close FROM orders")
def acres_as_printed(spark: SparkSession, d: str) -> DataFrame:
    """Acres in two readings: hundredths after a space or a point, in one of three cases without its zero, in another a word."""
    whole, part = (F.col("o_custkey") + 1000).cast("string"), (F.col("o_custkey") % 100).cast("string")
    a = F.concat(F.substring(whole, 1, 1), F.lit(","), F.substr(whole, F.lit(2)), F.lit(" "), F.lpad(part, 2, "0"))
    b = F.when(F.col("o_orderkey") % 3 == 0, F.concat(whole, F.lit("."), F.lpad(part, 2, "0"))).when(F.col("o_orderkey") % 3 == 1, F.concat(whole, F.lit(".0"), part)).otherwise("unknown")
    return table(spark, d, "orders").select("o_orderkey", U.acres_close_text(a, b).alias("close"))


@query("""
    WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL), g AS (SELECT o_custkey, list(n ORDER BY y) AS v, min(n) AS a, max(n) AS b FROM y GROUP BY 1)
    SELECT o_custkey, array_to_string(list_transform(v, lambda x: '▁▂▃▄▅▆▇█'[(CASE WHEN b > a THEN (x - a) * 7 // (b - a) ELSE 0 END + 1)::INTEGER]), '') AS line FROM g
""")
def sparklines(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    g = y.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "n"))), lambda x: x["n"]).alias("v"))
    return g.select("o_custkey", U.sparkline(F.col("v")).alias("line"))


@query(f"""
    WITH r AS (SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_brand || '-' || p_size::VARCHAR ELSE '' END AS no, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS target, p_name, p_size % 5 AS score, p_partkey % 7 AS weight FROM part),
    l AS (SELECT * FROM r WHERE no <> '' AND target IS NOT NULL), n AS (SELECT DISTINCT no, p_name FROM l),
    u AS (SELECT a.no, min(round({links._DICE.format('a.p_name', 'b.p_name')}, 6)) AS k FROM n a JOIN n b ON a.no = b.no AND a.p_name < b.p_name GROUP BY 1),
    b AS (SELECT no, target AS best FROM l QUALIFY row_number() OVER (PARTITION BY no ORDER BY score DESC, weight DESC, target) = 1)
    SELECT p_partkey, CASE WHEN coalesce(k < 0.3, false) OR best IS NULL THEN target ELSE best END AS target,
        CASE WHEN coalesce(k < 0.3, false) THEN 'conflict' WHEN best IS NOT NULL AND target IS NULL THEN 'propagated' WHEN best <> target THEN 'settled' WHEN target IS NOT NULL THEN 'linked' ELSE 'unlinked' END AS fate
    FROM r LEFT JOIN u USING (no) LEFT JOIN b USING (no)
""")
def settled_by_number(spark: SparkSession, d: str) -> DataFrame:
    no = F.when(F.col("p_size") <= 25, F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string"))).otherwise("")
    rows = table(spark, d, "part").select("p_partkey", no.alias("no"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("target"), "p_name", (F.col("p_size") % 5).alias("score"), (F.col("p_partkey") % 7).alias("weight"))
    return K.settled_by_number(rows, "p_partkey", "no", "target", "p_name", "score", "weight", 0.3)


@query("""
    WITH u AS (SELECT DISTINCT o_custkey AS k, o_orderpriority || o_orderstatus AS unit, o_orderstatus <> 'F' AS chain, CASE WHEN o_orderstatus = 'P' THEN left(o_orderpriority, 1) ELSE o_orderpriority END AS name FROM orders),
    i AS (SELECT a.k, min(a.unit) AS x, count(DISTINCT a.unit) AS n FROM u a JOIN u b ON a.k = b.k AND a.unit <> b.unit AND a.chain AND b.chain AND contains(b.name, a.name) GROUP BY 1),
    g AS (SELECT k, count(*) AS n, min(unit) AS one, count(*) FILTER (chain) AS nc, min(unit) FILTER (chain) AS c FROM u GROUP BY k)
    SELECT g.k, CASE WHEN g.n = 1 THEN one WHEN nc = 1 THEN c WHEN nc > 1 AND i.n = 1 THEN x END AS unit FROM g LEFT JOIN i ON i.k = g.k
""")
def chosen_units(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.concat(p, "o_orderstatus").alias("unit"), "o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.substring(p, 1, 1)).otherwise(p).alias("name"))
    return K.chosen_unit(rows, "k", "unit", F.col("o_orderstatus") != "F", "name")


# ---- mentions, search over two fields, figures in running text

_MENTIONED = "m AS (SELECT 'doc' || conv_id::VARCHAR AS segment, role AS entity_type, 'P' || (length(text) % 50)::VARCHAR AS entity_id, ['high', 'low', 'medium'][(turn % 3 + 1)::INTEGER] AS confidence, (1990 + conv_id % 12)::INTEGER AS year FROM conversations WHERE text IS NOT NULL)"


def _mentioned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").where("text is not null").select(F.concat(F.lit("doc"), F.col("conv_id").cast("string")).alias("segment"), F.col("role").alias("entity_type"), F.concat(F.lit("P"), (F.length("text") % 50).cast("string")).alias("entity_id"), _one_of(F.col("turn") % 3, "high", "low", "medium").alias("confidence"), (F.col("conv_id") % 12 + 1990).cast("int").alias("year"))


@query(f"WITH {_MENTIONED} SELECT entity_type, entity_id, year, count(*) AS n, count(*) FILTER (confidence <> 'low') AS primary_n FROM m GROUP BY ALL")
def mentioned_by_year(spark: SparkSession, d: str) -> DataFrame:
    return H.mentioned_by_year(_mentioned(spark, d))


@query(f"""
    WITH {_MENTIONED}, c AS (SELECT entity_type, entity_id, segment, min(year) AS year, count(*) AS n FROM m WHERE confidence <> 'low' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY n DESC, year, segment)::INTEGER AS rank FROM c)
    SELECT * FROM r WHERE rank <= 3
""")
def top_segments(spark: SparkSession, d: str) -> DataFrame:
    return H.top_segments(_mentioned(spark, d), 3)


_WORDS_OF = "regexp_extract_all(strip_accents(lower(coalesce({0}, ''))), '[a-z0-9]+')"
_FIELDS = "h AS (SELECT doc_id, split_part(text, chr(10), 1) AS heading, text FROM documents)"


@query(f"""
    WITH {_FIELDS}, f AS (SELECT doc_id, 'heading' AS field, {_WORDS_OF.format('heading')} AS w FROM h UNION ALL SELECT doc_id, 'text', {_WORDS_OF.format('text')} FROM h),
    t AS (SELECT doc_id, field, unnest(w) AS term, unnest(range(len(w))) AS pos FROM f)
    SELECT term, doc_id, field, count(*) AS tf, min(pos)::INTEGER AS first, max(pos)::INTEGER AS last FROM t GROUP BY ALL
""")
def field_postings(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("heading"), "text")
    return T.field_postings(docs, ("heading", "text")).select("term", "doc_id", "field", "tf", F.array_min("positions").alias("first"), F.array_max("positions").alias("last"))


@query(f"""
    WITH {retrieval._Q}, {_FIELDS}, f AS (SELECT doc_id, 2.0::DOUBLE AS w, {_WORDS_OF.format('heading')} AS ws FROM h UNION ALL SELECT doc_id, 1.0::DOUBLE, {_WORDS_OF.format('text')} FROM h),
    s AS (SELECT doc_id, sum(len(ws)) AS length FROM f GROUP BY 1), a AS (SELECT count(*) AS n_docs, avg(length) AS mean_length FROM s), t AS (SELECT doc_id, w, unnest(ws) AS term FROM f),
    p AS (SELECT doc_id, term, sum(w) AS x FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL), c AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
    b AS (SELECT query, doc_id, round(sum(greatest(ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)), 1e-6::DOUBLE) * x * 2.2::DOUBLE / (x + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * length / mean_length))), 6) AS score FROM q JOIN c USING (term) JOIN p USING (term) JOIN s USING (doc_id) CROSS JOIN a GROUP BY query, doc_id)
    SELECT query, doc_id, score FROM b
""")
def bm25_two_fields(spark: SparkSession, d: str) -> DataFrame:
    """First lines as headings that count twice."""
    docs = table(spark, d, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("heading"), "text")
    return T.bm25_fields(docs, retrieval._asked(spark), {"heading": 2.0, "text": 1.0})


@query("""
    WITH t AS (SELECT doc_id, (50 + doc_id % 7)::BIGINT AS units, (90 + doc_id % 300)::BIGINT AS enrolled, doc_id % 2 = 0 AS attended, doc_id % 5 AS way FROM documents)
    SELECT doc_id, 'day' AS kind, units, enrolled, CASE WHEN attended THEN 1080 END::BIGINT AS attendance, CASE way WHEN 1 THEN 'retrospective' WHEN 2 THEN 'point_in_time' ELSE '' END AS note FROM t WHERE enrolled >= 100
""")
def figures_harvested(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    said = F.concat(
        F.lit("\n"), _one_of(n % 5, "At the ", "Five years ago, at the ", "On June 30, at the ", "At the ", "In all, at the "), (n % 7 + 50).cast("string"), F.lit(" day schools in operation an enrolment of "), (n % 300 + 90).cast("string"),
        F.when(n % 2 == 0, " and an average attendance of 1,080.").otherwise("."),
    )
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), said).alias("text"))
    return N.harvested(docs, [("day", r"(?i)(\d+) day schools[^.]{0,80}?enroll?ment of (\d[\d,]*)(?: and an average attendance of (\d[\d,]*))?")])


@query("""
    SELECT p_partkey, a || '|' || b || CASE WHEN p_size % 2 = 0 THEN '|' || p_type ELSE '' END || '|' || a || ', ' || b || CASE WHEN p_size % 2 = 0 THEN '|' || b || ', ' || p_type || '|' || a || ', ' || b || ', ' || p_type ELSE '' END AS candidates
    FROM (SELECT *, p_name AS a, p_brand AS b FROM part)
""")
def dateline_candidates(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit(" "), "p_name", F.lit(",  "), "p_brand", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("; "), "p_type", F.lit("."))).otherwise("."))
    return table(spark, d, "part").select("p_partkey", F.array_join(N.dateline_candidates(line), "|").alias("candidates"))
