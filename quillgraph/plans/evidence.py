"""Queries that decide by joined evidence: papers, staff, editions, patches, kinds, page windows, series with addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators import chunks, cues, editions, fulltext, hubs, identity, kinds, linking, papers, series, staff
from quillgraph.plans import texts
from quillgraph.plans.registry import query, table

# ---- papers: headings drawn by the part's own numbers, judged in SQL by what is printed

_PHRASES = (
    "Report of the Minister of Agriculture", "Trade and Navigation", "Postmaster-General", "the Geological Survey", "Indian Affairs", "Fisheries Statements", "Dominion Lands", "superannuated clerks",
    "North-West Mounted Police", "the Intercolonial", "Militia and Defence", "Penitentiaries", "unforeseen expenses", "the Canal at Lachine", "Experimental Farms", "ARCHIVES of Canada", "a bridge", "Public Accounts",
    "shareholders of the Banks", "immigration agents", "Yukon district", "Governor General's Warrants issued", "Civil Service List", "harbor commissioners", "*Adulteration* of food", "weights and measures", "supreme court",
)
_HEADS = ("", "Return to an Order of the House: ", "Copies of papers on ", "Statement of ", "Annual report of ", "Return (in part) to an Address of the Senate on ", "Message: ", "Return to a standing order: ", "Tables, ")
_SEPARATORS = (" -- ", " APPENDIX A. ", ".— ", "; presented with ", "  *and*  ", " SUPPLEMENT ")


def _listed(items: tuple[str, ...], index: str) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + f"][({index}) % {len(items)} + 1]"


_PAPERS = f"""SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN '' ELSE {_listed(_PHRASES, 'p_partkey // 3 + p_size')} END AS subject,
    {_listed(_HEADS, 'p_partkey + p_size // 2')} || {_listed(_PHRASES, 'p_partkey * 7 + p_size')} || {_listed(_SEPARATORS, 'p_size + p_partkey // 5')} || {_listed(_PHRASES, 'p_partkey // 2 + p_size * 5')} || '. ' || p_name AS title FROM part"""


def _printed_papers(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda items, index: F.element_at(F.array(*map(F.lit, items)), (F.pmod(index, F.lit(len(items))) + 1).cast("int"))
    k, size = F.col("p_partkey"), F.col("p_size")
    third, half, fifth = (F.floor(k / n) for n in (3, 2, 5))
    subject = F.when(size % 4 > 0, "").otherwise(pick(_PHRASES, third + size))
    title = F.concat(pick(_HEADS, k + F.floor(size / 2)), pick(_PHRASES, k * 7 + size), pick(_SEPARATORS, size + fifth), pick(_PHRASES, half + size * 5), F.lit(". "), "p_name")
    return table(spark, d, "part").select("p_partkey", subject.alias("subject"), title.alias("title"))


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_plain(c: str) -> str:
    return f"trim(regexp_replace(replace({c}, '*', ''), '\\s+', ' ', 'g'), ' .—-')"


def _sql_fits(c: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({c}, {_sql_text(p)}, 'i') THEN '{n}' END" for n, _, p in papers.ruled(papers.SERIES)) + "], lambda x: x IS NOT NULL)"


def _sql_kind() -> str:
    out = []
    for name, pattern in papers.ruled(papers.KINDS):
        fits = f"regexp_matches(t, {_sql_text(pattern)}, 'i')"
        out.append(f"WHEN {fits} OR regexp_matches(f, {_sql_text(pattern)}, 'i') THEN '{name}'" if name.startswith("return_to") else f"WHEN {fits} THEN '{name}'")
    return "CASE " + " ".join(out) + " ELSE 'other' END"


_RETURNED = "[" + ", ".join(f"'{r}'" for r in papers.RETURNED) + "]"


@query(f"""
    WITH p AS ({_PAPERS}), c AS (SELECT p_partkey, {_sql_plain('subject')} AS s, {_sql_plain('title')} AS t FROM p),
    w AS (SELECT *, s || ' | ' || t AS f, regexp_replace(t, {_sql_text('(' + papers.CLAUSE + ').*$')}, '', 'i') AS l FROM c),
    m AS (SELECT p_partkey, {_sql_kind()} AS kind, {_sql_fits('s')} AS a, {_sql_fits('l')} AS b, {_sql_fits('f')} AS c FROM w),
    r AS (SELECT *, CASE WHEN kind IN ('return_to_order', 'return_to_address') THEN CASE WHEN list_contains({_RETURNED}, coalesce(a[1], c[1])) THEN coalesce(a[1], c[1]) END ELSE coalesce(a[1], b[1], c[1]) END AS series FROM m)
    SELECT p_partkey, kind, series, array_to_string(list_filter(c, lambda x: x IS DISTINCT FROM series), ',') AS contains FROM r
""")
def paper_series(spark: SparkSession, d: str) -> DataFrame:
    """Parts as sessional papers: kind, series and what else each speaks of, by all rules."""
    rows = papers.classified(_printed_papers(spark, d), "subject", "title")
    return rows.select("p_partkey", "kind", "series", F.array_join("contains", ",").alias("contains"))


@query(f"""
    WITH p AS ({_PAPERS}), c AS (SELECT p_partkey, p_size, {_sql_plain('subject')} AS s, {_sql_plain('title')} AS t FROM p JOIN part USING (p_partkey)),
    w AS (SELECT *, s || ' | ' || t AS f, regexp_replace(t, {_sql_text('(' + papers.CLAUSE + ').*$')}, '', 'i') AS l FROM c),
    m AS (SELECT p_size, {_sql_kind()} AS kind, {_sql_fits('s')} AS a, {_sql_fits('l')} AS b, {_sql_fits('f')} AS c FROM w),
    r AS (SELECT *, CASE WHEN kind IN ('return_to_order', 'return_to_address') THEN CASE WHEN list_contains({_RETURNED}, coalesce(a[1], c[1])) THEN coalesce(a[1], c[1]) END ELSE coalesce(a[1], b[1], c[1]) END AS series FROM m)
    SELECT (1867 + p_size)::INTEGER AS year, series, count(*) AS n, count(*) FILTER (kind LIKE 'return%') AS returns FROM r WHERE series IS NOT NULL GROUP BY ALL
""")
def paper_series_by_year(spark: SparkSession, d: str) -> DataFrame:
    rows = papers.classified(_printed_papers(spark, d).join(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey"), "subject", "title")
    return rows.where("series is not null").groupBy((F.col("p_size") + 1867).cast("int").alias("year"), "series").agg(F.count("*").alias("n"), F.count_if(F.startswith("kind", F.lit("return"))).alias("returns"))


# ---- people

_SURNAMES = ("Keewatin", "O'Hara", "Mac Rae", "Van Dyke", "Tremblay", "Trembley", "Stonechild", "Bell", "Mostyn-Hall", "Roy")
_GIVEN = ("Agnes", "Angus", "A.", "John", "J.W.", "J.", "Mary Ann", "M.", "Wm.", "William")


def _teachers(spark: SparkSession, d: str) -> DataFrame:
    """Orders as school years: the customer is the teacher, the nation of the customer's school the province; spelled in several ways."""
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    pick = lambda items, index: F.element_at(F.array(*map(F.lit, items)), (F.pmod(index, F.lit(len(items))) + 1).cast("int"))
    who, way = F.col("o_custkey"), F.pmod(F.col("o_orderkey"), F.lit(5))
    surname, given = pick(_SURNAMES, who), pick(_GIVEN, F.floor(who / 10) + F.when(way == 4, 1).otherwise(0))
    title = F.when(F.col("o_orderstatus") == "F", pick(("Miss ", "Mrs. ", ""), way)).otherwise(pick(("Rev. ", "", "Sister "), way))
    printed = F.when(way == 1, F.concat(surname, F.lit(", "), given)).when(way == 2, F.concat(title, surname, F.lit(", "), given, F.lit(", O.M.I."))).otherwise(F.concat(title, given, F.lit(" "), surname))
    return o.select(F.concat(F.lit("S"), F.floor(who / 25).cast("string")).alias("school"), printed.alias("teacher"), (F.col("c_nationkey") % 3).cast("string").alias("p")).withColumn("province", pick(("Ontario", "North West", "NORTHWEST"), F.col("p").cast("int")))


@query()
def staff_identities(spark: SparkSession, d: str) -> DataFrame:
    """Whom the printed teachers of each school stand for."""
    return staff.staff(_teachers(spark, d), "school", "teacher", "province")


@query()
def identity_kind_rules(spark: SparkSession, d: str) -> DataFrame:
    """Printed identities of seven kinds, some of them people attested as teachers."""
    t = _teachers(spark, d).select("teacher", "school").distinct()
    known = t.where("school = 'S1'").select(F.col("teacher").alias("name"))
    way = F.pmod(F.xxhash64("teacher", "school"), F.lit(9))
    forms = ("", " Agency", ", No. 4 Band", " School", "", " District, Rev. P. Bell", ", J. Cole, Agent", " Reserve", "")
    tail = F.element_at(F.array(*map(F.lit, forms)), (way + 1).cast("int"))
    rows = t.select("school", F.concat(F.when(way == 8, "Repairs to ").otherwise(""), "teacher", tail).alias("name")).distinct()
    return kinds.identity_kinds(rows, "name", known)


# ---- editions


@query()
def edition_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders as rows of three editions against parts as the registry: numbers, names and acres drift from edition to edition."""
    p = table(spark, d, "part")
    registry = p.select(F.col("p_partkey").alias("entry"), F.col("p_brand").alias("region"), (F.col("p_partkey") % 40).cast("string").alias("no"), F.concat_ws(" ", "p_name", F.col("p_type")).alias("name"), F.lower("p_type").alias("band"), F.lit("north").alias("division"), F.col("p_retailprice").cast("double").alias("acres"))
    line = table(spark, d, "lineitem").groupBy("l_partkey", F.pmod(F.col("l_orderkey"), F.lit(3)).alias("edition")).agg(F.min("l_orderkey").alias("o"))
    way = F.pmod(F.col("o"), F.lit(7))
    rows = line.join(p.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey").select(
        (F.col("l_partkey") * 3 + F.col("edition")).alias("id"), "edition", F.col("p_brand").alias("region"), F.when(way == 1, "0").otherwise((F.col("l_partkey") % 40).cast("string")).alias("no"),
        F.concat_ws(" ", F.when(way == 2, F.reverse("p_name")).otherwise(F.col("p_name")), "p_type").alias("name"), F.when(way < 4, F.lower("p_type")).alias("band"), F.lit("north").alias("division"), F.when(way != 3, F.col("p_retailprice").cast("double")).alias("acres"),
    )
    return editions.edition_links(rows, registry)


@query("""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice::DECIMAL(18,2)::DOUBLE AS price, l_orderkey % 50 AS page FROM lineitem),
    p AS (SELECT l_orderkey % 50 + CASE WHEN l_linenumber = 2 THEN 100 ELSE 0 END AS page, l_partkey AS k, l_suppkey AS s, min(l_quantity) AS quantity FROM lineitem WHERE l_linenumber <= 2 AND l_orderkey % 4 = 0 GROUP BY ALL),
    e AS (SELECT * FROM p WHERE EXISTS (SELECT 1 FROM r WHERE r.page = p.page AND l_partkey = k AND l_suppkey = s)), x AS (SELECT * FROM p ANTI JOIN e ON e.page = p.page AND e.k = p.k AND e.s = p.s),
    one AS (SELECT l_partkey AS k, l_suppkey AS s FROM r GROUP BY ALL HAVING count(*) = 1), l AS (SELECT k, s, min(quantity) AS quantity FROM x SEMI JOIN one ON one.k = x.k AND one.s = x.s GROUP BY ALL HAVING count(*) = 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, CASE WHEN e.k IS NOT NULL THEN -e.quantity WHEN l.k IS NOT NULL THEN -l.quantity ELSE l_quantity END AS quantity, CASE WHEN e.k IS NOT NULL THEN 'exact' WHEN l.k IS NOT NULL THEN 'relaxed' END AS patch
    FROM r LEFT JOIN e ON e.page = r.page AND e.k = l_partkey AND e.s = l_suppkey LEFT JOIN l ON l.k = l_partkey AND l.s = l_suppkey
""")
def row_patches(spark: SparkSession, d: str) -> DataFrame:
    """Lines patched by page, part and supplier, or by part and supplier where one line has them; a patch turns the quantity's sign."""
    line = table(spark, d, "lineitem")
    page = F.col("l_orderkey") % 50
    rows = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("price"), page.alias("page"))
    patches = line.where("l_linenumber <= 2 and l_orderkey % 4 = 0").select((page + F.when(F.col("l_linenumber") == 2, 100).otherwise(0)).alias("page"), "l_partkey", "l_suppkey", "l_quantity").groupBy("page", "l_partkey", "l_suppkey").agg((-F.min("l_quantity")).alias("quantity"))
    return editions.patched(rows, patches, ["page", "l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"], ["quantity"]).drop("page")


# ---- ids kept over a rebuild


@query()
def rebuilt_ids(spark: SparkSession, d: str) -> DataFrame:
    """Customers in clusters of one rebuild and of the next: ids by votes of names, of one kind, in turn; new ones after the largest old."""
    c = table(spark, d, "customer")
    number = F.col("c_custkey")
    before = c.where(number % 5 > 0).select(F.col("c_name").alias("name"), F.concat(F.lit("SCH-"), F.lpad(F.floor(number / 7).cast("string"), 5, "0")).alias("old_id"), F.when(F.floor(number / 7) % 4 > 0, F.when(F.floor(number / 14) % 2 == 0, "day").otherwise("residential")).alias("kind"))
    now = c.select(F.col("c_name").alias("name"), F.floor((number + 3) / 5).alias("cluster"), F.when(F.floor((number + 3) / 5) % 3 > 0, "day").otherwise("residential").alias("kind"))
    return identity.stable_ids(before, now, "name", "old_id", "cluster", kind="kind", prefix="SCH-")


# ---- pages and series


def _volumes(spark: SparkSession, d: str) -> DataFrame:
    """Documents as volumes: a page mark before every 400 characters, from page 10 on; a table begins where a page's first word is short."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_replace("text", "<!--", "<--").alias("text"))
    # cut in one pass; a text of whole pages, or none, ends with an empty one
    pages = F.concat(F.regexp_extract_all("text", F.lit("(?s).{1,400}"), F.lit(0)), F.when(F.length("text") % 400 == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    begins = lambda p: F.length(F.regexp_extract(p, r"^\s*(\S+)", 1)) <= 2
    shaped = F.transform(pages, lambda p, i: F.concat(F.lit("<!-- page "), (i + 10).cast("string"), F.lit(" -->\n"), F.when(begins(p), "CENSUS OF INDIANS.\n").when(i % 7 == 6, "SCHOOL STATEMENT.\n").otherwise(""), p, F.lit("\n")))
    return docs.select("doc_id", F.array_join(shaped, "").alias("text"))


@query()
def table_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The longest table of each volume in windows of four pages, each with the table's head and a tail of the page before."""
    docs = _volumes(spark, d)
    spans = chunks.located(docs, r"CENSUS OF INDIANS[^\n]{0,80}\n", r"\nSCHOOL STATEMENT[^\n]{0,40}\n")
    rows = chunks.page_chunks(docs, spans, pages=4, context=300, header=200)
    return rows.select("doc_id", "n", "page_from", "page_to", "char_start", "char_end", F.length("header").alias("n_header"), F.md5("context").alias("context"), F.md5("body").alias("body"))


@query("""
    WITH RECURSIVE t AS (SELECT o_custkey AS id, CASE WHEN o_custkey % 10 IN (3, 4, 5) THEN o_custkey - 1 WHEN o_custkey % 10 = 7 THEN o_custkey + 1 WHEN o_custkey % 10 = 8 THEN o_custkey - 1 END AS target FROM (SELECT DISTINCT o_custkey FROM orders)),
    w AS (SELECT id, id AS place, 0 AS n FROM t UNION ALL SELECT w.id, t.target, n + 1 FROM w JOIN t ON t.id = w.place WHERE t.target IS NOT NULL AND n < 12),
    e AS (SELECT id, CASE WHEN max(n) >= 12 THEN id ELSE arg_max(place, n) END AS canonical FROM w GROUP BY id),
    p AS (SELECT canonical, o_custkey AS observed, o_orderpriority AS series, year(o_orderdate) AS y, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 400 END AS page, o_totalprice::DECIMAL(18,2)::DOUBLE AS value, o_orderkey FROM orders JOIN e ON id = o_custkey),
    s AS (SELECT doc_id, 's' || doc_id::VARCHAR AS segment_id, 1990 + doc_id % 12 AS y, doc_id * 7 % 400 AS a, doc_id * 7 % 400 + doc_id % 90 AS b, doc_id % 3 > 0 AS other, lang AS heading FROM documents),
    d AS (SELECT y, page, doc_id, segment_id, heading FROM (SELECT q.y, q.page, doc_id, segment_id, heading, row_number() OVER (PARTITION BY q.y, q.page ORDER BY other, b - a, doc_id, segment_id) AS n FROM (SELECT DISTINCT y, page FROM p WHERE page IS NOT NULL) q JOIN s ON s.y = q.y AND q.page BETWEEN a AND b) WHERE n = 1)
    SELECT o_orderkey, canonical, observed, series, p.y::INTEGER AS year, p.page, value, coalesce(doc_id::VARCHAR || ' / ' || segment_id, '') AS address, heading FROM p LEFT JOIN d ON d.y = p.y AND d.page = p.page
""")
def series_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Orders as points of customers, some of which were merged into others by one to three steps, each with the segment that prints it."""
    o = table(spark, d, "orders")
    k = F.col("id") % 10
    target = F.when(k.isin(3, 4, 5), F.col("id") - 1).when(k == 7, F.col("id") + 1).when(k == 8, F.col("id") - 1)
    redirects = o.select(F.col("o_custkey").alias("id")).distinct().withColumn("target", target).where("target is not null")
    points = o.select("o_orderkey", F.col("o_custkey").alias("observed"), F.col("o_orderpriority").alias("series"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderkey") % 400).alias("page"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("value"))
    n = F.col("doc_id")
    segments = table(spark, d, "documents").select("doc_id", F.concat(F.lit("s"), n.cast("string")).alias("segment_id"), (n % 12 + 1990).cast("int").alias("report_year"), (n * 7 % 400).alias("page_start"), (n * 7 % 400 + n % 90).alias("page_end"), F.when(n % 3 == 0, "tabular_statement").otherwise("letter").alias("kind"), F.col("lang").alias("heading"))
    rows = series.addressed(series.canonical_points(points, redirects, "observed"), segments)
    return rows.select("o_orderkey", "canonical", "observed", "series", "year", "page", "value", F.coalesce("address", F.lit("")).alias("address"), "heading")


# ---- lookup by stages

_FOLDED = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
    WITH raw AS (SELECT p_name || ' ' || p_brand AS alias, 'band' AS type, p_partkey % 97 AS id, p_size AS n FROM part UNION ALL SELECT p_type || ' ' || p_name, 'agency', p_partkey % 31, 1 FROM part),
    e AS (SELECT DISTINCT type, id, id % 7 AS m, id % 3 AS y FROM raw WHERE id % 13 > 0),
    a AS (SELECT {_FOLDED.format('alias')} AS a, type, id, sum(n)::BIGINT AS n FROM raw SEMI JOIN e USING (type, id) GROUP BY ALL),
    k AS (SELECT DISTINCT {_FOLDED.format('query')} AS q, query FROM (SELECT p_name AS query FROM part WHERE p_partkey % 5 = 0 UNION SELECT split_part(p_name, ' ', 2) || ' ' || lower(p_type) FROM part WHERE p_size < 10 UNION SELECT p_brand FROM part WHERE p_size > 45 UNION SELECT p_name[2:9] || 'q' FROM part WHERE p_size = 7 UNION SELECT p_name[1:2] FROM part UNION SELECT '!' )),
    h AS (SELECT query, a, type, id, n, unnest(CASE WHEN a = q THEN [3, 2, 1.5] WHEN starts_with(a, q) THEN [2, 1.5] ELSE [1.5] END)::DOUBLE AS base FROM k JOIN a ON contains(a, q) WHERE q <> ''),
    s AS (SELECT query, base, type, id, sum(n) AS n, list_sort(list(DISTINCT a)) AS matched FROM h GROUP BY query, base, type, id QUALIFY row_number() OVER (PARTITION BY query, base ORDER BY sum(n) DESC, type, id) <= 200),
    k2 AS (SELECT * FROM k WHERE q <> '' AND query NOT IN (SELECT query FROM s GROUP BY 1 HAVING count(DISTINCT (type, id)) >= 10)),
    w AS (SELECT query, list_distinct(list_filter(string_split(q, ' '), lambda x: length(x) > 2)) AS w FROM k2),
    s2 AS (SELECT query, 1.0::DOUBLE AS base, type, id, sum(n) AS n, list_sort(list(DISTINCT a)) AS matched FROM w JOIN a ON len(w) > 0 AND len(list_filter(w, lambda x: contains(a, x))) = len(w) GROUP BY query, type, id QUALIFY row_number() OVER (PARTITION BY query ORDER BY sum(n) DESC, type, id) <= 200),
    t AS (SELECT * FROM s UNION ALL SELECT * FROM s2),
    k3 AS (SELECT query, replace(q, ' ', '') AS qs FROM k WHERE q <> '' AND query NOT IN (SELECT query FROM t GROUP BY 1 HAVING count(DISTINCT (type, id)) >= 10)),
    c AS (SELECT query, list_distinct(CASE WHEN length(qs) < 6 THEN [qs] ELSE list_transform(range(1, length(qs) - 3, 2), lambda i: substring(qs, i, 5)) END) AS pieces FROM k3 WHERE length(qs) >= 3),
    p AS (SELECT query, a, type, id, n, len(list_filter(pieces, lambda x: contains(replace(a, ' ', ''), x))) AS hit FROM c JOIN a ON len(list_filter(pieces, lambda x: contains(replace(a, ' ', ''), x))) > 0 QUALIFY row_number() OVER (PARTITION BY query ORDER BY hit DESC, n DESC, a, type, id) <= 40),
    u AS (SELECT * FROM t UNION ALL SELECT query, 0.5, type, id, n, [a] FROM p),
    g AS (SELECT query, type, id, max(base + least(n, 50) / 100) AS score, list_sort(list_distinct(flatten(list(matched))))[1:5] AS matched FROM u GROUP BY ALL)
    SELECT query, row_number() OVER (PARTITION BY query ORDER BY round(score, 1) DESC, m DESC, y DESC, type, id)::INTEGER AS rank, type, id, round(score, 2) AS score, array_to_string(matched, ',') AS matched FROM g JOIN e USING (type, id)
    QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(score, 1) DESC, m DESC, y DESC, type, id) <= 10
""")
def staged_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Parts' names as aliases of bands and agencies; whole, turned, cut and misread names as queries."""
    p = table(spark, d, "part")
    aliases = p.select(F.concat_ws(" ", "p_name", "p_brand").alias("alias"), F.lit("band").alias("type"), (F.col("p_partkey") % 97).alias("id"), F.col("p_size").cast("long").alias("n"))
    aliases = aliases.union(p.select(F.concat_ws(" ", "p_type", "p_name"), F.lit("agency"), F.col("p_partkey") % 31, F.lit(1).cast("long")))
    entities = aliases.select("type", "id").distinct().where("id % 13 > 0").withColumn("n_mentions", F.col("id") % 7).withColumn("n_years", F.col("id") % 3)
    noun = F.split("p_name", " ")[1]
    asked = p.where("p_partkey % 5 = 0").select(F.col("p_name").alias("query")).union(p.where("p_size < 10").select(F.concat_ws(" ", noun, F.lower("p_type")))).union(p.where("p_size > 45").select("p_brand"))
    asked = asked.union(p.where("p_size = 7").select(F.concat(F.substring("p_name", 2, 8), F.lit("q")))).union(p.select(F.substring("p_name", 1, 2))).union(spark.createDataFrame([("!",)], "query string"))
    rows = fulltext.staged_lookup(aliases, asked, entities)
    return rows.withColumn("matched", F.array_join("matched", ","))


# ---- mentions by cues

_TYPES = ("agency", "reserve", "band")
_CUE_WORDS = (("is|was|isn", "agency"), ("and|or", "reserve"), (r"are|no\.", "band"))


@query(rf"""
    WITH {texts._MENTIONS}, n AS (SELECT g.surface, x.t AS type, (g.entity_id % 11 + x.k)::VARCHAR AS id, CASE WHEN (g.entity_id + x.k) % 3 = 0 THEN 'src' || (g.entity_id % 4)::VARCHAR END AS context, CASE WHEN (g.entity_id + x.k) % 4 > 0 THEN ['en', 'fr', 'de'][(g.entity_id % 3 + 1)::INTEGER] END AS region
            FROM g, (VALUES (0, 'agency'), (1, 'reserve'), (2, 'band')) AS x(k, t) WHERE (g.entity_id + x.k) % 5 > 0),
    s AS (SELECT DISTINCT doc_id, pos, n_tokens, surface FROM m),
    t AS (SELECT doc_id, strip_accents(lower(text)) AS t, CASE WHEN doc_id % 3 = 0 THEN 'agency_letter' WHEN doc_id % 3 = 1 THEN 'return' END AS kind, CASE WHEN doc_id % 4 > 0 THEN lang END AS region, source AS agency FROM documents),
    p AS (SELECT s.*, t, kind, region, agency, regexp_split_to_array(t, '[a-z0-9]+') AS gp, regexp_extract_all(t, '[a-z0-9]+') AS w FROM s JOIN t USING (doc_id)),
    q AS (SELECT *, length(array_to_string(gp[1:pos + 1], '')) + length(array_to_string(w[1:pos], '')) AS a, length(array_to_string(gp[1:pos + n_tokens], '')) + length(array_to_string(w[1:pos + n_tokens], '')) AS b FROM p),
    c AS (SELECT *, ' ' || substring(t, greatest(a - CASE WHEN n_tokens = 1 THEN 12 ELSE 40 END, 0) + 1, b - greatest(a - CASE WHEN n_tokens = 1 THEN 12 ELSE 40 END, 0) + CASE WHEN n_tokens = 1 THEN 25 ELSE 40 END) AS around FROM q WHERE (a = 0 OR t[a] <> '-') AND t[b + 1] IS DISTINCT FROM '-'),
    u AS (SELECT *, regexp_extract(around, '[^a-z0-9_](is|was|isn|and|or|are|no\.)(?:[^a-z0-9_]|$)', 1) AS cue FROM c),
    v AS (SELECT u.*, list_sort(list(DISTINCT {{'type': n.type, 'id': n.id, 'context': n.context, 'region': n.region}})) AS c FROM u JOIN n USING (surface) WHERE n_tokens > 1 OR cue <> '' GROUP BY ALL),
    nr AS (SELECT *, list_filter(c, lambda x: x.type = 'agency' OR x.region IS NULL OR x.region = region) AS near FROM v),
    i AS (SELECT *, region IS NOT NULL AND len(near) = 0 AS odd, region IS NOT NULL AND len(near) = 0 AND kind IS NOT DISTINCT FROM 'agency_letter' AS open, CASE WHEN region IS NULL OR len(near) = 0 THEN c ELSE near END AS c1, CASE WHEN cue IN ('is', 'was', 'isn') THEN 'agency' WHEN cue IN ('and', 'or') THEN 'reserve' WHEN cue <> '' THEN 'band' END AS wanted FROM nr),
    j AS (SELECT *, CASE WHEN open OR wanted IS NULL OR len(list_filter(c1, lambda x: x.type = wanted)) = 0 THEN c1 ELSE list_filter(c1, lambda x: x.type = wanted) END AS c2 FROM i),
    k AS (SELECT *, list_sort(list_distinct(list_transform(CASE WHEN open OR agency IS NULL OR len(c2) < 2 OR len(list_filter(c2, lambda x: coalesce(x.context = agency, false))) = 0 THEN c2 ELSE list_filter(c2, lambda x: coalesce(x.context = agency, false)) END, lambda x: {{'type': x.type, 'id': x.id}}))) AS c3 FROM j),
    l AS (SELECT *, len(c3) = 1 AND NOT open AS one, c3[1].type AS ty, CASE WHEN cue <> '' AND n_tokens > 1 THEN 'high' WHEN cue = '' AND kind IS NOT DISTINCT FROM 'return' THEN 'low' ELSE 'medium' END AS l1 FROM k)
    SELECT doc_id, a::INTEGER AS char_start, b::INTEGER AS char_end, surface, CASE WHEN one THEN ty END AS entity_type, CASE WHEN one THEN c3[1].id END AS entity_id,
        CASE WHEN NOT one THEN 'residual' WHEN odd AND ty <> 'agency' THEN 'low' WHEN region IS NULL AND ty <> 'agency' THEN CASE WHEN l1 = 'medium' THEN 'low' ELSE 'medium' END ELSE l1 END AS confidence,
        array_to_string(list_transform(c3, lambda x: x.type || ':' || x.id), '|') AS candidates, CASE WHEN odd AND (open OR ty <> 'agency') THEN 'region mismatch: ' || region ELSE '' END AS note FROM l
""")
def cued_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of the gazetteer in whole documents, typed by the words around them, the documents' languages as regions and sources as agencies."""
    docs = table(spark, d, "documents")
    n = F.col("doc_id")
    segments = docs.select("doc_id", "text", F.when(n % 3 == 0, "agency_letter").when(n % 3 == 1, "return").alias("kind"), F.when(n % 4 > 0, F.col("lang")).alias("region"), F.col("source").alias("agency"))
    surfaces = texts.surfaces(spark, d)
    e, k = F.col("entity_id"), F.col("k")
    region = F.element_at(F.array(*map(F.lit, ("en", "fr", "de"))), (e % 3 + 1).cast("int"))
    names = surfaces.select("surface", "entity_id", F.posexplode(F.array(*map(F.lit, _TYPES))).alias("k", "type")).where((e + k) % 5 > 0)
    names = names.select("surface", "type", (e % 11 + k).alias("id"), F.when((e + k) % 3 == 0, F.concat(F.lit("src"), (e % 4).cast("string"))).alias("context"), F.when((e + k) % 4 > 0, region).alias("region")).withColumnRenamed("id", "entity_id")
    return cues.decided_mentions(segments, texts._mentions(spark, d).select("doc_id", "pos", "n_tokens", "surface").distinct(), names, _CUE_WORDS)


# ---- names that may be one


@query("""
    WITH y AS (SELECT o_custkey AS id, year(o_orderdate) AS year, count(*) AS value FROM orders GROUP BY ALL), s AS (SELECT id, min(year) AS first, max(year) AS last FROM y GROUP BY id),
    m AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN 'Recapitulation of ' || c_name ELSE c_name END AS name, CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN lower(c_mktsegment) || ' north' ELSE lower(c_mktsegment) END AS agency, first, last FROM customer JOIN s ON id = c_custkey),
    p AS (SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND b.c_custkey > a.c_custkey AND b.c_custkey <= a.c_custkey + 40),
    f AS (SELECT p.a, p.b, bool_or(abs(v.value - w.value) >= 1) AS differ FROM p JOIN m x ON x.id = p.a JOIN m z ON z.id = p.b JOIN y v ON v.id = p.a JOIN y w ON w.id = p.b AND w.year = v.year AND v.year BETWEEN greatest(x.first, z.first) AND least(x.last, z.last) GROUP BY ALL),
    r AS (SELECT p.a, p.b, regexp_matches(x.name, '^Recap') OR regexp_matches(z.name, '^Recap') AS line, x.agency <> '' AND z.agency <> '' AND NOT contains(x.agency, z.agency) AND NOT contains(z.agency, x.agency) AS other, differ FROM p JOIN m x ON x.id = p.a JOIN m z ON z.id = p.b LEFT JOIN f ON f.a = p.a AND f.b = p.b)
    SELECT a, b, NOT line AND NOT other AND NOT coalesce(differ, false) AS compatible, CASE WHEN line THEN 'province/recap line' WHEN other THEN 'different agencies' WHEN differ THEN 'population differs in a shared year' WHEN differ IS NOT NULL THEN 'identical population in shared years' ELSE 'no conflicting population' END AS note FROM r
""")
def overlap_tests(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a nation with near numbers as identities of one name; their orders of a year are the figures."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    figures = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("value"))
    spans = figures.groupBy("id").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    agency = F.when(k % 6 == 0, "").when(k % 6 == 1, F.concat(F.lower("c_mktsegment"), F.lit(" north"))).otherwise(F.lower("c_mktsegment"))
    members = c.select(k.alias("id"), F.when(k % 17 == 0, F.concat(F.lit("Recapitulation of "), "c_name")).otherwise(F.col("c_name")).alias("name"), agency.alias("agency")).join(spans, "id")
    a, b = (c.select("c_nationkey", k.alias(x), F.explode(F.array(*[F.floor(k / 40) + i for i in steps])).alias("_block")) for x, steps in (("a", (0, 1)), ("b", (0,))))
    pairs = a.join(b, ["c_nationkey", "_block"]).where("b > a and b <= a + 40").select("a", "b")
    return linking.compatible_overlaps(pairs, members, figures)


@query("""
    WITH l AS (SELECT doc_id, lang, source, text, n_chars, doc_id // 2 AS k FROM documents), p AS (SELECT a.lang AS a1, b.lang AS b1, a.source AS a2, b.source AS b2, trim(regexp_replace(lower(strip_accents(coalesce(a.text, '')[1:60])), '[^a-z0-9]+', ' ', 'g')) AS a3, trim(regexp_replace(lower(strip_accents(coalesce(b.text, '')[1:60])), '[^a-z0-9]+', ' ', 'g')) AS b3, a.n_chars AS a4, b.n_chars AS b4 FROM l a JOIN l b ON a.k = b.k AND a.doc_id < b.doc_id),
    j AS (SELECT *, list_filter(string_split(a3, ' '), lambda x: x <> '') AS x, list_filter(string_split(b3, ' '), lambda x: x <> '') AS y FROM p)
    SELECT 'lang' AS field, count(*) AS n, count(*) FILTER (a1 = b1) AS equal, count(*) FILTER (a1 = b1) AS near FROM p UNION ALL SELECT 'source', count(*), count(*) FILTER (a2 = b2), count(*) FILTER (a2 = b2) FROM p
    UNION ALL SELECT 'head', count(*), count(*) FILTER (a3 = b3), count(*) FILTER (a3 = b3 OR (len(x) + len(y) > 0 AND len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))) >= 0.9)) FROM j
    UNION ALL SELECT 'n_chars', count(*), count(*) FILTER (a4 = b4), count(*) FILTER (a4 = b4) FROM p
""")
def field_agreement_near(spark: SparkSession, d: str) -> DataFrame:
    """Documents of neighbouring numbers as two extractions of one record: which fields agree, exactly and nearly."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source", F.substring(F.coalesce("text", F.lit("")), 1, 60).alias("head"), "n_chars")
    key = docs.select("id", F.floor(F.col("id") / 2).alias("k"))
    pairs = key.select(F.col("id").alias("left_id"), "k").join(key.select(F.col("id").alias("right_id"), "k"), "k").where("left_id < right_id")
    return linking.field_agreements(pairs, docs, docs, ["lang", "source", "head"], ["n_chars"])


# ---- pages of entities

_CONFIDENCE = ("high", "low", "medium")


def _hub_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    year, who = F.year("o_orderdate"), F.col("o_custkey")
    kind = F.lit("customer")
    level = F.element_at(F.array(*map(F.lit, _CONFIDENCE)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return {
        "entities": c.where("c_custkey % 4 > 0").select(kind.alias("type"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("summary")),
        "aliases": o.select(F.concat(F.lit("name "), (F.col("o_orderkey") % 40).cast("string")).alias("alias"), kind.alias("type"), who.alias("id"), F.lit(1).alias("n")),
        "edges": o.select(kind.alias("src_type"), who.alias("src_id"), F.col("o_orderstatus").alias("edge"), kind.alias("dst_type"), ((who * 7 + F.col("o_orderkey") % 5) % 50).alias("dst_id"), F.when(F.col("o_orderkey") % 6 > 0, year).alias("year")),
        "observations": o.select(kind.alias("entity_type"), who.alias("entity_id"), F.col("o_orderpriority").alias("series_id"), year.alias("year")),
        "mentions": o.select((F.col("o_orderkey") % 30).cast("string").alias("doc_id"), F.concat(F.lit("s"), (F.col("o_orderkey") % 3).cast("string")).alias("segment_id"), year.alias("report_year"), kind.alias("entity_type"), who.alias("entity_id"), level.alias("confidence")),
    }


@query("""
    WITH e AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 4 > 0), x AS (SELECT *, year(o_orderdate) AS y, 'customer:' || ((o_custkey * 7 + o_orderkey % 5) % 50)::VARCHAR AS target FROM orders),
    a AS (SELECT o_custkey AS id, 'names' AS section, 'name ' || (o_orderkey % 40)::VARCHAR AS item, count(*) AS n, '' AS k, '' AS years, 0 AS y FROM x GROUP BY ALL),
    b AS (SELECT o_custkey AS id, 'relations' AS section, o_orderstatus || ' ' || target AS item, count(DISTINCT CASE WHEN o_orderkey % 6 > 0 THEN y END) AS n, o_orderstatus AS k, list_sort(list(DISTINCT CASE WHEN o_orderkey % 6 > 0 THEN y END) FILTER (o_orderkey % 6 > 0)) AS ys FROM x GROUP BY ALL),
    c AS (SELECT (o_custkey * 7 + o_orderkey % 5) % 50 AS id, 'referenced' AS section, o_orderstatus || ' customer:' || o_custkey::VARCHAR AS item, count(DISTINCT CASE WHEN o_orderkey % 6 > 0 THEN y END) AS n, o_orderstatus AS k, list_sort(list(DISTINCT CASE WHEN o_orderkey % 6 > 0 THEN y END) FILTER (o_orderkey % 6 > 0)) AS ys FROM x GROUP BY ALL),
    r AS (SELECT id, section, item, n, k, unnest(ys) AS y FROM (SELECT * FROM b UNION ALL SELECT * FROM c)),
    g AS (SELECT *, y - row_number() OVER (PARTITION BY id, section, item ORDER BY y) AS island FROM r), i AS (SELECT id, section, item, min(y) AS lo, max(y) AS hi FROM g GROUP BY id, section, item, island),
    t AS (SELECT id, section, item, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo::VARCHAR || '–' || hi::VARCHAR END, ', ' ORDER BY lo) AS years FROM i GROUP BY ALL),
    bc AS (SELECT u.id, u.section, u.item, u.n, u.k, coalesce(t.years, '') AS years, 0 AS y FROM (SELECT * FROM b UNION ALL SELECT * FROM c) u LEFT JOIN t USING (id, section, item)),
    s AS (SELECT o_custkey AS id, 'series' AS section, o_orderpriority AS item, count(*) AS n, '' AS k, min(y)::VARCHAR || '–' || max(y)::VARCHAR AS years, 0 AS y FROM x GROUP BY ALL),
    m AS (SELECT * FROM x WHERE o_orderkey % 3 <> 1), v AS (SELECT o_custkey AS id, 'years' AS section, y::VARCHAR AS item, count(*) AS n, '' AS k, '' AS years, 0 AS z FROM m GROUP BY o_custkey, y),
    w AS (SELECT o_custkey AS id, 'segments' AS section, (o_orderkey % 30)::VARCHAR || ' / s' || (o_orderkey % 3)::VARCHAR AS item, count(*) AS n, '' AS k, min(y)::VARCHAR AS years, min(y) AS y FROM m GROUP BY o_custkey, o_orderkey % 30, o_orderkey % 3),
    z AS (SELECT * FROM a UNION ALL SELECT * FROM bc UNION ALL SELECT * FROM s UNION ALL SELECT * FROM v UNION ALL SELECT * FROM w),
    q AS (SELECT 'customer' AS type, id, section, row_number() OVER (PARTITION BY id, section ORDER BY k, CASE WHEN section IN ('series', 'years') THEN 0 ELSE -n END, y, item)::INTEGER AS rank, item, n, years FROM z SEMI JOIN e USING (id))
    SELECT * FROM q WHERE rank <= CASE section WHEN 'names' THEN 25 WHEN 'segments' THEN 15 WHEN 'relations' THEN 200 WHEN 'referenced' THEN 200 ELSE 1000 END
""")
def entity_pages(spark: SparkSession, d: str) -> DataFrame:
    """The page of every customer: names, relations both ways, series and mentions, from their orders."""
    return hubs.hub_sections(**_hub_tables(spark, d))


@query()
def entity_page_texts(spark: SparkSession, d: str) -> DataFrame:
    tables = _hub_tables(spark, d)
    return hubs.hub_texts(tables["entities"], hubs.hub_sections(**tables))
