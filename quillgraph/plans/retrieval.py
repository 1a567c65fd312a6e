"""Queries of search, lookup, the graph, and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators import fulltext as T
from quillgraph.operators import graph as G
from quillgraph.plans import tables as plans_tables
from quillgraph.plans.registry import query, table

#: The searches that the queries run (a fixed list).
SEARCHES = ("license version", "the answer", "für die und", "que los con", "with from this")
_TERMS = [(s, t) for s in SEARCHES for t in s.replace("ü", "u").split()]
_Q = "q(query, term) AS (VALUES " + ", ".join(f"('{s}', '{t}')" for s, t in _TERMS) + ")"
_POST = "w AS (SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+')) AS term FROM documents), p AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL)"
_BM25 = f"""{_Q}, {_POST}, s AS (SELECT doc_id, len(regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+')) AS length FROM documents), a AS (SELECT count(*) AS n_docs, avg(length) AS mean_length FROM s),
    f AS (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term),
    b AS (SELECT query, doc_id, round(sum(ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * length / mean_length))), 6) AS score
        FROM q JOIN f USING (term) JOIN p USING (term) JOIN s USING (doc_id) CROSS JOIN a GROUP BY query, doc_id)"""


def _asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_TERMS, "query string, term string")


@query(f"WITH {_POST} SELECT doc_id, term, tf FROM p")
def postings(spark: SparkSession, d: str) -> DataFrame:
    return T.postings(table(spark, d, "documents"))


@query("SELECT doc_id, len(regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+'))::INTEGER AS length FROM documents")
def doc_stats(spark: SparkSession, d: str) -> DataFrame:
    return T.doc_stats(table(spark, d, "documents"))


@query(f"WITH {_BM25}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id)::INTEGER AS rank FROM b) SELECT query, doc_id, score, rank FROM r WHERE rank <= 10")
def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    return T.ranked(T.bm25(table(spark, d, "documents"), _asked(spark)), 10)


@query(f"WITH {_BM25}, r AS (SELECT b.*, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id)::INTEGER AS rank FROM b JOIN documents USING (doc_id) WHERE lang = 'en' AND n_chars > 300) SELECT query, doc_id, score, rank FROM r WHERE rank <= 10")
def filtered_search(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    some = docs.where("lang = 'en' and n_chars > 300").select("doc_id")
    return T.ranked(T.bm25(docs, _asked(spark)).join(some, "doc_id", "left_semi").select("query", "doc_id", "score"), 10)


_NORM = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT doc_id FROM documents WHERE contains(' ' || {_NORM.format('text')} || ' ', ' under the ')")
def phrase_search(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(T.phrase(F.col("text"), "under the")).select("doc_id")


@query(f"WITH {_POST} SELECT doc_id, sum(tf)::BIGINT AS hits FROM p WHERE term LIKE 'licen%' GROUP BY doc_id")
def prefix_search(spark: SparkSession, d: str) -> DataFrame:
    return T.postings(table(spark, d, "documents")).where("term like 'licen%'").groupBy("doc_id").agg(F.sum("tf").alias("hits"))


@query(f"WITH {_POST} SELECT doc_id FROM p GROUP BY doc_id HAVING bool_or(term = 'the') AND (bool_or(term = 'license') OR bool_or(term = 'idiot')) AND NOT bool_or(term = 'gnu')")
def boolean_search(spark: SparkSession, d: str) -> DataFrame:
    has = lambda t: F.max((F.col("term") == t).cast("int"))
    g = T.postings(table(spark, d, "documents")).where(F.col("term").isin("the", "license", "idiot", "gnu")).groupBy("doc_id").agg(has("the").alias("a"), has("license").alias("b"), has("idiot").alias("c"), has("gnu").alias("x"))
    return g.where("a = 1 and (b = 1 or c = 1) and x = 0").select("doc_id")


_TRI = "CASE WHEN length({0}) < 3 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, length({0}) - 1), lambda i: substring({0}, i, 3))) END"
_ASK = ("lavender", "part 12", "xyzzy", "economy brass")
_ALIASES = "a AS (SELECT lower(p_name) AS alias, min(p_partkey) AS id, count(*) AS n FROM part GROUP BY 1)"
_TRIHITS = f"""{_ALIASES}, k(query) AS (VALUES {', '.join(f"('{x}')" for x in _ASK)} UNION ALL SELECT min(alias) FROM a UNION ALL SELECT substring(max(alias), 1, 5) FROM a),
    ag AS (SELECT alias, unnest({_TRI.format("replace(" + _NORM.format('alias') + ", ' ', '')")}) AS gram FROM a),
    kg AS (SELECT query, len(g) AS n, unnest(g) AS gram FROM (SELECT query, {_TRI.format("replace(" + _NORM.format('query') + ", ' ', '')")} AS g FROM k)),
    t AS (SELECT query, alias, round(count(*)::DOUBLE / min(n), 6) AS share FROM kg JOIN (SELECT alias, gram FROM ag) USING (gram) GROUP BY query, alias)"""


def _alias_frame(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, d, "part").groupBy(F.lower("p_name").alias("alias")).agg(F.min("p_partkey").alias("id"), F.count("*").alias("n"))
    k = spark.createDataFrame([(x,) for x in _ASK], "query string").union(a.agg(F.min("alias"))).union(a.agg(F.substring(F.max("alias"), 1, 5)))
    return a, k


@query(f"WITH {_TRIHITS} SELECT query, alias, share FROM t WHERE share >= 0.4")
def trigram_lookup(spark: SparkSession, d: str) -> DataFrame:
    a, k = _alias_frame(spark, d)
    return T.trigram_hits(a.select("alias"), k, "alias", 0.4)


@query(f"""
    WITH {_TRIHITS}, x AS (SELECT alias, id, n, {_NORM.format('alias')} AS an FROM a), y AS (SELECT query, {_NORM.format('query')} AS qn FROM k),
    c AS (SELECT query, id, n, CASE WHEN an = qn THEN 1 WHEN replace(an, ' ', '') = replace(qn, ' ', '') THEN 2 ELSE 3 END AS match FROM x JOIN y ON starts_with(an, qn)
        UNION ALL SELECT query, id, n, 2 FROM x JOIN y ON replace(an, ' ', '') = replace(qn, ' ', '')
        UNION ALL SELECT t.query, id, n, CASE WHEN contains(replace(an, ' ', ''), replace(qn, ' ', '')) THEN 4 ELSE 5 END FROM t JOIN x USING (alias) JOIN y ON y.query = t.query WHERE share >= 0.6),
    b AS (SELECT query, id, min(match) AS match, max(n) AS n FROM c GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY match, n DESC, id)::INTEGER AS rank FROM b)
    SELECT query, id, match::INTEGER AS match, n, rank FROM r WHERE rank <= 5
""")
def lookup_entity(spark: SparkSession, d: str) -> DataFrame:
    return T.lookup(*_alias_frame(spark, d), 5)


@query("SELECT ref, CASE WHEN ref LIKE 'part:%' THEN p_name ELSE NULL END AS name FROM (SELECT 'part:' || p_partkey::VARCHAR AS ref, p_name FROM part UNION ALL SELECT 'unknown:1', NULL)")
def resolve_ref(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    refs = p.selectExpr("'part:' || cast(p_partkey as string) as ref").union(spark.createDataFrame([("unknown:1",)], "ref string"))
    parts = F.split("ref", ":")
    named = refs.select("ref", F.when(parts[0] == "part", parts[1].try_cast("long")).alias("p_partkey"))
    return named.join(p, "p_partkey", "left").select("ref", F.col("p_name").alias("name"))


_E = plans_tables._EDGES
_N = "count(DISTINCT year) AS n_years, min(year) AS first_year, max(year) AS last_year"


@query(f"WITH {_E} SELECT src_type AS type, src_id AS id, edge, dst_type AS other_type, dst_id AS other_id, {_N} FROM e GROUP BY ALL")
def neighbors_out(spark: SparkSession, d: str) -> DataFrame:
    return G.neighbours(plans_tables.edges(spark, d), "out")


@query(f"WITH {_E} SELECT dst_type AS type, dst_id AS id, edge, src_type AS other_type, src_id AS other_id, {_N} FROM e GROUP BY ALL")
def neighbors_in(spark: SparkSession, d: str) -> DataFrame:
    return G.neighbours(plans_tables.edges(spark, d), "in")


@query(f"WITH {_E} SELECT src_type AS type, src_id AS id, edge, dst_type AS other_type, dst_id AS other_id, {_N} FROM e WHERE year IS NULL OR year = 1997 GROUP BY ALL")
def neighbors_year(spark: SparkSession, d: str) -> DataFrame:
    return G.neighbours(plans_tables.edges(spark, d), "out", 1997)


@query(f"WITH {_E}, x AS (SELECT src_type AS type, src_id AS id, edge, 'out' AS side FROM e UNION ALL SELECT dst_type, dst_id, edge, 'in' FROM e) SELECT type, id, edge, side, count(*) AS n FROM x GROUP BY ALL")
def node_degrees(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(plans_tables.edges(spark, d))


@query("SELECT conv_id, turn, split_part(text, chr(10), 1) AS head, length(text)::INTEGER AS n FROM conversations WHERE role = 'user'")
def document_toc(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", F.substring_index("text", "\n", 1).alias("head"), F.length("text").alias("n"))


@query(f"WITH {_POST} SELECT doc_id, string_agg(term, ',' ORDER BY term) AS terms, count(*) FILTER (tf > 1) AS sure FROM p WHERE term IN ('license', 'version', 'apache', 'mit', 'gnu') GROUP BY doc_id")
def segment_entities(spark: SparkSession, d: str) -> DataFrame:
    p = T.postings(table(spark, d, "documents")).where(F.col("term").isin("license", "version", "apache", "mit", "gnu"))
    return p.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("term")), ",").alias("terms"), F.count_if(F.col("tf") > 1).alias("sure"))


@query(f"WITH {_POST} SELECT term, count(*) AS documents, sum(tf)::BIGINT AS n FROM p GROUP BY term HAVING count(*) > 5")
def mentioned_in(spark: SparkSession, d: str) -> DataFrame:
    return T.postings(table(spark, d, "documents")).groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("n")).where("documents > 5")


@query("SELECT lang, source, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY ALL")
def facet_index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query("""
    SELECT conv_id, turn, (CASE WHEN contains(lower(text), 'the') OR contains(lower(text), 'der') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'and') OR contains(lower(text), 'und') THEN 1 ELSE 0 END)::INTEGER AS facts,
        regexp_matches(text, '[A-Z][a-z]+') AS cited FROM conversations WHERE role = 'assistant'
""")
def answer_score(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    hit = lambda *ws: F.when(F.array_contains(F.array(*[F.contains(low, F.lit(w)) for w in ws]), True), 1).otherwise(0)
    return table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", (hit("the", "der") + hit("and", "und")).alias("facts"), F.col("text").rlike("[A-Z][a-z]+").alias("cited"))


@query("SELECT count(*) AS matched, count(*) FILTER (a.lang = b.lang) AS lang_same, count(*) FILTER (a.source = b.source) AS source_same FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id < b.doc_id")
def field_agreement(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").withColumn("key", F.sha2("text", 256)).select("key", "lang", "source")
    pairs = lambda n: n * (n - 1) / 2
    whole = g.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(pairs(F.col("n"))).cast("long").alias("matched"))
    lang = g.groupBy("key", "lang").agg(F.count("*").alias("n")).agg(F.sum(pairs(F.col("n"))).cast("long").alias("lang_same"))
    source = g.groupBy("key", "source").agg(F.count("*").alias("n")).agg(F.sum(pairs(F.col("n"))).cast("long").alias("source_same"))
    return whole.crossJoin(lang).crossJoin(source)  # one row each


@query("SELECT d.lang, count(*) AS n, count(l.doc_id) AS labelled, round(count(l.doc_id)::DOUBLE / count(*), 4) AS ratio FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id", F.lit(1).alias("seen")), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.count("seen").alias("labelled"), F.round(F.count("seen") / F.count("*"), 4).alias("ratio"))
