"""Queries of segments, mentions and extraction."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as X
from quillgraph.operators import passages as P
from quillgraph.plans.registry import query, table
from quillgraph.sources import readers

_LINES = "l AS (SELECT doc_id, lang, generate_subscripts(x, 1) - 1 AS ordinal, unnest(x) AS line FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS x FROM documents))"


@query(f"""
    WITH {_LINES}, s AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM l)
    SELECT doc_id, ordinal::INTEGER AS ordinal, char_start, substring(sha1(line), 1, 12) AS version FROM s WHERE trim(line) <> ''
""")
def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    return P.lines(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ordinal", "char_start", X.text_version("line").alias("version"))


@query(f"""
    WITH {_LINES}, b AS (SELECT doc_id, ordinal, rtrim(substring(trim(regexp_replace(strip_accents(lower(line)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 30), '-') AS s FROM l WHERE trim(line) <> ''),
    i AS (SELECT doc_id, ordinal, 'p' || lpad((doc_id % 300)::VARCHAR, 4, '0') || '-' || CASE WHEN s = '' THEN 'section' ELSE s END AS base FROM b),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY ordinal) AS n FROM i)
    SELECT doc_id, ordinal::INTEGER AS ordinal, CASE WHEN n = 1 THEN base ELSE base || '-' || n::VARCHAR END AS segment_id FROM n
""")
def segment_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = P.lines(table(spark, d, "documents").select("doc_id", "text")).withColumn("page", F.col("doc_id") % 300).withColumn("heading", F.col("line"))
    return P.segment_ids(rows, "page", "heading").select("doc_id", "ordinal", "segment_id")


@query("""
    WITH w AS (SELECT doc_id, text, unnest(range(0, greatest(length(text), 1), 400)) AS s FROM documents)
    SELECT doc_id, s::INTEGER AS char_start, (s // 400)::INTEGER AS "window", length(substring(text, s + 1, 500))::INTEGER AS n, md5(substring(text, s + 1, 500)) AS digest FROM w
""")
def page_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = P.windows_of(table(spark, d, "documents").select("doc_id", "text"), 500, 100)
    return rows.select("doc_id", "char_start", "window", F.length("chunk").alias("n"), F.md5("chunk").alias("digest"))


@query(f"""
    WITH {_LINES}, k AS (SELECT doc_id, ordinal, CASE WHEN line LIKE '%!!%' THEN 'shout' WHEN line LIKE '% | %' THEN 'table' ELSE 'prose' END AS kind FROM l WHERE trim(line) <> ''),
    c AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc_id ORDER BY ordinal) THEN 1 ELSE 0 END AS new FROM k),
    g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY ordinal) AS part FROM c)
    SELECT doc_id, part::BIGINT AS part, min(kind) AS kind, count(*) AS n FROM g GROUP BY doc_id, part
""")
def sub_split(spark: SparkSession, d: str) -> DataFrame:
    line = F.col("line")
    kind = F.when(line.contains("!!"), "shout").when(line.contains(" | "), "table").otherwise("prose")
    rows = P.lines(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ordinal", kind.alias("kind"))
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    rows = rows.withColumn("new", (~F.col("kind").eqNullSafe(F.lag("kind").over(w))).cast("int")).withColumn("part", F.sum("new").over(w))
    return rows.groupBy("doc_id", "part").agg(F.min("kind").alias("kind"), F.count("*").alias("n"))


@query(f"""
    WITH {_LINES}, m AS (SELECT doc_id, ordinal, CASE WHEN length(line) < 60 THEN ordinal END AS mark FROM l WHERE trim(line) <> '')
    SELECT doc_id, ordinal::INTEGER AS ordinal, (last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ordinal))::INTEGER AS mark FROM m
""")
def last_marker(spark: SparkSession, d: str) -> DataFrame:
    rows = P.lines(table(spark, d, "documents").select("doc_id", "text")).withColumn("m", F.when(F.length("line") < 60, F.col("ordinal")))
    w = Window.partitionBy("doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("doc_id", "ordinal", F.last("m", True).over(w).alias("mark"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages")
def front_matter_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))


@query(r"""
    WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]*>', ' ', 'gs') AS x FROM pages)
    SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS digest FROM t
""")
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(X.html_to_text("html")).alias("digest"))


_GAZ = "g AS (SELECT DISTINCT lower(regexp_extract(text, '([A-Za-z]+)', 1)) AS surface, min(item_id) AS entity_id FROM benchmark GROUP BY 1 UNION ALL SELECT 'of the', 9001 UNION ALL SELECT 'to the', 9002)"
_TOK = "w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS w FROM documents)"
_RUNS = f"""{_TOK}, r AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS surface, 1 AS n_tokens FROM w UNION ALL
    SELECT doc_id, i AS pos, w[i + 1] || ' ' || w[i + 2], 2 FROM (SELECT doc_id, w, unnest(range(0, len(w) - 1)) AS i FROM w WHERE len(w) > 1))"""
_MENTIONS = f"""RECURSIVE {_GAZ}, {_RUNS}, h AS (SELECT doc_id, pos, max(n_tokens) AS n_tokens FROM r JOIN g USING (surface) GROUP BY doc_id, pos),
    o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM h),
    f(doc_id, k, pos, n_tokens, kept, until) AS (SELECT doc_id, k, pos, n_tokens, true, pos + n_tokens FROM o WHERE k = 1
        UNION ALL SELECT o.doc_id, o.k, o.pos, o.n_tokens, o.pos >= f.until, CASE WHEN o.pos >= f.until THEN o.pos + o.n_tokens ELSE f.until END FROM f JOIN o ON o.doc_id = f.doc_id AND o.k = f.k + 1),
    m AS (SELECT f.doc_id, f.pos::INTEGER AS pos, f.n_tokens::INTEGER AS n_tokens, r.surface, g.entity_id::BIGINT AS entity_id FROM f JOIN r ON r.doc_id = f.doc_id AND r.pos = f.pos AND r.n_tokens = f.n_tokens JOIN g ON g.surface = r.surface WHERE f.kept)"""


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    gaz = table(spark, d, "benchmark").groupBy(F.lower(F.regexp_extract("text", "([A-Za-z]+)", 1)).alias("surface")).agg(F.min("item_id").alias("entity_id"))
    return gaz.union(spark.createDataFrame([("of the", 9001), ("to the", 9002)], "surface string, entity_id long"))


def _mentions(spark: SparkSession, d: str, *also: str) -> DataFrame:
    gaz = surfaces(spark, d)
    return P.mentions(table(spark, d, "documents").select("doc_id", "text", *also), gaz, 2, also)


@query(f"WITH {_MENTIONS} SELECT * FROM m")
def gazetteer_ngram(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d)


@query(f"""
    WITH {_MENTIONS}, c AS (SELECT m.*, array_to_string(w.w[greatest(pos - 2, 1) : pos + n_tokens + 3], ' ') AS around FROM m JOIN w USING (doc_id))
    SELECT doc_id, pos, surface, CASE WHEN regexp_matches(around, '\\b(is|was|are)\\b') THEN 'verb' WHEN regexp_matches(around, '\\b(and|or)\\b') THEN 'list' ELSE 'none' END AS cue FROM c
""")
def cue_typing(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("doc_id", X.tokens("text").alias("w"))
    low = F.greatest(F.col("pos") - 2, F.lit(1))
    around = F.slice("w", low, F.col("pos") + F.col("n_tokens") + 3 - low + 1)
    said = lambda *cues: F.arrays_overlap(around, F.array(*map(F.lit, cues)))
    cue = F.when(said("is", "was", "are"), "verb").when(said("and", "or"), "list").otherwise("none")
    return _mentions(spark, d).join(words, "doc_id").select("doc_id", "pos", "surface", cue.alias("cue"))


@query(f"""
    WITH {_MENTIONS}, c AS (SELECT m.*, lang, n_tokens > 1 AS multi, count(*) OVER (PARTITION BY doc_id, pos) AS candidates, regexp_matches(array_to_string(w.w[greatest(pos - 2, 1) : pos + n_tokens + 3], ' '), '\\b(is|was|are)\\b') AS cue, text LIKE '% | %' AS tab FROM m JOIN w USING (doc_id) JOIN documents USING (doc_id)),
    l AS (SELECT *, CASE WHEN cue AND multi THEN 'high' WHEN NOT cue AND tab THEN 'low' ELSE 'medium' END AS level FROM c)
    SELECT doc_id, pos, surface, CASE WHEN candidates > 1 THEN 'residual' WHEN lang = 'en' THEN level WHEN level = 'medium' THEN 'low' ELSE 'medium' END AS confidence FROM l
""")
def mention_confidence(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", F.col("text").contains(" | ").alias("tab"), X.tokens("text").alias("w"))
    low = F.greatest(F.col("pos") - 2, F.lit(1))
    cue = F.array_join(F.slice("w", low, F.col("pos") + F.col("n_tokens") + 3 - low + 1), " ").rlike(r"\b(is|was|are)\b")
    found = _mentions(spark, d).withColumn("candidates", F.count("*").over(Window.partitionBy("doc_id", "pos")))
    level = P.confidence(cue, F.col("n_tokens"), F.col("candidates"), F.col("tab"), F.col("lang") == "en")
    return found.join(docs, "doc_id").select("doc_id", "pos", "surface", level.alias("confidence"))


@query("""
    WITH p AS (SELECT doc_id, text, instr(text, 'icense') - 1 AS s FROM documents WHERE text LIKE '%icense%'),
    q AS (SELECT *, greatest(s - 40, 0) AS low FROM p)
    SELECT doc_id, s::INTEGER AS char_start, CASE WHEN low > 0 THEN '…' ELSE '' END || trim(regexp_replace(substring(text, low + 1, s - low + 6 + 40), '\\s+', ' ', 'g')) || CASE WHEN s + 6 + 40 < length(text) THEN '…' ELSE '' END AS passage FROM q
""")
def passages_kwic(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where(F.col("text").contains("icense")).withColumn("s", F.instr("text", "icense") - 1)
    return rows.select("doc_id", F.col("s").alias("char_start"), P.passage(F.col("text"), F.col("s"), F.lit(6)).alias("passage"))


@query()
def span_markup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where(F.col("text").contains("icense")).select("doc_id", "text")

    @F.pandas_udf("string")
    def mark(text: pd.Series) -> pd.Series:
        return pd.Series([P.marked_up(t, [(m.start() + 1, m.end(), "w") for m in re.finditer(" the", t)]) for t in text])

    return rows.select("doc_id", mark("text").alias("marked"))


@query(r"""
    SELECT doc_id, len(regexp_extract_all(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'))::INTEGER AS addresses, coalesce(regexp_extract(text, '([0-9]+)\.[0-9]+\.[0-9]+\.[0-9]+', 1), '') AS first FROM documents
""")
def number_harvest(spark: SparkSession, d: str) -> DataFrame:
    pattern = r"([0-9]+)\.[0-9]+\.[0-9]+\.[0-9]+"
    return table(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit(pattern)).alias("addresses"), F.regexp_extract("text", pattern, 1).alias("first"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'de' AND n_chars > 500")
def scan_pruned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("lang = 'de' and n_chars > 500").select("doc_id", "lang", "source")


@query("SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events WHERE event_id % 7 <> 0")
def jsonl_rows(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(F.col("props")).alias("value"))
    return readers.json_lines(lines, "value", "k int").select("event_id", "k")


@query("SELECT doc_id, doc_id % 7 AS part, 'v' || (1990 + doc_id % 7)::VARCHAR AS tag FROM documents WHERE 1 = 0")
def optional_scan(spark: SparkSession, d: str) -> DataFrame:
    return readers.optional(spark, f"{d}/absent.parquet", "doc_id long, part long, tag string")
