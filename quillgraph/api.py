"""The seven read-only tools over the tables of a built graph; errors are rows, never exceptions.

Every tool takes plain values and returns a DataFrame.  Tables (missing ones
count as empty): ``entities`` type, id, name, uri, n_years, n_mentions, summary;
``redirects`` id, target; ``aliases`` alias, type, id, n; ``documents`` doc_id,
tag, report_year, title; ``segments`` doc_id, segment_id, ordinal, report_year,
heading, kind, agency_id, school_id, page_start, page_end, text; ``mentions``
doc_id, segment_id, report_year, entity_type, entity_id, surface, confidence;
``edges`` src_type, src_id, edge, dst_type, dst_id, year; ``observations``
entity_type, entity_id, series_id, year, value, unit, page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions.numbers import year_ranges
from quillgraph.functions.text import norm
from quillgraph.operators import querylang as Q
from quillgraph.operators.fulltext import staged_lookup
from quillgraph.operators.series import addressed, canonical_points

SCHEMAS = {
    "entities": "type string, id string, name string, uri string, n_years long, n_mentions long, summary string",
    "redirects": "id string, target string",
    "aliases": "alias string, type string, id string, n long",
    "documents": "doc_id string, tag string, report_year int, title string",
    "segments": "doc_id string, segment_id string, ordinal int, report_year int, heading string, kind string, agency_id string, school_id string, page_start int, page_end int, text string",
    "mentions": "doc_id string, segment_id string, report_year int, entity_type string, entity_id string, surface string, confidence string",
    "edges": "src_type string, src_id string, edge string, dst_type string, dst_id string, year int",
    "observations": "entity_type string, entity_id string, series_id string, year int, value double, unit string, page int",
}
#: Weights of the heading and the text in a hit; the ranking's constants; the words of a snippet.
HEADING_WEIGHT, TEXT_WEIGHT, K1, B, SNIPPET = 2.0, 1.0, 1.2, 0.75, 28
PRIMARY = ("high", "medium")


class Archive:
    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark = spark
        for name, schema in SCHEMAS.items():
            setattr(self, name, tables.get(name) if tables.get(name) is not None else spark.createDataFrame([], schema))

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Archive:
        """The tables of a folder of Parquet files."""
        from quillgraph.sources.readers import optional

        return cls(spark, **{n: optional(spark, f"{folder}/{n}.parquet", s) for n, s in SCHEMAS.items()})

    def _error(self, message: str) -> DataFrame:
        return self.spark.createDataFrame([(message,)], "error string")

    def resolve(self, ref: str, type: str | None = None) -> DataFrame:
        """``type, id`` of a reference, at most one row: type:id, uri, bare id, or the best attested exact alias."""
        kind, _, rest = ref.partition(":")
        kind = "person" if kind == "agent" else kind
        e = self.entities if type is None else self.entities.where(F.col("type") == type)
        direct = e.where(((F.col("type") == kind) & (F.col("id") == rest)) | (F.col("uri") == ref) | (F.col("id") == ref))
        direct = direct.select("type", "id", F.when((F.col("type") == kind) & (F.col("id") == rest), 0).when(F.col("uri") == ref, 1).otherwise(2).alias("prio"), F.lit(0).cast("long").alias("n"))
        named = self.aliases.where(norm("alias") == norm(F.lit(ref)))
        if type is not None:
            named = named.where(F.col("type") == type)
        named = named.groupBy("type", "id").agg(F.sum("n").alias("n")).select("type", "id", F.lit(3).alias("prio"), "n")
        best = direct.union(named).orderBy("prio", F.desc("n"), "type", "id").limit(1)
        moved = best.join(self.redirects.withColumnRenamed("target", "_to"), "id", "left")
        return moved.select("type", F.coalesce("_to", "id").alias("id"))

    def lookup_entity(self, name: str, type: str | None = None, limit: int = 10) -> DataFrame:
        """Ranked candidates: exact alias 3, prefix 2, part 1.5, all words 1, five-letter pieces 0.5, and attestation to break ties.

        The last two classes count only where the others give fewer than ``limit``.
        """
        if not Q.folded(name):
            return self._error("empty name")
        type = "person" if type == "agent" else type
        a = self.aliases if type is None else self.aliases.where(F.col("type") == type)
        best = staged_lookup(a, self.spark.createDataFrame([(name,)], "query string"), self.entities, limit).drop("query")
        rows = best.join(self.entities, ["type", "id"])
        return rows.select("type", "id", "name", "uri", "n_years", "n_mentions", "summary", "score", "matched", "rank").orderBy("rank").drop("rank")

    def search(self, query: str, year_from: int | None = None, year_to: int | None = None, kind: str | None = None, agency: str | None = None, school: str | None = None, limit: int = 10) -> DataFrame:
        """Segments that the query fits, best first, with an address and a snippet; heading words count twice.

        Each phrase's document count and the mean length come from one pass of
        counts; the ranking is a second pass over the rows that fit.
        """
        tree = Q.parsed(query)
        if tree is None:
            return self._error("empty query")
        phrases = Q.leaves(tree)
        s = self.segments.withColumn("_h", norm(F.coalesce("heading", F.lit("")))).withColumn("_t", norm(F.coalesce("text", F.lit(""))))
        size = lambda c: F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, " ")))
        s = s.withColumn("_n", size("_h") + size("_t"))
        for i, leaf in enumerate(phrases):
            s = s.withColumn(f"_f{i}", HEADING_WEIGHT * Q.occurrences(F.col("_h"), leaf) + TEXT_WEIGHT * Q.occurrences(F.col("_t"), leaf))
        counts = s.agg(F.count("*").alias("n"), F.avg("_n").alias("mean"), *[F.count_if(F.col(f"_f{i}") > 0).alias(f"d{i}") for i in range(len(phrases))]).first()
        score: Column = F.lit(0.0)
        for i in range(len(phrases)):
            idf = F.greatest(F.log(F.lit((counts.n - counts[f"d{i}"] + 0.5) / (counts[f"d{i}"] + 0.5))), F.lit(1e-6))
            score = score + idf * F.col(f"_f{i}") * (K1 + 1) / (F.col(f"_f{i}") + K1 * (1 - B + B * F.col("_n") / F.lit(float(counts["mean"] or 1))))
        rows = s.where(Q.matches(tree, F.concat_ws(" | ", "_h", "_t")))
        for name, value in (("agency_id", agency and self._id(agency, "agency")), ("school_id", school and self._id(school, "school")), ("kind", kind)):
            rows = rows.where(F.col(name) == value) if value else rows
        rows = rows.where(F.col("report_year") >= year_from) if year_from else rows
        rows = rows.where(F.col("report_year") <= year_to) if year_to else rows
        address = F.concat_ws(" / ", "doc_id", "segment_id")
        out = rows.select("doc_id", "segment_id", "report_year", "heading", "kind", "agency_id", "school_id", "page_start", address.alias("address"), score.alias("score"), self._snippet(phrases).alias("snippet"))
        return out.orderBy(F.desc("score"), "doc_id", "segment_id").limit(limit).withColumn("score", F.round("score", 6))

    def _id(self, ref: str, type: str) -> str:
        found = self.resolve(ref, type).first()
        return found.id if found else ref

    @staticmethod
    def _snippet(phrases: list[Q.Leaf]) -> Column:
        """Words of the text from a little before the first hit, hits marked."""
        words = F.split(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), " ")
        wanted = [(w, star and k == len(ws) - 1) for _, p, star in phrases for ws in [p.split()] for k, w in enumerate(ws)]

        def hit(w: Column) -> Column:
            key = norm(w)
            out: Column = F.lit(False)
            for word, star in wanted:
                out = out | (key.startswith(word) if star else key == word)
            return out

        places = F.filter(F.transform(words, lambda w, i: F.when(hit(w), i)), lambda x: x.isNotNull())
        start = F.greatest(F.coalesce(F.get(places, F.lit(0)), F.lit(0)) - 5, F.lit(0))
        part = F.transform(F.slice(words, start + 1, F.lit(SNIPPET)), lambda w: F.when(hit(w), F.concat(F.lit("«"), w, F.lit("»"))).otherwise(w))
        return F.concat(F.when(start > 0, "…").otherwise(""), F.array_join(part, " "), F.when(F.size(words) > start + SNIPPET, "…").otherwise(""))

    def neighbors(self, ref: str, edge_type: str | None = None, year: int | None = None, limit: int = 50) -> DataFrame:
        """Edges out of and into an entity, one row for each kind and other end, with years; undated ones pass any year."""
        own = self.resolve(ref).first()
        if own is None:
            return self._error(f"unknown: {ref}")
        e = self.edges if edge_type is None else self.edges.where(F.col("edge") == edge_type)
        e = e.where(F.col("year").isNull() | (F.col("year") == year)) if year else e
        out = e.where((F.col("src_type") == own.type) & (F.col("src_id") == own.id)).select(F.lit("out").alias("side"), "edge", F.col("dst_type").alias("type"), F.col("dst_id").alias("id"), "year")
        into = e.where((F.col("dst_type") == own.type) & (F.col("dst_id") == own.id)).select(F.lit("in").alias("side"), "edge", F.col("src_type").alias("type"), F.col("src_id").alias("id"), "year")
        g = out.union(into).groupBy("side", "edge", "type", "id").agg(F.count_distinct("year").alias("n_years"), year_ranges(F.collect_set("year")).alias("years"))
        named = g.join(self.entities.select("type", "id", "name"), ["type", "id"], "left")
        return named.select("side", "edge", "type", "id", "name", "n_years", "years").orderBy("edge", F.desc("n_years"), "name", "id").limit(limit)

    def mentioned_in(self, ref: str) -> DataFrame:
        """An entity's mentions by year: those of high or medium confidence, and all."""
        own = self.resolve(ref).first()
        if own is None:
            return self._error(f"unknown: {ref}")
        m = self.mentions.where((F.col("entity_type") == own.type) & (F.col("entity_id") == own.id))
        return m.groupBy("report_year").agg(F.count_if(F.col("confidence").isin(*PRIMARY)).alias("primary"), F.count("*").alias("all")).orderBy("report_year")

    def get_document(self, ref: str) -> DataFrame:
        """The outline of a document, by id, tag or year, with the primary mentions of each segment."""
        d = self.documents.where((F.col("doc_id") == ref) | (F.col("tag") == ref) | (F.col("report_year").cast("string") == ref)).select("doc_id", "title").limit(1)
        if d.isEmpty():
            return self._error(f"no document: {ref}")
        n = self.mentions.where(F.col("confidence").isin(*PRIMARY)).groupBy("doc_id", "segment_id").agg(F.count("*").alias("n_mentions"))
        toc = d.join(self.segments, "doc_id").join(n, ["doc_id", "segment_id"], "left")
        return toc.select("doc_id", "segment_id", "ordinal", "heading", "kind", "page_start", "page_end", F.coalesce("n_mentions", F.lit(0)).alias("n_mentions")).orderBy("ordinal")

    def get_segment(self, doc_id: str, segment_id: str, with_mentions: bool = True) -> DataFrame:
        """A segment's text and, if asked for, its entities with surfaces and counts."""
        s = self.segments.where((F.col("doc_id") == doc_id) & (F.col("segment_id") == segment_id))
        if s.isEmpty():
            return self._error(f"no segment: {doc_id} / {segment_id}")
        if not with_mentions:
            return s
        m = self.mentions.where((F.col("doc_id") == doc_id) & (F.col("segment_id") == segment_id))
        g = m.groupBy("doc_id", "segment_id", "entity_type", "entity_id").agg(F.count("*").alias("n"), F.count_if(F.col("confidence").isin(*PRIMARY)).alias("primary"), F.array_join(F.array_sort(F.collect_set("surface")), ", ").alias("surfaces"))
        rolled = g.groupBy("doc_id", "segment_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "entity_type", "entity_id", "n", "primary", "surfaces"))).alias("entities"))
        return s.join(rolled, ["doc_id", "segment_id"], "left")

    def series(self, ref: str, series_id: str | None = None, limit: int = 200) -> DataFrame:
        """An entity's series, or the points of one with the segment that holds their page: tables first, then the tightest."""
        own = self.resolve(ref).first()
        if own is None:
            return self._error(f"unknown: {ref}")
        o = canonical_points(self.observations.where(F.col("entity_type") == own.type), self.redirects, "entity_id").where(F.col("canonical") == own.id)
        if series_id is None:
            return o.groupBy("series_id", "unit").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year")).orderBy("series_id").limit(limit)
        points = addressed(o.where(F.col("series_id") == series_id), self.segments)
        return points.select("series_id", "year", "value", "unit", "page", F.coalesce("address", F.lit("")).alias("address"), F.col("heading").alias("segment_heading")).orderBy("year", "page").limit(limit)

    def open_page(self, ref: str) -> DataFrame:
        """A hub of one row: the entity, its names, and how much is known of it."""
        own = self.resolve(ref).first()
        if own is None:
            return self._error(f"unknown: {ref}")
        e = self.entities.where((F.col("type") == own.type) & (F.col("id") == own.id))
        names = self.aliases.where((F.col("type") == own.type) & (F.col("id") == own.id)).groupBy("type", "id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "alias"))), lambda x: x["alias"]), 1, 25).alias("names"))
        relations = self.edges.where((F.col("src_type") == own.type) & (F.col("src_id") == own.id)).groupBy(F.col("src_type").alias("type"), F.col("src_id").alias("id")).agg(F.count("*").alias("n_edges"))
        series = self.observations.where((F.col("entity_type") == own.type) & (F.col("entity_id") == own.id)).groupBy(F.col("entity_type").alias("type"), F.col("entity_id").alias("id")).agg(F.count_distinct("series_id").alias("n_series"))
        return e.join(names, ["type", "id"], "left").join(relations, ["type", "id"], "left").join(series, ["type", "id"], "left")
