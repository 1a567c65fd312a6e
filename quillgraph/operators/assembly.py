"""The tables of a knowledge graph from linked tables: dated edges of every kind, entities of several sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The longest posting that is spread over its years (fixed value).
LONGEST = 45


def edge_rows(rows: DataFrame, src: tuple[str | Column, str | Column], edge: str | Column, dst: tuple[str, str | Column], year: str | None, evidence: str | None, source: str) -> DataFrame:
    """Edges of one kind: ``src_type, src_id, edge, dst_type, dst_id, year, evidence, source``; rows without either end give none."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    named, kind = (F.lit(x) if isinstance(x, str) else x for x in (edge, src[0]))
    out = rows.select(
        kind.alias("src_type"), col(src[1]).cast("string").alias("src_id"), named.alias("edge"), F.lit(dst[0]).alias("dst_type"), col(dst[1]).cast("string").alias("dst_id"),
        (F.col(year) if year else F.lit(None)).cast("int").alias("year"), (F.col(evidence) if evidence else F.lit(None)).cast("string").alias("evidence"), F.lit(source).alias("source"),
    )
    return out.where("src_id is not null and dst_id is not null")


def one_of_a_name(rows: DataFrame, key: Column, names: DataFrame, found: str) -> DataFrame:
    """Add ``found``: the id that alone has the key among ``names`` (``key, id``); null where none or several have it."""
    single = names.groupBy("key").agg(F.min("id").alias(found), F.max("id").alias("_last")).where(F.col(found) == F.col("_last")).select(F.col("key").alias("_key"), found)
    return rows.withColumn("_key", key).join(single, "_key", "left").drop("_key")


def graph_edges(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All edges of a graph, once for each pair of ends and year, with the least evidence of the least source.

    Tables that are absent are left out.  Their columns:

    ``events``: from_chain, event_type, to_chain, year, evidence;
    ``reserves``: reserve_id, band_id, agency_id, year;
    ``successors``: type, id, qid, label;
    ``band_years``: band_id, agency_id, year, printed;
    ``school_years``: school_id, agency_id, reserve_id, year, printed;
    ``teachers``: person_id, school_id, year, printed;
    ``postings``: person_id, agency_id, first_year, last_year (null: the first), printed;
    ``segments``: segment, agency_id, school_id, year, heading;
    ``mentions``: segment, entity_type, entity_id, confidence, context_agency, year.
    A person mentioned with high or medium confidence signed for the segment's
    agency, else for the agency of the context, and reported on its school.
    """
    parts: list[DataFrame] = []
    if (t := tables.get("events")) is not None:
        parts.append(edge_rows(t, ("agency", "from_chain"), F.col("event_type"), ("agency", "to_chain"), "year", "evidence", "events"))
    if (t := tables.get("reserves")) is not None:
        parts += [edge_rows(t, ("reserve", "reserve_id"), "ADMINISTERED_BY", ("agency", "agency_id"), "year", None, "reserves"), edge_rows(t, ("band", "band_id"), "OCCUPIES", ("reserve", "reserve_id"), "year", None, "reserves")]
    if (t := tables.get("successors")) is not None:
        parts.append(edge_rows(t, (F.col("type"), "id"), "SUCCEEDED_BY", ("wikidata", "qid"), None, "label", "successors"))
    if (t := tables.get("band_years")) is not None:
        parts.append(edge_rows(t, ("band", "band_id"), "ADMINISTERED_BY", ("agency", "agency_id"), "year", "printed", "band_years"))
    if (t := tables.get("school_years")) is not None:
        parts += [edge_rows(t, ("school", "school_id"), "IN_AGENCY", ("agency", "agency_id"), "year", "printed", "school_years"), edge_rows(t, ("school", "school_id"), "ON_RESERVE", ("reserve", "reserve_id"), "year", "printed", "school_years")]
    if (t := tables.get("teachers")) is not None:
        parts.append(edge_rows(t, ("person", "person_id"), "TAUGHT_AT", ("school", "school_id"), "year", "printed", "teachers"))
    if (t := tables.get("postings")) is not None:
        last = F.least(F.coalesce("last_year", "first_year"), F.col("first_year") + LONGEST)
        spread = t.where("first_year is not null").withColumn("year", F.explode(F.sequence(F.col("first_year"), F.greatest(last, F.col("first_year")))))
        parts.append(edge_rows(spread, ("person", "person_id"), "POSTED_TO", ("agency", "agency_id"), "year", "printed", "postings"))
    if (t := tables.get("segments")) is not None:
        parts.append(edge_rows(t, ("school", "school_id"), "REPORTED_IN", ("segment", "segment"), "year", "heading", "segments"))
        if (m := tables.get("mentions")) is not None:
            people = m.where("entity_type = 'person' and confidence in ('high', 'medium')").join(t.select("segment", "agency_id", "school_id"), "segment", "left")
            signed = people.withColumn("agency_id", F.coalesce("agency_id", "context_agency"))
            parts += [edge_rows(signed, ("person", "entity_id"), "SIGNED_FOR", ("agency", "agency_id"), "year", "segment", "mentions"), edge_rows(signed, ("person", "entity_id"), "REPORTED_ON", ("school", "school_id"), "year", "segment", "mentions")]
    every = reduce(DataFrame.union, parts)
    return every.groupBy("src_type", "src_id", "edge", "dst_type", "dst_id", "year").agg(F.min(F.struct("source", "evidence")).alias("_e")).select("src_type", "src_id", "edge", "dst_type", "dst_id", "year", "_e.evidence", "_e.source")


def entities(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``type, id, name, region, kind, first_year, last_year, n_years``: one row for each entity.

    The first source that has it, in the order given, gives name and region;
    later ones widen its years, add theirs up and add their kinds (``a+b``).  Of
    one source's rows for an entity the earliest, then the first name, comes first.
    """
    rows = reduce(DataFrame.union, [t.select("type", F.col("id").cast("string").alias("id"), "name", "region", F.lit(kind).alias("kind"), F.lit(rank).alias("_rank"), "first_year", "last_year", "n_years") for rank, (kind, t) in enumerate(sources)])
    first = F.min(F.struct("_rank", F.coalesce("first_year", F.lit(9999)).alias("y"), "name", "region"))
    kinds = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("_rank", "kind"))), lambda x: x["kind"]), "+")
    out = rows.groupBy("type", "id").agg(first.alias("_f"), kinds.alias("kind"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.sum("n_years").alias("n_years"))
    return out.select("type", "id", "_f.name", "_f.region", "kind", "first_year", "last_year", "n_years")


def chain_events(chains: DataFrame, gap: int = 3) -> DataFrame:
    """``before, after, year``: chains of which one ends up to ``gap`` years before, or in the year, another begins, and that share a word of four letters.

    ``chains``: ``chain, name, first_year, last_year``.  Chains meet on word and
    year, so a common word pairs only chains that lie close in time.
    """
    words = chains.select("chain", "first_year", "last_year", F.explode(F.array_distinct(F.filter(F.regexp_extract_all(F.lower("name"), F.lit("([a-z]+)"), 1), lambda w: F.length(w) >= 4))).alias("word"))
    ends = words.select("word", F.col("chain").alias("before"), F.explode(F.sequence(F.col("last_year"), F.col("last_year") + gap)).alias("year"))
    return ends.join(words.select("word", F.col("chain").alias("after"), F.col("first_year").alias("year")), ["word", "year"]).where("before <> after").select("before", "after", "year").distinct()


def series_sections(observed: DataFrame, entity: str, series: str, year: str, value: str) -> DataFrame:
    """``entity, section, label, first_year, last_year, n, cells``: an entity's series, grouped by the part of their name before the first underscore.

    Cells are ``year:value`` in order of years, ties by value, joined by bars.
    """
    at = F.instr(series, "_")
    section = F.when(at > 1, F.substr(series, F.lit(1), at - 1)).otherwise(F.col(series))
    cells = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(year).alias("y"), F.col(value).alias("v")))), lambda x: F.concat(x["y"].cast("string"), F.lit(":"), x["v"].cast("string"))), "|")
    return observed.groupBy(entity, section.alias("section"), F.col(series).alias("label")).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count("*").alias("n"), cells.alias("cells"))
