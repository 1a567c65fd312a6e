"""Entity pages: what is known of each entity, in sections of ranked lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.numbers import year_ranges

#: Sections in the order of a page, and the most lines of each.
SECTIONS = {"names": 25, "relations": 200, "referenced": 200, "series": 1000, "years": 1000, "segments": 15}
PRIMARY = ("high", "medium")
#: Tasks among which lines are dealt where a set or a text is made of them: what a task holds is its share of the lines.
PARTS = 192


def hub_sections(entities: DataFrame, aliases: DataFrame, edges: DataFrame, observations: DataFrame, mentions: DataFrame) -> DataFrame:
    """``type, id, section, rank, item, n, years``: the lines of every entity's page, at most ``SECTIONS`` of each.

    ``names``: its spellings by how often they come; ``relations`` and ``referenced``: edges out of and into it, each kind and
    other end once, by kind, then the number of years; ``series``: its series by name with their points; ``years``: the years that mention it, with high
    or medium confidence; ``segments``: the segments that do so most, the older first.  ``years`` of a line are its runs
    of years, empty if it has none.  Ties go to the item's name.  The tables are those of ``api.Archive``; rows of an unknown entity and null
    items are left out, and an entity of which nothing is known has no lines.
    """
    own = entities.select("type", "id").distinct()
    none = F.lit("")
    a = aliases.groupBy("type", "id", F.col("alias").alias("item")).agg(F.sum("n").alias("n")).select("type", "id", "item", "n", none.alias("years"))
    parts = {"names": (a, [F.desc("n")])}
    for section, mine, other in (("relations", "src", "dst"), ("referenced", "dst", "src")):
        item = F.concat(F.col("edge"), F.lit(" "), F.col(f"{other}_type"), F.lit(":"), F.col(f"{other}_id").cast("string"))
        e = edges.select(F.col(f"{mine}_type").alias("type"), F.col(f"{mine}_id").alias("id"), "edge", item.alias("item"), "year").repartition(PARTS, "type", "id", "item")
        e = e.groupBy("type", "id", "edge", "item").agg(F.collect_set("year").alias("_years"))
        e = e.select("type", "id", "edge", "item", F.size("_years").cast("long").alias("n"), F.coalesce(year_ranges(F.col("_years")), none).alias("years"))
        parts[section] = (e, [F.asc("edge"), F.desc("n")])
    o = observations.groupBy(F.col("entity_type").alias("type"), F.col("entity_id").alias("id"), F.col("series_id").alias("item")).agg(F.count("*").alias("n"), F.concat(F.min("year").cast("string"), F.lit("–"), F.max("year").cast("string")).alias("years"))
    parts["series"] = (o.withColumn("years", F.coalesce("years", none)), [])
    m = mentions.where(F.col("confidence").isin(*PRIMARY)).select(F.col("entity_type").alias("type"), F.col("entity_id").alias("id"), "report_year", F.concat_ws(" / ", "doc_id", "segment_id").alias("segment"))
    parts["years"] = (m.groupBy("type", "id", F.col("report_year").cast("string").alias("item")).agg(F.count("*").alias("n")).withColumn("years", none), [])
    s = m.groupBy("type", "id", F.col("segment").alias("item")).agg(F.count("*").alias("n"), F.min("report_year").alias("_y")).withColumn("years", F.coalesce(F.col("_y").cast("string"), none))
    parts["segments"] = (s, [F.desc("n"), F.asc("_y")])
    out = None
    for section, (frame, order) in parts.items():
        rank = F.row_number().over(Window.partitionBy("type", "id").orderBy(*order, "item"))
        # the first lines before the join: the many lines of one entity are cut where they lie, not in the task that they meet in
        part = frame.where("item is not null").withColumn("rank", rank).where(F.col("rank") <= SECTIONS[section]).join(own, ["type", "id"], "left_semi")
        part = part.select("type", "id", F.lit(section).alias("section"), "rank", "item", "n", "years")
        out = part if out is None else out.unionByName(part)
    return out


def hub_texts(entities: DataFrame, sections: DataFrame) -> DataFrame:
    """``type, id, text``: the page of every entity, its name and summary first, then its sections, a line for each item."""
    place = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    line = F.concat(F.lit("- "), F.col("item"), F.lit(" ("), F.col("n").cast("string"), F.when(F.col("years") != "", F.concat(F.lit("; "), F.col("years"))).otherwise(""), F.lit(")"))
    each = sections.repartition(PARTS, "type", "id").groupBy("type", "id", "section", place.alias("_p")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "\n").alias("_l"))
    body = each.groupBy("type", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", F.concat(F.lit("## "), "section", F.lit("\n"), "_l").alias("s")))), lambda x: x["s"]), "\n\n").alias("_b"))
    rows = entities.select("type", "id", "name", "summary").join(body, ["type", "id"], "left")
    head = F.concat(F.lit("# "), F.coalesce("name", F.col("id").cast("string")))
    return rows.select("type", "id", F.concat_ws("\n\n", head, F.nullif(F.trim("summary"), F.lit("")), "_b").alias("text"))
