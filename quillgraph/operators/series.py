"""Printed rows to observations: header carry-forward, positional unpivot, label rules, ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.names import dateline_region
from quillgraph.functions.numbers import parse_value
from quillgraph.functions.text import norm
from quillgraph.operators.identity import redirect_closure
from quillgraph.operators.lineage import cut


def unpivoted(rows: DataFrame, columns: str, values: str) -> DataFrame:
    """A row for each column that governs a row; short rows give null cells."""
    cells = F.transform(F.col(columns), lambda c, i: F.struct(c.alias("label"), F.get(F.col(values), i).alias("cell"), i.cast("int").alias("position")))
    return rows.select("*", F.explode(cells).alias("_c")).select("*", "_c.*").drop("_c")


def mapped_series(label: Column, year: Column, rules: Sequence[tuple], ignored: str) -> Column:
    """The series of a label by the first rule that fits: (series, pattern, first year, last year).

    ``{x}`` in a series takes the words of the first group; a rule whose group is
    empty, or a label that ``ignored`` fits, gives ``ignored``; no rule gives null.
    """
    out = F.lit(None).cast("string")
    for series, pattern, low, high in reversed(rules):
        fits = label.rlike(pattern) & year.between(low, high)
        if "{x}" in series:
            group = F.replace(F.trim(F.regexp_extract(label, pattern, 1)), F.lit(" "), F.lit("_"))
            named = F.when(group == "", F.lit("ignored")).otherwise(F.replace(F.lit(series), F.lit("{x}"), group))
        else:
            named = F.lit(series)
        out = F.when(fits, named).otherwise(out)
    return F.when(label.rlike(ignored), F.lit("ignored")).otherwise(out)


def observations(cells: DataFrame, entity: str, year: str, rules: Sequence[tuple], ignored: str) -> DataFrame:
    """``entity, year, series, value`` of the cells whose label has a series and whose cell has a number.

    The rules run over the distinct labels of each year alone, which are kept in a table so that no
    filter moves the rules to the cells; cells meet them by label and year.
    """
    labels = cut(cells.select("label", year).distinct())
    named = labels.withColumn("series", mapped_series(norm("label"), F.col(year), rules, ignored)).where("series is not null and series <> 'ignored'")
    rows = cells.select(entity, year, "label", "cell").where("cell is not null").join(named, ["label", year])
    return rows.withColumn("value", parse_value("cell")).where("value is not null").select(entity, year, "series", "value")


def ledger_entries(rows: DataFrame, account: str, label: str, values: str) -> DataFrame:
    """The two sides of a printed ledger row [a, b, description, c, d]: a debit under the label, a credit under the description.

    A side without a figure gives no entry.
    """
    cell = lambda i: F.get(F.col(values), F.lit(i))
    debit = F.struct(F.lit("Dr").alias("side"), F.col(label).alias("description"), cell(0).try_cast("double").alias("capital"), cell(1).try_cast("double").alias("interest"))
    credit = F.struct(F.lit("Cr").alias("side"), cell(2).alias("description"), cell(3).try_cast("double").alias("capital"), cell(4).try_cast("double").alias("interest"))
    return rows.select(account, F.explode(F.array(debit, credit)).alias("e")).select(account, "e.*").where("capital is not null or interest is not null")


def emitted(observed: DataFrame, entity: str, kind: str, units: DataFrame, papers: DataFrame) -> DataFrame:
    """``observed`` with ``entity_type`` and ``paper_id``.

    The type is ``kind``, or ``unit`` where the entity is flagged in ``units`` (a column of its name); the paper is that of
    the observation's ``year`` in ``papers`` (report_year, paper_id), the last by name if a year has several, and empty if it has none.
    """
    flagged = units.select(F.col(entity)).where(F.col(entity).isNotNull()).distinct().withColumn("_unit", F.lit(True))
    printed = papers.where("report_year is not null").groupBy(F.col("report_year").cast("int").alias("year")).agg(F.max("paper_id").alias("paper_id"))
    rows = observed.join(flagged, entity, "left").join(printed, "year", "left")
    return rows.withColumn("entity_type", F.when(F.col("_unit"), "unit").otherwise(kind)).withColumn("paper_id", F.coalesce("paper_id", F.lit(""))).drop("_unit")


def chain_regions(letters: DataFrame, chain: str, text: str) -> DataFrame:
    """``chain, region, votes``: the region that most of a chain's letters are dated from; ties to the first by name. Chains without a known one are left out."""
    votes = letters.select(F.col(chain).alias("chain"), dateline_region(text).alias("region")).where("chain is not null and region is not null").groupBy("chain", "region").agg(F.count("*").alias("votes"))
    best = votes.groupBy("chain").agg(F.min(F.struct((-F.col("votes")).alias("n"), "region")).alias("_b"))
    return best.select("chain", "_b.region", (-F.col("_b.n")).alias("votes"))


#: Pages of a block in which points and segments of a year meet.
PAGE_BLOCK = 32


def canonical_points(points: DataFrame, redirects: DataFrame, entity: str) -> DataFrame:
    """``points`` with ``canonical``: where the redirects (``id, target``) of the observed id end; the id itself if it has none."""
    ends = redirect_closure(redirects).select(F.col("id").alias(entity), F.col("canonical").alias("_to"))
    return points.join(ends, entity, "left").withColumn("canonical", F.coalesce("_to", entity)).drop("_to")


def addressed(points: DataFrame, segments: DataFrame, year: str = "year", page: str = "page") -> DataFrame:
    """``points`` with ``doc_id, segment_id, heading, address``: the segment of the point's year whose pages hold its page.

    Tables go before other segments, then the fewest pages, then document and segment.  Points
    without a year or page, or that no segment holds, have null addresses; each point stays one row.
    Points and segments meet in blocks of 32 pages of a year.
    """
    block = lambda c: F.floor(c / PAGE_BLOCK)
    held = segments.where("report_year is not null and page_start <= page_end").select("report_year", "page_start", "page_end", "doc_id", "segment_id", "heading", (~F.col("kind").eqNullSafe("tabular_statement")).alias("_other"), F.explode(F.sequence(block(F.col("page_start")), block(F.col("page_end")))).alias("_block"))
    at = points.select(F.col(year).alias("report_year"), F.col(page).alias("_page")).where("report_year is not null and _page is not null").distinct().withColumn("_block", block(F.col("_page")))
    met = at.join(held, ["report_year", "_block"]).where("_page between page_start and page_end")
    best = met.groupBy("report_year", "_page").agg(F.min(F.struct("_other", (F.col("page_end") - F.col("page_start")).alias("n"), "doc_id", "segment_id", "heading")).alias("_s"))
    best = best.select(F.col("report_year").alias(year), F.col("_page").alias(page), "_s.doc_id", "_s.segment_id", "_s.heading", F.concat_ws(" / ", "_s.doc_id", "_s.segment_id").alias("address"))
    return points.join(best, [year, page], "left")
