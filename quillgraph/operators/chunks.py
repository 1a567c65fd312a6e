"""A table's stretch in a long volume, and the windows of pages that it is read in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.lineage import cut

MARK = r"<!-- page ([0-9]+) -->"


def places(text: Column, pattern: str) -> Column:
    """Array of struct(start, end) of the places of a pattern in a text, counted from 0."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    both = F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda b, h: F.struct(F.length(b).alias("before"), F.length(h).alias("size")))

    def step(s, x):
        start = s["at"] + x["before"]
        return F.struct((start + x["size"]).alias("at"), F.concat(s["out"], F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end")))).alias("out"))

    return F.when(F.size(hits) > 0, F.aggregate(both, state, step, lambda s: s["out"])).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def page_marks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, page, at``: the page marks of each text."""
    numbers = F.regexp_extract_all(text, F.lit(MARK), 1)
    both = F.zip_with(numbers, places(F.col(text), MARK), lambda n, p: F.struct(n.try_cast("int").alias("page"), p["start"].alias("at")))
    return docs.where(F.col(text).isNotNull()).select("doc_id", F.explode(both).alias("_m")).select("doc_id", "_m.*")


def _page_at(marks: Column, at: Column) -> Column:
    """The page of the last mark at or before a place; 0 before any."""
    return F.aggregate(marks, F.lit(0), lambda p, m: F.when(m["at"] <= at, m["page"]).otherwise(p))


def located(docs: DataFrame, begin: str, end: str, after_page: int = 15, gap: int = 500, text: str = "text") -> DataFrame:
    """``doc_id, char_start, char_end, page_from, page_to``: the longest stretch from a begin to the next end.

    Begins on the first ``after_page`` pages are the table of contents', and
    do not count; an end counts ``gap`` characters after a begin's heading or later.  Ties go to
    the first; texts without such a stretch, and null ones, give no row.
    """
    marks = F.array_sort(F.zip_with(F.regexp_extract_all(text, F.lit(MARK), 1), places(F.col(text), MARK), lambda n, p: F.struct(p["start"].alias("at"), n.try_cast("int").alias("page"))))
    rows = docs.where(F.col(text).rlike(begin)).select("doc_id", marks.alias("_m"), places(F.col(text), begin).alias("_b"), places(F.col(text), end).alias("_e"))
    rows = rows.select("doc_id", "_m", "_e", F.explode("_b").alias("b")).withColumn("page_from", _page_at(F.col("_m"), F.col("b.start")))
    rows = rows.where(F.col("page_from") > after_page).withColumn("char_end", F.array_min(F.transform(F.filter("_e", lambda e: e["start"] >= F.col("b.end") + gap), lambda e: e["start"]))).where("char_end is not null")
    rows = rows.withColumn("page_to", _page_at(F.col("_m"), F.col("char_end")))
    best = F.max(F.struct((F.col("char_end") - F.col("b.start")).alias("n"), (-F.col("b.start")).alias("s"), "char_end", "page_from", "page_to")).alias("_x")
    return rows.groupBy("doc_id").agg(best).select("doc_id", (-F.col("_x.s")).alias("char_start"), "_x.char_end", "_x.page_from", "_x.page_to")


def page_chunks(docs: DataFrame, spans: DataFrame, pages: int = 8, context: int = 1500, header: int = 2500, least: int = 200, text: str = "text") -> DataFrame:
    """``doc_id, n, page_from, page_to, char_start, char_end, header, context, body``: a stretch in windows of ``pages`` pages.

    ``spans`` as ``located`` gives them.  The header is the stretch's first characters, the same for each window; the context is the
    tail before it, empty for the first.  A window begins at its first page's mark (the last, if a page is
    marked twice), so the bodies one after the other are the text; the first may begin before
    the stretch, on its page.  Bodies of less than ``least`` characters but for white space are left out, and ``n`` counts the others from 0.
    """
    marks = page_marks(docs, text).groupBy("doc_id", "page").agg(F.max("at").alias("at"))
    starts = spans.select("*", F.explode(F.sequence("page_from", F.greatest("page_from", "page_to"), F.lit(pages))).alias("a")).withColumn("b", F.least(F.col("a") + pages - 1, "page_to"))
    at = lambda page, name: marks.select("doc_id", F.col("page").alias(page), F.col("at").alias(name))
    rows = starts.join(at("a", "_lo"), ["doc_id", "a"], "left").withColumn("_next", F.col("b") + 1).join(at("_next", "_hi"), ["doc_id", "_next"], "left")
    lo, hi = F.coalesce("_lo", "char_start"), F.coalesce("_hi", "char_end")
    rows = rows.withColumn("lo", lo).withColumn("hi", F.when(F.col("b") == F.col("page_to"), F.least(hi, F.col("char_end"))).otherwise(hi))
    # all windows of a text meet it at once, and are cut from it before they are rows
    listed = rows.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b", "lo", "hi", "page_from", "char_start")).alias("_w")).join(docs.select("doc_id", F.col(text).alias("_t")), "doc_id")
    piece = lambda s, e: F.substr("_t", s + 1, F.greatest(e - s, F.lit(0)))
    ctx = lambda w: F.when(w["a"] > w["page_from"], piece(F.greatest(w["char_start"], w["lo"] - context), w["lo"])).otherwise("")
    cuts = F.transform("_w", lambda w: F.struct(*[w[k].alias(k) for k in ("a", "b", "lo", "hi")], piece(w["lo"], w["hi"]).alias("body"), ctx(w).alias("context"), piece(w["char_start"], w["char_start"] + header).alias("header")))
    rows = listed.select("doc_id", F.explode(cuts).alias("_c")).select("doc_id", "_c.*").where(F.length(F.regexp_replace("body", r"^\s+|\s+$", "")) >= least)
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("a")) - 1
    return cut(rows.withColumn("n", n)).select("doc_id", "n", F.col("a").alias("page_from"), F.col("b").alias("page_to"), F.col("lo").alias("char_start"), F.col("hi").alias("char_end"), "header", "context", "body")
