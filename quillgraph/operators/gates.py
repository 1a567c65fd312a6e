"""Gates on printed rows and pages: what is no entry, where a statement ends, what became of rows left over."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.numbers import acres_close_text, acres_of
from quillgraph.functions.text import norm
from quillgraph.operators.editions import likeness
from quillgraph.operators.lineage import cut

# Fixed forms of the printed statements.
UNIT_ROW = r"(?i)\b(agency|agencies|superintendency|inspectorate|district)\s*\.?\s*$"
TYPE_WORD = r"(?i)\b(day|boarding|industrial|residential)\b"
PROVINCE_ROW = r"(?i)^\W{0,3}(ontario|quebec|nova scotia|new brunswick|prince edward island|manitoba|saskatchewan|alberta|north-?west territories|british columbia|yukon( territory)?|total|grand total)\W{0,3}$"
PERSON_ROW = (
    r"(?i)\b(M\.?\s?D\.?|Rev\.|Dr\.|Esq\.?|Mrs\.|Miss)(\s|$)|\bcount(y|ies)\b|^[A-Z][a-z']+,\s+[A-Z][a-z]*\.?(\s|$)|"
    r"\b(Indian Agent|Field Matron|Stenographer|Interpreter|Clerk|Farmer|Instructor|Constable)\b|^Treaty No\."
)
MONEY_CELL = r"^\$?\d[\d,]*\.\d{2}$"
PRINTED_TYPES = ("day", "boarding", "industrial", "residential")
CENSUS_ALONE = "census return|number in band|number on band|ages? and sexes"
DENOMINATIONS = "anglican|roman catholic|presbyterian|methodist|baptist|pagan|aboriginal belief|other christian|congregationalist|united church"
CENSUS_LABELS = (
    "census|religio|protestant|catholic|pagan|anglican|methodist|presbyterian|baptist|aboriginal belief|other christian|number in band|population|denomination|"
    "male|female|births|deaths|ages? and sexes"
)
FARM_LABELS = (
    "acres?|bushel|cultivat|live ?stock|horses|cattle|swine|sheep|poultry|grain|root|hay|fenc|thresh|wagon|implement|plough|harrow|produce|value of|area of reserve|"
    "broken|under crop|under wood|seed|garden"
)
EASTERN = ("NS", "NB", "PE", "QC")
#: Ratios of two areas that a slip of a digit makes (fixed values).
SLIPS = ((9, 11), (95, 105), (950, 1050))


def row_kind(name: Column) -> Column:
    """What a row of a school statement is by its name: ``unit``, ``province``, ``person``, ``blank`` or ``school``."""
    x = F.trim(F.coalesce(name, F.lit("")))
    return F.when(x == "", "blank").when(x.rlike(UNIT_ROW) & ~x.rlike(TYPE_WORD), "unit").when(x.rlike(PROVINCE_ROW), "province").when(x.rlike(PERSON_ROW), "person").otherwise("school")


def gated_rows(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of school statements with ``printed``, ``type`` and ``fate``; only fate ``kept`` is an entry, the others say why not.

    ``rows``: year, page, name, teacher, denomination, values, extracted;
    ``pages``: year, page, type, one for each page.  ``end``: a page past the statement, or more than two
    pages after the last that has a type; ``sale``: dollars and cents, and neither teacher nor denomination.  A printed type goes
    before the extracted one, and both are kept.
    """
    last = pages.where("type <> 'end'").groupBy("year").agg(F.max("page").alias("_last"))
    out = rows.join(pages.select("year", "page", F.col("type").alias("_page")), ["year", "page"], "left").join(last, "year", "left")
    kind = row_kind(F.col("name"))
    past = (F.col("_page") == "end") | (F.col("page") > F.col("_last") + 2)
    none = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    sale = none("teacher") & none("denomination") & F.exists(F.coalesce("values", F.array().cast("array<string>")), lambda v: F.coalesce(F.trim(v).rlike(MONEY_CELL), F.lit(False)))
    fate = F.when(kind != "school", kind).when(F.coalesce(past, F.lit(False)), "end").when(sale, "sale").otherwise("kept")
    out = out.withColumn("printed", F.when(F.col("_page").isin(*PRINTED_TYPES), F.col("_page")).otherwise(""))
    return out.withColumn("type", F.coalesce(F.nullif("printed", F.lit("")), "extracted")).withColumn("fate", fate).drop("_page", "_last")


def reads_as(text: Column, signs: str, against: str, strong: int = 3, most: int = 3) -> Column:
    """Whether a page still reads as its statement: ``strong`` signs and fewer than ``most`` signs against it, or one sign and none."""
    x = F.coalesce(text, F.lit(""))
    n, m = F.regexp_count(x, F.lit(signs)), F.regexp_count(x, F.lit(against))
    return ((n >= strong) & (m < most)) | ((n >= 1) & (m == 0))


def area_change(before: Column, after: Column, other_unit: Column) -> Column:
    """struct(disposition, confidence) of two unlike areas: another unit, a slip of a digit, or a real change."""
    ratio = F.greatest(before, after) / F.greatest(F.least(before, after), F.lit(0.01))
    slip = F.lit(False)
    for low, high in SLIPS:
        slip = slip | ((ratio > low) & (ratio < high))
    fate = lambda d, c: F.struct(F.lit(d).alias("disposition"), F.lit(c).alias("confidence"))
    both = before.isNotNull() & after.isNotNull()
    return F.when(other_unit, fate("unit_mismatch", "high")).when(both & slip, fate("ocr_digit", "medium")).when(both & (ratio < 9), fate("real_change_candidate", "medium")).otherwise(fate("real_change_candidate", "low"))


def header_class(columns: Column, title: Column) -> Column:
    """Whether a table's column labels and title are a census's, agricultural ones, or neither: ``census``, ``agri``, ``unknown``.

    A label that only a census has, or two denominations, settle it, whatever else stands there;
    else the words of either side are counted, and agriculture takes a draw.
    """
    text = F.concat_ws(" ", F.array_join(F.transform(F.coalesce(columns, F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit(""))), " | "), F.coalesce(title, F.lit("")))
    told = F.size(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({DENOMINATIONS})"), 1)))
    c, a = (F.regexp_count(text, F.lit(f"(?i){p}")) for p in (CENSUS_LABELS, FARM_LABELS))
    return F.when(text.rlike(f"(?i){CENSUS_ALONE}") | (told >= 2), "census").when((c == 0) & (a == 0), "unknown").when(c > a, "census").otherwise("agri")


def leftover_fates(rows: DataFrame, matched: DataFrame, registry: DataFrame, like: Callable[[Column, Column], Column] = likeness, eastern: Sequence[str] = EASTERN) -> DataFrame:
    """``id, disposition, confidence, proposed`` of rows that no registry entry was matched to.

    ``rows``: id, edition, region, page, no, name, band, acres; ``matched``: edition, page, no, name, entry; ``registry``:
    entry, region, no, name, band, acres; acres are as printed.  Names, numbers and bands are folded.  In this order: nothing printed (``degenerate_row``);
    a matched row of the same number at most two pages off, with a like (.7) name (``duplicate_emission``; the least entry);
    the only entry of number and name (``greedy_steal``); the only entry of a like (.75) band with a
    like (.6) name or the same acres (``renumbered_link``); in the east, where bands weren't
    printed, the only entry of a like (.7) name or one that holds the other, of five letters at least (``renumbered_link``,
    low); else ``absence_candidate``.  A row without a page is near no other.
    """
    folded = lambda *others: [F.col(c) for c in others] + [norm(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("no", "name")]
    r = cut(rows.select(*folded("id", "edition", "region", "page", "acres"), norm(F.coalesce("band", F.lit(""))).alias("band")))
    m = matched.select(*folded("edition", "page", "entry"))
    g = cut(registry.select(*folded("entry", "region", "acres"), norm(F.coalesce("band", F.lit(""))).alias("band")))
    # what rows and entries print alike is compared once, and counted for all that print it
    entries = lambda *by: g.groupBy(*by).agg(F.min("entry").alias("_e"), F.count("*").alias("_c"))
    found = lambda t, by, entry, n: t.groupBy(*by).agg(F.min("_e").alias(entry), F.sum("_c").alias(n))
    # pages at most two apart are in the same block of three or in neighbouring ones
    line = ["edition", "no", "name", "page"]
    at = r.select(*line).distinct().withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.col("page") / 3) + i)))
    m = m.groupBy(*line).agg(F.min("entry").alias("entry")).withColumn("_b", F.floor(F.col("page") / 3))
    near = at.alias("r").join(m.alias("m"), ["edition", "no", "_b"]).where(F.abs(F.col("r.page") - F.col("m.page")) <= 2)
    near = near.where((like(F.col("r.name"), F.col("m.name")) >= 0.7) | ((F.col("r.name") != "") & (F.col("r.name") == F.col("m.name"))))
    dup = near.groupBy("edition", "no", "r.name", "r.page").agg(F.min("entry").alias("_dup"))
    same = entries("region", "no", "name").where("no <> '' and name <> ''").withColumnsRenamed({"_e": "_steal", "_c": "_ns"})
    bands = r.select("region", "band").where("band <> ''").distinct().join(g.select("region", F.col("band").alias("_band")).distinct(), "region")
    bands = cut(bands.where((F.col("band") == F.col("_band")) | (like(F.col("band"), F.col("_band")) >= 0.75)))
    mine, theirs = F.col("name"), F.col("_name")
    names = r.select("region", "name").distinct().join(g.select("region", F.col("name").alias("_name")).distinct(), "region").withColumn("_like", like(mine, theirs))
    held = ((F.length(mine) >= 5) & F.contains(theirs, mine)) | ((F.length(theirs) >= 5) & F.contains(mine, theirs))
    names = cut(names.withColumn("_east", F.col("region").isin(*eastern) & (mine != "") & ((F.col("_like") >= 0.7) | held)).where("_east or _like >= 0.6"))
    alike = names.where("_like >= 0.6").select("region", "name", "_name")
    # like names of a like band, and then those of unlike names whose acres are the same
    own = r.select("region", "band", "name").distinct().join(bands, ["region", "band"]).join(alike, ["region", "name"])
    by_name = found(own.join(entries("region", "band", "name").withColumnsRenamed({"band": "_band", "name": "_name"}), ["region", "_band", "_name"]), ["region", "band", "name"], "_e1", "_n1")
    hundredth = lambda c: F.floor(acres_of(c) * 100)
    printed = entries("region", "band", "name", "acres").withColumnsRenamed({"band": "_band", "name": "_name", "acres": "_acres"}).withColumn("_h", hundredth("_acres"))
    own = r.where("acres is not null").select("region", "band", "name", "acres").distinct().join(bands, ["region", "band"]).withColumn("_h", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: hundredth("acres") + i)))
    own = own.join(printed, ["region", "_band", "_h"]).where(acres_close_text("acres", "_acres")).join(alike, ["region", "name", "_name"], "left_anti")
    by_acres = found(own, ["region", "band", "name", "acres"], "_e2", "_n2")
    east = found(names.where("_east").join(entries("region", "name").withColumnRenamed("name", "_name"), ["region", "_name"]), ["region", "name"], "_east", "_ne")
    out = r.join(dup, line, "left").join(same, ["region", "no", "name"], "left").join(by_name, ["region", "band", "name"], "left").join(by_acres, ["region", "band", "name", "acres"], "left").join(east, ["region", "name"], "left")
    out = out.withColumn("_renumbered", F.least("_e1", "_e2")).withColumn("_nr", F.coalesce("_n1", F.lit(0)) + F.coalesce("_n2", F.lit(0)))
    steps = [
        (F.concat("no", "name", "band") == "", "degenerate_row", "high", F.lit(None)), (F.col("_dup").isNotNull(), "duplicate_emission", "high", F.col("_dup")),
        (F.col("_ns") == 1, "greedy_steal", "medium", F.col("_steal")), (F.col("_nr") == 1, "renumbered_link", "medium", F.col("_renumbered")), (F.col("_ne") == 1, "renumbered_link", "low", F.col("_east")),
    ]
    kind = dict(registry.dtypes)["entry"]
    fate = lambda d, c, e: F.struct(F.lit(d).alias("disposition"), F.lit(c).alias("confidence"), e.cast(kind).alias("proposed"))
    pick = fate("absence_candidate", "low", F.lit(None))
    for when, d, c, e in reversed(steps):
        pick = F.when(when, fate(d, c, e)).otherwise(pick)
    return out.select("id", pick.alias("_f")).select("id", "_f.*")


def page_types(signals: DataFrame, after: dict[str, str], late: int = 6, early: int = 1) -> DataFrame:
    """``year, page, type, n_signals``: the statement that each page belongs to, carried from page to page in a year.

    ``signals``: year, page, n, kind, strength, rank; one row at least for each
    page, with a null kind where the page says nothing.  ``strength`` is title or
    header; a header never turns residential back into day.  A page whose
    provinces (``rank``) start again from the front, a rank of ``early`` or less right after
    one of ``late`` or more, opens the statement ``after`` the present one, if nothing on it did so before.
    Pages that aren't consecutive carry nothing; a page with two kinds is mixed, and the last goes on.
    A run of consecutive pages is folded as one array of its signals.
    """
    order = Window.partitionBy("year").orderBy("page", "n")
    told = signals.where("kind is not null or rank is not null").select("year", "page", "n", "kind", "strength", "rank")
    again = F.col("kind").isNull() & (F.col("rank") <= early) & (F.lag(F.when(F.col("kind").isNull(), F.col("rank"))).over(order) >= late)
    told = told.withColumn("again", F.coalesce(again, F.lit(False))).where("kind is not null or again")
    by_page = Window.partitionBy("year").orderBy("page")
    pages = signals.select("year", "page").distinct().withColumn("_gap", F.coalesce((F.col("page") > F.lag("page").over(by_page) + 1).cast("int"), F.lit(0)))
    pages = pages.withColumn("run", F.sum("_gap").over(by_page.rowsBetween(Window.unboundedPreceding, 0))).drop("_gap")
    def said(last: Column, x: Column) -> Column:
        """What a signal says after the last one that counted; null if nothing."""
        following = F.lit(None).cast("string")
        for this, then in after.items():
            following = F.when((last["kind"] == this) & ~last["page"].eqNullSafe(x["page"]), then).otherwise(following)
        weak = (x["strength"] == "header") & (x["kind"] == "day") & last["kind"].eqNullSafe("residential")
        return F.when(x["again"], following).when(~F.coalesce(weak, F.lit(False)), x["kind"])

    one = lambda page, kind: F.struct(page.alias("page"), kind.alias("kind"))
    listed = F.array_sort(F.collect_list(F.struct("page", "n", "kind", "strength", "again")))
    none = F.array().cast("array<struct<page:int,kind:string>>")
    start = one(F.lit(None).cast("int"), F.lit(None).cast("string"))
    counted = F.aggregate(listed, none, lambda seen, x: F.when(said(F.coalesce(F.try_element_at(seen, F.lit(-1)), start), x).isNotNull(), F.concat(seen, F.array(one(x["page"].cast("int"), said(F.coalesce(F.try_element_at(seen, F.lit(-1)), start), x))))).otherwise(seen))
    runs = told.join(pages, ["year", "page"]).groupBy("year", "run").agg(counted.alias("_c"))
    found = runs.select("year", F.posexplode("_c").alias("_i", "_s")).groupBy("year", F.col("_s.page").alias("page")).agg(F.count("*").alias("n_signals"), F.count_distinct("_s.kind").alias("_kinds"), F.max(F.struct("_i", "_s.kind")).alias("_l"))
    out = pages.join(found, ["year", "page"], "left").withColumn("_own", F.col("_l.kind"))
    carried = F.last("_own", True).over(Window.partitionBy("year", "run").orderBy("page"))
    kind = F.when(F.col("_kinds") > 1, "mixed").otherwise(F.coalesce(carried, F.lit("")))
    return out.select("year", "page", kind.alias("type"), F.coalesce("n_signals", F.lit(0)).cast("int").alias("n_signals"))
