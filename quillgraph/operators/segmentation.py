"""Volumes cut into segments at their letters, captions and headings.

A volume is a text of lines.  Its anchors are lines, found by column expressions
over the lines and the few lines before them; a segment reaches from one anchor
to the next, so segments never overlap and leave nothing out after the first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.text import fold, slug, text_version
from quillgraph.operators.lineage import cut

# Fixed forms of the printed volumes.
#: White space of any kind within a line, as characters and as a class of a pattern.
SPACES = " \t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_S = rf"[{SPACES}]"
PAGE = r"^<!-- page ([0-9]+) -->"
SALUTATION = rf"^{_S}*SIR{_S}?, ?[-—]"
#: A salutation broken after its word.
BROKEN = (rf"^{_S}*SIR\z", "^, ?[-—]")
CAPTION = (
    r"^(TABULAR STATEMENT No\. ?\d+[A-Za-z]?\.?|RETURN,? [A-Z],? ?(?:\(?\d+\)?)?\.?|STATEMENT [A-Z0-9][A-Za-z0-9 ,.()'-]{0,70}|"
    rf"SCHOOL STATEMENT[A-Za-z0-9 ,.()'-]{{0,60}}|APPENDIX[A-Za-z0-9 ,.()'-]{{0,60}}){_S}*\z"
)
PROVINCES = (
    "ONTARIO|QUEBEC|NOVA SCOTIA|NEW BRUNSWICK|PRINCE EDWARD ISLAND|MANITOBA|BRITISH COLUMBIA|SASKATCHEWAN|ALBERTA|NORTH-?WEST TERRITORIES|"
    "NORTHWEST TERRITORIES|YUKON|MANITOBA AND (?:THE )?NORTH-?WEST(?: TERRITORIES)?"
)
PROVINCE = rf"^(?:PROVINCE OF )?({PROVINCES})[ .,]*\z"
#: A province over a part of a large segment.
SUBHEAD = rf"^({PROVINCES})\.?(?: ?[-–—] ?(?:Continued|Concluded)\.?)?{_S}*\z"
HEADING = r"^[A-Z][A-Z0-9 ,.&:;()'’-]{3,70}$"
CONTENTS = rf"^(INDEX|CONTENTS)\.?{_S}*\z"
PRESENTATION = r"(?d)^To .{0,120}(Excellency|Royal Highness)"
CLOSING = r"(?iu)(obedient|humble)\s+servant|I have the hono[u]?r to be|I have, ?&|I am, ?(Sir|&)|Yours (very )?(truly|sincerely|respectfully)"
UNIT = r"(?U)\b(AGENCY|AGENCIES|SUPERINTENDENCY|INSPECTORATE|COMMISSIONER|SURVEY|SCHOOL|OFFICE|RESERVE|BAND)\b"
#: Lines between two hyphened lines that open a text, and the kind of volume that they name; that of a text without them.
FRONT, KIND, REPORT = r"(?s)^---\n.*?\n---\n", r'(?m)^document_type:\s*"?(\w+)"?', "annual_report"
#: Salutations that make a volume one of letters; lines that a letter's head may reach back; the shortest segment; characters of prose that opens a report.
LETTERS, WALK, SLIVER, PROSE = 10, 14, 40, 150
#: Characters above which a segment is cut at its provinces, pages that a part then has at most, characters between two cuts at least, and of a segment's opening.
LARGE, PAGES, APART, OPENING = 150_000, 60, 500, 1200


def volume_lines(docs: DataFrame, text: str = "text", *carried: str) -> DataFrame:
    """``doc_id, n, line, char_start, page``: every line of each text, with the last page mark at or before it (0 before any), and ``carried`` columns."""
    parts = docs.select("doc_id", *carried, F.posexplode(F.split(text, "\n")).alias("n", "line"))
    w = Window.partitionBy("doc_id").orderBy("n")
    begin = F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mark = F.regexp_extract("line", PAGE, 1).try_cast("int")
    return parts.withColumn("char_start", begin.cast("long")).withColumn("page", F.coalesce(F.last(mark, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))


def anchors(lines: DataFrame) -> DataFrame:
    """``doc_id, n, kind, heading``: the lines where segments begin, one kind for each.

    A volume with ten salutations is one of letters, if its ``doc_type`` (where ``lines`` have one) is an annual report: a letter
    begins at the top of its head, the short, blank and capital lines within 14 before the salutation and the blank lines above
    it, but after the closing formula of the letter before.  In others, headings in capitals after a blank line are anchors.
    Captions are anchors in both.  Where a letter and a caption begin on one line, it is the letter's.

    What opens a volume gives way to these: a letter of presentation and the title page before it, the contents after it, and the
    report that begins with the first long line between the contents and the first anchor.
    """
    trimmed = F.trim("line", F.lit(SPACES))
    doc, w = Window.partitionBy("doc_id"), Window.partitionBy("doc_id").orderBy("n")
    sir = F.col("line").rlike(SALUTATION) | (F.col("line").rlike(BROKEN[0]) & F.coalesce(F.lead(F.substring("line", 1, 3)).over(w).rlike(BROKEN[1]), F.lit(False)))
    report = [(F.col("doc_type") == REPORT).alias("_report")] if "doc_type" in lines.columns else []
    letters_here = F.count_if("_sir").over(doc) >= LETTERS
    letters_here = letters_here & F.col("_report") if report else letters_here
    # a letter's head is made of short lines, page marks and the salutation: others are prose, without a text here
    rows = lines.select("doc_id", "n", "line", trimmed.alias("_t"), *report).withColumn("_sir", sir).withColumn("_t", F.when((F.length("_t") <= 110) | F.col("_sir") | F.col("_t").rlike(PAGE), F.col("_t"))).drop("line")
    letters_only = F.regexp_replace("_t", r"[^\p{L}]", "")
    capitals = (F.length(F.regexp_replace(letters_only, r"[^\p{Lu}]", "")) > 0.7 * F.greatest(F.length(letters_only), F.lit(1))) & F.upper("_t").rlike(UNIT)
    role = F.when((F.col("_t") == "") | F.col("_t").rlike(PAGE), "blank").when(F.col("_t").isNull() | (F.length("_t") > 110), "prose").when(F.col("_unit"), "unit").when(F.length("_t") <= 90, "short").otherwise("prose")
    above = F.collect_list(F.when(F.col("_near"), F.struct("n", "_role", "_t", "_unit", "_closing"))).over(w.rowsBetween(-WALK, -1))
    # blank lines above a salutation are its own: the head ends at the first of them, and only lines near such a one have roles
    upwards = Window.partitionBy("doc_id").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.col("_t").isNull() | (F.col("_t") != "")
    sirs = rows.withColumn("_letters", letters_here).where("_letters").drop("_letters")  # other volumes need no roles
    sirs = sirs.withColumn("_top", F.coalesce(F.lag(filled).over(w), F.lit(True))).withColumn("_top", F.col("_top") & F.coalesce(F.last(F.when(filled, F.col("_sir")), True).over(upwards), F.lit(False)))
    sirs = sirs.withColumn("_near", F.coalesce(F.last(F.when(F.col("_top"), F.col("n")), True).over(upwards.rowsBetween(Window.unboundedPreceding, -1)) - F.col("n") <= WALK, F.lit(False)))
    sirs = sirs.withColumn("_unit", F.when(F.col("_near"), F.coalesce(capitals, F.lit(False)))).withColumn("_closing", F.when(F.col("_near"), F.coalesce(F.col("_t").rlike(CLOSING), F.lit(False)))).withColumn("_role", F.when(F.col("_near"), role))
    sirs = sirs.withColumn("_above", above).where("_top")
    # upwards until prose; then down again past the last closing formula and the signature lines right after it
    last = lambda xs: F.get(xs, F.size(xs) - 1)["n"]
    climbed = F.coalesce(last(F.filter("_above", lambda x: x["_role"] == "prose")) + 1, F.get("_above", F.lit(0))["n"], F.col("n"))
    sirs = sirs.withColumn("_block", F.filter("_above", lambda x: x["n"] >= climbed)).withColumn("_formula", last(F.filter("_block", lambda x: x["_closing"])))
    after = F.filter("_block", lambda x: (x["n"] > F.col("_formula")) & x["_role"].isin("blank", "unit"))
    start = F.when(F.col("_formula").isNotNull(), F.coalesce(F.get(after, F.lit(0))["n"], F.col("n"))).otherwise(F.coalesce(F.get("_block", F.lit(0))["n"], F.col("n")))
    sirs = sirs.withColumn("_start", start)
    unit = F.filter("_block", lambda x: (x["n"] >= F.col("_start")) & F.when(F.col("_formula").isNull(), x["_role"] == "unit").otherwise(x["_unit"]))
    tops = F.filter("_block", lambda x: (x["n"] >= F.col("_start")) & (x["_role"] != "blank"))
    heading = F.rtrim(F.coalesce(F.get(unit, F.lit(0))["_t"], F.get(tops, F.lit(0))["_t"], F.col("_t")), F.lit(".,"))
    letters = sirs.select("doc_id", F.col("_start").alias("n"), F.lit(0).alias("_p"), F.lit("agency_letter").alias("kind"), F.when(heading == "", "letter").otherwise(heading).alias("heading"))
    # the other anchors, told line by line, and what opens a volume, each found by the line of the one before
    caption = F.regexp_extract("line", CAPTION, 1)
    big = F.length("_t").between(4, 71) & F.col("_t").rlike(HEADING)
    plain = ~F.col("_t").rlike(PROVINCE) & ~F.col("_t").rlike(r"^PART [IVX]+\.?\s*$") & ~F.startswith("_t", F.lit("TABLE")) & ~F.col("_t").rlike(CAPTION) & F.size(F.split("_t", r"\s+")).between(2, 10)
    told = lines.select("doc_id", "n", "line", trimmed.alias("_t"), *report).withColumn("_sir", sir)
    told = told.withColumns({"_caption": F.when(caption != "", caption), "_big": big, "_blank": F.col("_t") == "", "_pres": F.col("line").rlike(PRESENTATION), "_cont": F.col("line").rlike(CONTENTS), "_long": F.length("_t") > PROSE})
    told = told.withColumn("_heading", F.when(F.col("_big") & plain, F.rtrim("_t", F.lit(".,")))).drop("line", "_t")
    alone = F.coalesce(F.lag("_blank").over(w), F.lit(True)) & F.coalesce(~F.lead("_big").over(w), F.lit(True))
    first = lambda fits: F.min(F.when(fits, F.col("n"))).over(doc)
    told = told.withColumn("_letters", letters_here).withColumn("_alone", alone).withColumn("_to", first(F.col("_pres")))
    told = told.withColumn("_list", first(F.col("_cont") & (F.col("_to").isNull() | (F.col("n") > F.col("_to")))))
    told = told.withColumn("_head", first(F.col("_long") & (F.col("n") > F.col("_list"))))
    kind = F.when(F.contains("_caption", F.lit("STATEMENT")), "tabular_statement").when(F.startswith("_caption", F.lit("RETURN")), "return").otherwise("appendix")
    found = [
        (F.col("_caption").isNotNull(), 0, kind, F.rtrim(F.trim("_caption"), F.lit("."))), (~F.col("_letters") & F.col("_alone") & F.col("_heading").isNotNull(), 0, F.lit("thematic_section"), F.col("_heading")),
        (F.col("n") == F.col("_head"), 1, F.lit("head_report"), F.lit("Report of the Department")), (F.col("n") == F.col("_list"), 2, F.lit("contents"), F.lit("Contents")),
        (F.col("n") == F.col("_to"), 3, F.lit("presentation_letter"), F.lit("Presentation letter")), ((F.col("n") == 0) & F.col("_to").isNotNull(), 4, F.lit("title_page"), F.lit("Title page")),
    ]
    some = F.array_compact(F.array(*[F.when(fits, F.struct(F.lit(p).alias("_p"), k.alias("kind"), h.alias("heading"))) for fits, p, k, h in found]))
    every = letters.unionByName(told.select("doc_id", "n", F.inline(some)))
    every = every.groupBy("doc_id", "n").agg(F.min(F.struct("_p", "kind", "heading")).alias("_a")).select("doc_id", "n", "_a.*")
    body = F.min(F.when(F.col("_p") == 0, F.col("n"))).over(doc)
    return every.withColumn("_body", body).where("_p <> 1 or n < _body").select("doc_id", "n", "kind", "heading")


def segmented(docs: DataFrame, text: str = "text") -> DataFrame:
    """The segments of each text: ``doc_id, doc_type, segment_id, ordinal, kind, heading, province, page_start, page_end, char_start, char_end, text_version``.

    Front matter is taken off first: offsets are those of the body, and ``doc_type`` is what it names, else an annual report.
    A segment under 40 characters is left out.  One of over 150,000 is cut in ``_parts``.  A page is that of the last mark at or before a
    place, of the first one before any, and 1 without marks.  The province is that of a line in the segment's first 1,200 characters, else
    of the last such line before it.  Equal ids of a text are told apart in order by -2, -3, ...
    """
    head = F.regexp_extract(text, FRONT, 0)
    said = F.regexp_extract(head, KIND, 1)
    docs = docs.select("doc_id", F.when(said == "", REPORT).otherwise(said).alias("doc_type"), F.when(head == "", F.col(text)).otherwise(F.substr(text, F.length(head) + 1)).alias("_text"))
    mark = PAGE[1:]
    between, found = F.split("line", mark), F.regexp_extract_all("line", F.lit(mark), F.lit(0))
    offset = lambda i: F.aggregate(F.slice(between, 1, i + 1), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(F.slice(found, 1, i), F.lit(0), lambda n, x: n + F.length(x))
    marks = F.transform(F.regexp_extract_all("line", F.lit(mark), F.lit(1)), lambda x, i: F.struct((F.col("char_start") + offset(i)).alias("at"), x.try_cast("int").alias("page")))
    lines = cut(volume_lines(docs, "_text", "doc_type").withColumn("_marks", F.when(F.contains("line", F.lit("<!-- page ")), marks)))  # read many times below
    w = Window.partitionBy("doc_id").orderBy("char_start")
    # from here on anchors, ends of texts and the lines with page marks or provinces, not texts
    prov, sub, none = F.regexp_extract(F.trim("line", F.lit(SPACES)), PROVINCE, 1), F.regexp_extract("line", SUBHEAD, 1), F.lit(None)
    begun = anchors(lines).join(lines.select("doc_id", "n", "char_start", "doc_type"), ["doc_id", "n"]).drop("n")
    ends = lines.groupBy("doc_id").agg(F.max(F.col("char_start") + F.length("line")).alias("char_start"))
    heads = F.when(F.col("line").rlike(rf"^(?:PROVINCE OF )?({PROVINCES})"), F.substring("line", 1, OPENING))
    noted = lines.select("doc_id", "char_start", F.when(prov != "", prov).alias("_prov"), F.when(sub != "", sub).alias("_sub"), heads.alias("_line"), "_marks").where("coalesce(_prov, _sub, _line) is not null or _marks is not null")
    told = cut(begun.unionByName(ends, True).unionByName(noted, True))
    spans = told.where("_prov is null and _sub is null and _line is null and _marks is null").withColumn("char_end", F.lead("char_start").over(w)).where(F.col("kind").isNotNull() & (F.col("char_end") - F.col("char_start") >= SLIVER))
    spans = spans.select("doc_id", "doc_type", "char_start", "char_end", "kind", "heading")
    marks = told.where("_marks is not null").select("doc_id", F.inline("_marks")).where("page is not null")
    least = spans.select("doc_id").distinct().join(marks.groupBy("doc_id").agg(F.min_by("page", "at").alias("page")), "doc_id", "left")
    marks = marks.unionByName(least.select("doc_id", F.lit(-1).cast("long").alias("at"), F.coalesce("page", F.lit(1)).alias("page")))
    subheads = told.where("_sub is not null").select("doc_id", F.col("char_start").alias("at"), F.col("_sub").alias("prov"))
    size = F.col("char_end") - F.col("char_start")
    whole = spans.where(size <= LARGE).unionByName(_parts(spans.where(size > LARGE), marks, subheads))
    # pages of both ends and the province before, in one order of places
    here = F.struct(*whole.columns)
    events = [
        marks.select("doc_id", "at", F.lit(0).alias("_o"), "page", none.cast("string").alias("_prov"), none.alias("_s"), none.cast("boolean").alias("_end")),
        told.where("_prov is not null").select("doc_id", F.col("char_start").alias("at"), F.lit(1), none.cast("int"), "_prov", none, none.cast("boolean")),
        whole.select("doc_id", F.explode(F.array(F.struct(F.col("char_start").alias("at"), F.lit(False).alias("_end")), F.struct(F.greatest("char_start", F.col("char_end") - 1).alias("at"), F.lit(True).alias("_end")))).alias("_e"), here.alias("_s")).select("doc_id", "_e.at", F.lit(2), none.cast("int"), none.cast("string"), "_s", "_e._end"),
    ]
    before = Window.partitionBy("doc_id").orderBy("at", "_o").rowsBetween(Window.unboundedPreceding, 0)
    placed = events[2].toDF(*events[0].columns).unionByName(events[0]).union(events[1])
    placed = placed.withColumn("page", F.last("page", True).over(before)).withColumn("_prov", F.last("_prov", True).over(before)).where("_o = 2")
    side = lambda c, end: F.max(F.when(F.col("_end") == end, F.col(c)))
    placed = placed.groupBy("doc_id", F.col("_s.char_start").alias("char_start")).agg(F.first("_s").alias("_s"), side("page", False).alias("page_start"), side("page", True).alias("page_end"), side("_prov", False).alias("_ctx"))
    out = placed.select("_s.*", "page_start", "page_end", "_ctx")
    # a province within the opening; a line that the opening breaks off ends there
    bucket = F.floor(F.col("char_start") / OPENING)
    near = out.select("doc_id", "char_start", "char_end", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"))
    heads = told.where("_line is not null").select("doc_id", F.col("char_start").alias("at"), F.col("_line").alias("line"), bucket.alias("_bucket"))
    left = F.least(F.col("char_start") + OPENING, F.col("char_end")) - F.col("at")
    opening = near.join(heads, ["doc_id", "_bucket"]).where((F.col("at") >= F.col("char_start")) & (left > 0)).withColumn("_own", F.regexp_extract(F.substr("line", F.lit(1), left.cast("int")), PROVINCE, 1))
    opening = opening.where("_own <> ''").groupBy("doc_id", "char_start").agg(F.min_by("_own", "at").alias("_own"))
    out = out.join(opening, ["doc_id", "char_start"], "left").withColumn("province", F.coalesce("_own", "_ctx")).withColumn("ordinal", F.row_number().over(w) - 1)
    ascii_ = F.regexp_replace(fold("heading"), r"[^\x00-\x7f]", "")
    out = _numbered(out.withColumn("_base", F.concat(F.format_string("p%04d-", "page_start"), slug(ascii_)))).join(docs.select("doc_id", "_text"), "doc_id")
    version = text_version(F.substr("_text", (F.col("char_start") + 1).cast("int"), (F.col("char_end") - F.col("char_start")).cast("int")))
    return out.select("doc_id", "doc_type", "segment_id", "ordinal", "kind", "heading", "province", "page_start", "page_end", "char_start", "char_end", version.alias("text_version"))


def _parts(large: DataFrame, marks: DataFrame, subheads: DataFrame) -> DataFrame:
    """The parts of large segments, cut at province lines more than 500 characters apart.

    Where more than 60 pages lie between two of these, the first page mark 60 pages on from the last cut is one too, and so on.  Each
    segment is one array of its own marks and provinces, gone through once.
    """
    none, some = F.lit(None), large.select("doc_id").distinct()
    span = F.struct("char_start", "char_end", "doc_type", "kind", "heading").alias("_s")
    events = marks.join(some, "doc_id", "left_semi").select("doc_id", "at", F.lit(0).alias("_o"), "page", none.cast("string").alias("prov"), none.alias("_s"), none.cast("long").alias("_of"))
    edges = F.explode(F.array(F.struct(F.col("char_end").alias("at"), F.lit(1).alias("_o")), F.struct(F.col("char_start").alias("at"), F.lit(2).alias("_o")))).alias("_e")
    spans = large.select("doc_id", edges, span, F.col("char_start").alias("_of")).select("doc_id", "_e.at", "_e._o", none.cast("int").alias("page"), none.cast("string").alias("prov"), "_s", "_of")
    events = spans.unionByName(events).unionByName(subheads.join(some, "doc_id", "left_semi").select("doc_id", "at", F.lit(3).alias("_o"), none.cast("int").alias("page"), "prov", none.alias("_s"), none.cast("long").alias("_of")))
    before = Window.partitionBy("doc_id").orderBy("at", "_o").rowsBetween(Window.unboundedPreceding, 0)
    events = events.withColumn("_i", F.count("page").over(before)).withColumn("page", F.last("page", True).over(before)).withColumn("_at", F.last(F.when(F.col("_o") == 2, F.col("_s")), True).over(before))
    # what lies in a segment, and its own end, which stands before the next one's start
    events = events.withColumn("_s", F.when(F.col("_o") == 1, F.col("_s")).otherwise(F.col("_at"))).where("_s is not null and (_o = 1 or at < _s.char_end)")
    place = lambda fits: F.array_sort(F.collect_list(F.when(fits, F.struct("at", "page", "_i", "prov"))))
    start = F.col("at") == F.col("_s.char_start")
    far = (F.col("_o") == 1) | ((F.col("_o") == 3) & (F.col("at") - F.col("_s.char_start") > APART))
    listed = events.groupBy("doc_id", F.col("_s.char_start").alias("char_start")).agg(
        F.first("_s").alias("_s"), place(F.col("_o") == 0).alias("_marks"), place(far).alias("_ends"), F.max(F.when((F.col("_o") == 2) & start, F.struct("at", "page", "_i"))).alias("_first"), F.max(F.when((F.col("_o") == 3) & start, F.col("prov"))).alias("_own")
    )
    state = lambda at, page, i, cuts: F.struct(at.alias("at"), page.alias("page"), i.alias("i"), cuts.alias("cuts"))
    one = lambda at, prov: F.array(F.struct(at.alias("at"), prov.alias("prov")))

    def upto(s, c):
        """Cuts at page marks between the last cut and ``c``, and at ``c`` if it is no end."""
        between = F.slice("_marks", s["i"] - F.col("_first._i") + 1, F.greatest(c["_i"] - s["i"], F.lit(0)))
        turn = lambda x, m: F.when((c["page"] - x["page"] > PAGES) & (m["page"] - x["page"] >= PAGES), state(m["at"], m["page"], m["_i"], F.concat(x["cuts"], one(m["at"], none.cast("string"))))).otherwise(x)
        paged = F.aggregate(between, s, turn)
        return F.transform(F.array(paged), lambda x: F.when(c["prov"].isNotNull() & (c["at"] - x["at"] > APART), state(c["at"], c["page"], c["_i"], F.concat(x["cuts"], one(c["at"], c["prov"])))).otherwise(x))[0]

    cuts = F.aggregate("_ends", state(F.col("_first.at"), F.col("_first.page"), F.col("_first._i"), one(F.col("_first.at"), F.col("_own"))), upto, lambda s: s["cuts"])
    parts = listed.withColumn("_cuts", cuts).select("doc_id", "_s", F.size("_cuts").alias("_n"), F.posexplode("_cuts").alias("_k", "_c"), F.col("_cuts").alias("_all"))
    titled = F.replace(F.initcap(F.replace("_c.prov", F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))
    heading = F.when((F.col("_n") == 1) | ((F.col("_k") == 0) & F.col("_c.prov").isNull()), F.col("_s.heading")).when(F.col("_c.prov").isNotNull(), F.concat("_s.heading", F.lit(" — "), titled)).otherwise(F.concat("_s.heading", F.lit(" (cont.)")))
    return parts.select("doc_id", "_s.doc_type", F.col("_c.at").alias("char_start"), F.coalesce(F.get("_all", F.col("_k") + 1)["at"], F.col("_s.char_end")).alias("char_end"), "_s.kind", heading.alias("heading"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``segment_id`` from ``_base``: the first of equal ids keeps it, later ones take the first of -2, -3, ... that no row before them has.

    Numbers in order do where no id reads as another with a number; those that may clash, on one page, are settled one by one.
    """
    root = ["doc_id", "_root"]
    rows = rows.withColumn("_root", F.regexp_replace("_base", "(-[0-9]+)+$", ""))
    n = F.row_number().over(Window.partitionBy("doc_id", "_base").orderBy("char_start"))
    rows = rows.withColumn("_k", n)
    among = Window.partitionBy(*root)
    rows = rows.withColumn("_clash", (F.max("_k").over(among) > 1) & (F.min("_base").over(among) != F.max("_base").over(among)))
    kind = dict(rows.dtypes)["doc_id"]

    def settled(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("char_start")
        used, next_ = set(), {}
        out = []
        for base in group["_base"]:
            name, k = base, next_.get(base, 2)
            while name in used:
                name, k = f"{base}-{k}", k + 1
            next_[base] = k
            used.add(name)
            out.append(name)
        return group[["doc_id", "char_start"]].assign(_told=out)

    told = rows.where("_clash").select(*root, "char_start", "_base").groupBy(*root).applyInPandas(settled, f"doc_id {kind}, char_start long, _told string")
    plain = F.when(F.col("_k") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.col("_k").cast("string")))
    return rows.join(told, ["doc_id", "char_start"], "left").withColumn("segment_id", F.coalesce("_told", plain)).drop("_base", "_root", "_k", "_clash", "_told")
