"""What running text states: signatures and who signed, doubtful mentions and their decisions, stock sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.segmentation import volume_lines

# Fixed forms of printed signatures and of the stock sentence.
SIGNER = r"^\s*([A-Z][A-Z.'’\- ]{3,40}),?\s*$"
OFFICE = r"^\s*(?:Indian\s+)?(Agent|Acting Agent|Indian Superintendent|Superintendent|Inspector|Farmer in charge|Agent and Clerk)\.?\s*$"
COUNTS = r"(?i)number of children of school age,?\s*(\d[\d,]*)[;.,]?\s*number of pupils enrolled(?: at day schools?)?,?\s*(\d[\d,]*)[;.,]?\s*average attendance(?: at day schools?)?,?\s*(\d[\d,]*)"
ATTENDING = r"(?i)number attending ([^,;]{3,80}?),?\s*(\d[\d,]*)"
#: What stands before an entry, and what ends it.
PRINTED_UNIT = r"(?is)(?:<a [^>]*>|<b>)([^<]{3,80})</(?:a|b)>\.?\s*$"
ENTRY = r"(?is)^(.{0,900}?)(?:The Indian agent|The agent|Indian agent|reports on the|$)"
BAND_WORDS = r"(?i)\bband\b|people|tribe|nation"


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, char_start, name, surname, initial, office``: lines of capitals above a line that is an office."""
    w = Window.partitionBy("doc_id").orderBy("n")
    rows = volume_lines(docs, text).withColumn("_next", F.lead("line").over(w)).where(F.col("line").rlike(SIGNER) & F.col("_next").rlike(OFFICE))
    name = F.trim(F.regexp_extract("line", SIGNER, 1), F.lit(" ,."))
    words = F.split(F.col("name"), r"\s+")
    out = rows.withColumn("name", name).withColumn("office", F.regexp_extract("_next", OFFICE, 1))
    surname = F.trim(F.element_at(words, -1), F.lit(".,'"))
    initial = F.when(F.size(words) > 1, F.regexp_extract("name", "([A-Z])", 1)).otherwise("")
    return out.select("doc_id", (F.col("char_start") + F.instr("line", F.regexp_extract("line", "([A-Z])", 1)) - 1).alias("char_start"), "name", surname.alias("surname"), initial.alias("initial"), "office")


def signed(found: DataFrame, agents: DataFrame, window: int = 2) -> DataFrame:
    """Add ``fate, person, candidates`` to signatures with a ``year``.

    ``agents``: ``agent, surname, initial, year``; a null year fits every year, an
    empty initial every initial.  One agent within ``window`` years is a link,
    several are left to be decided, none mints a person: names of equal letters are one,
    by the slug of the first of them in order of document and place.
    """
    a = agents.select("agent", "surname", F.col("initial").alias("_i"), F.col("year").alias("_y"))
    hits = found.join(a, "surname").where("(_y is null or abs(_y - year) <= %d) and (initial = '' or coalesce(_i, '') = '' or initial = _i)" % window)
    who = hits.groupBy("doc_id", "char_start").agg(F.array_sort(F.collect_set("agent")).alias("candidates"))
    rows = found.join(who, ["doc_id", "char_start"], "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))
    n = F.size("candidates")
    fate = F.when(n == 1, "link").when(n > 1, "residual").otherwise("mint")
    rows = rows.withColumn("_letters", F.when(n == 0, F.regexp_replace(F.upper("name"), "[^A-Z]", "")))
    first = rows.where("_letters is not null").groupBy("_letters").agg(F.min(F.struct("doc_id", "char_start", "name")).alias("_f"))
    rows = rows.join(first, "_letters", "left")
    minted = F.concat(F.lit("PERSON-"), F.trim(F.regexp_replace(F.lower("_f.name"), "[^a-z0-9]+", "-"), F.lit("-")))
    return rows.withColumn("fate", fate).withColumn("person", F.when(n == 1, F.get("candidates", F.lit(0))).when(n == 0, minted)).drop("_letters", "_f")


def minted_people(rows: DataFrame) -> DataFrame:
    """``person, name, first_year, last_year, n_signatures`` of the people minted by ``signed``."""
    return rows.where("fate = 'mint'").groupBy("person").agg(F.min("name").alias("name"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("n_signatures"))


def in_context(spans: DataFrame, docs: DataFrame, reach: int = 350) -> DataFrame:
    """Add ``context`` to spans (``doc_id, char_start, char_end``): the text around each, white space as one space, the span in double brackets."""
    rows = spans.join(docs.select("doc_id", F.col("text").alias("_t")), "doc_id")
    at, end = F.col("char_start").cast("int"), F.col("char_end").cast("int")
    before = F.substr("_t", F.greatest(at - reach, F.lit(0)) + 1, at - F.greatest(at - reach, F.lit(0)))
    raw = F.concat(before, F.lit("[["), F.substr("_t", at + 1, end - at), F.lit("]]"), F.substr("_t", end + 1, F.lit(reach)))
    return rows.withColumn("context", F.trim(F.regexp_replace(raw, r"\s+", " "))).drop("_t")


def decided(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """``item, choice, confidence, fate`` of the decisions on doubtful mentions.

    ``items``: ``item, candidates`` (``type:id``); ``decisions``: ``item, choice,
    confidence, reason``.  A bare id takes the type of the candidate that it is the id of.  Fates: ``linked``; ``unverified`` (of low confidence,
    applied all the same); ``none``; ``band_not_offered`` (none, but the reason
    speaks of a band, and none was offered); ``unoffered``; ``orphan`` (of no item).
    """
    rows = decisions.join(items, "item", "left")
    bare = F.trim(F.coalesce("choice", F.lit("none")))
    typed = F.get(F.filter("candidates", lambda c: F.endswith(c, F.concat(F.lit(":"), F.col("_bare")))), F.lit(0))
    rows = rows.withColumn("_bare", bare).withColumn("_c", F.when(F.contains("_bare", F.lit(":")), F.col("_bare")).otherwise(F.coalesce(typed, "_bare")))
    confidence = F.when(F.col("confidence").isin("high", "medium", "low"), F.col("confidence")).otherwise("low")
    gap = F.coalesce("reason", F.lit("")).rlike(BAND_WORDS) & ~F.exists("candidates", lambda c: F.startswith(c, F.lit("band:")))
    fate = F.when(F.col("candidates").isNull(), "orphan").when(F.lower("_c") == "none", F.when(gap, "band_not_offered").otherwise("none")).when(~F.array_contains("candidates", F.col("_c")), "unoffered").when(confidence == "low", "unverified").otherwise("linked")
    return rows.select("item", F.col("_c").alias("choice"), confidence.alias("confidence"), fate.alias("fate"))


def school_sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, entry, unit, school_age, enrolled, attendance, elsewhere, schools, plausible`` of every stock sentence of each text.

    ``entry`` numbers a text's sentences from 0; ``unit`` is the marked-up name right before one, else empty.  An entry
    goes on to the words that end it, the next sentence, or 900 characters: ``elsewhere`` adds
    the pupils of the schools named there, which are ``schools`` (``name number; ...``), without markup.  Null
    texts and those without the sentence give no row.  A row is plausible if enrolment is at most 1.3 of the school
    age, attendance 1.2 of the enrolment, and pupils elsewhere the school age.
    """
    number = lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("long")
    around = F.split(text, COUNTS)
    hits = F.transform(F.regexp_extract_all(text, F.lit(COUNTS), 0), lambda h, i: F.struct(h.alias("said"), F.get(around, i).alias("before"), F.get(around, i + 1).alias("after")))
    rows = docs.select("doc_id", F.posexplode(hits).alias("entry", "_e")).select("doc_id", "entry", "_e.*")
    rest = F.regexp_extract(F.substr("after", F.lit(1), F.lit(2000)), ENTRY, 1)
    tail = F.regexp_replace(F.when(rest == "", F.when(F.col("after").rlike(ENTRY), "").otherwise(F.substr("after", F.lit(1), F.lit(900)))).otherwise(rest), "<[^>]+>", "")
    rows = rows.withColumn("_tail", tail).withColumn("_n", F.regexp_extract_all("_tail", F.lit(ATTENDING), 1)).withColumn("_v", F.regexp_extract_all("_tail", F.lit(ATTENDING), 2))
    out = rows.select("doc_id", "entry", F.trim(F.regexp_extract("before", PRINTED_UNIT, 1)).alias("unit"), *[number(F.regexp_extract("said", COUNTS, i)).alias(c) for i, c in ((1, "school_age"), (2, "enrolled"), (3, "attendance"))], "_n", "_v")
    out = out.withColumn("elsewhere", F.aggregate("_v", F.lit(0).cast("long"), lambda s, v: s + F.coalesce(number(v), F.lit(0))))
    out = out.withColumn("schools", F.array_join(F.zip_with("_n", "_v", lambda a, b: F.concat(F.trim(a), F.lit(" "), F.regexp_replace(b, "[^0-9]", ""))), "; "))
    ok = (F.col("school_age") > 0) & (F.col("enrolled") <= 1.3 * F.col("school_age")) & (F.col("attendance") <= 1.2 * F.col("enrolled")) & (F.col("elsewhere") <= F.col("school_age"))
    return out.withColumn("plausible", F.coalesce(ok, F.lit(False))).drop("_n", "_v")


def dateline_candidates(line: Column) -> Column:
    """What a place line may name: its pieces between commas, semicolons or wide gaps, then two and three neighbours joined."""
    pieces = F.filter(F.transform(F.split(line, r"[,;]|\s{2,}"), lambda p: F.trim(p, F.lit(" ."))), lambda p: p != "")

    def joined(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(pieces) - n + 1, F.lit(1))), lambda i: F.when(i + n - 1 <= F.size(pieces), F.array_join(F.slice(pieces, i, F.lit(n)), ", ")))
        return F.filter(runs, lambda x: x.isNotNull())

    return F.concat(pieces, joined(2), joined(3))


def harvested(docs: DataFrame, patterns: Sequence[tuple[str, str]], least: int = 100, text: str = "text") -> DataFrame:
    """``doc_id, kind, units, enrolled, attendance, note``: the figures of a bank of patterns, each text's distinct ones.

    ``patterns``: kind and an expression of three groups, units, enrolment and
    attendance, of which the last may stay empty.  Enrolments under ``least`` are
    left out.  ``note``: ``point_in_time`` where the 200 characters before (after the
    figure before), or the figure, say "on June 30" or "on March 31"; ``retrospective`` where they speak
    of years ago or another fiscal year.
    """
    number = lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("long")
    out = None
    for kind, pattern in patterns:
        between = F.transform(F.split(text, pattern), lambda x: F.right(x, F.lit(200)))
        pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), 0), between, lambda h, x: F.struct(h.alias("hit"), x.alias("before")))
        hits = docs.where(F.col(text).rlike(pattern)).select("doc_id", F.explode(pairs).alias("_p")).select("doc_id", F.col("_p.hit").alias("_hit"), F.concat("_p.before", "_p.hit").alias("_said")).where("_hit is not null")
        found = [number(F.regexp_extract("_hit", pattern, i)).alias(c) for i, c in ((1, "units"), (2, "enrolled"), (3, "attendance"))]
        rows = hits.select("doc_id", F.lit(kind).alias("kind"), *found, "_said")
        out = rows if out is None else out.union(rows)
    note = F.when(F.col("_said").rlike(r"(?i)on (June|March) 3[01]"), "point_in_time").when(F.col("_said").rlike(r"(?i)(five|ten) years ago|fiscal year 19\d\d\s*-"), "retrospective").otherwise("")
    return out.where(F.col("enrolled") >= least).select("doc_id", "kind", "units", "enrolled", "attendance", note.alias("note")).distinct()
