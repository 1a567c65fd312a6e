"""Segments of documents, gazetteer mentions, and passages around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.text import fold, slug
from quillgraph.operators.identity import non_overlapping


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row for each line that isn't blank: ``ordinal`` from 0 among all lines, and its first character's place."""
    parts = docs.select("*", F.posexplode(F.split(text, "\n")).alias("ordinal", "line"))
    starts = Window.partitionBy("doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("char_start", F.coalesce(F.sum(F.length("line") + 1).over(starts), F.lit(0)).cast("long"))
    return placed.where(F.trim("line") != "")


def segment_ids(segments: DataFrame, page: str, heading: str) -> DataFrame:
    """Ids from the page and the heading's slug; equal ones of a document are told apart by -2, -3, ... in order."""
    base = F.concat(F.lit("p"), F.lpad(F.col(page).cast("string"), 4, "0"), F.lit("-"), slug(heading))
    n = F.row_number().over(Window.partitionBy("doc_id", "_base").orderBy("ordinal"))
    return segments.withColumn("_base", base).withColumn("segment_id", F.when(n == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), n.cast("string")))).drop("_base")


def windows_of(docs: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Fixed windows of characters with an overlap: ``window``, ``char_start`` and ``chunk``; a short text gives one."""
    last = F.greatest(F.length(text) - 1, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last, F.lit(size - overlap)))
    rows = docs.select("*", starts.alias("char_start"))
    return rows.withColumn("window", (F.col("char_start") / (size - overlap)).cast("int")).withColumn("chunk", F.substr(F.col(text), F.col("char_start") + 1, F.lit(size)))


def token_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, pos, token``: the folded words of each text, in order."""
    words = F.regexp_extract_all(fold(text), F.lit("([a-z0-9]+)"), 1)
    return docs.select("doc_id", F.posexplode(words).alias("pos", "token"))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens, joined by spaces."""
    last = F.size(tokens) - n
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(n)), " ")))


#: Numbers that strings are hashed to before they are moved; as many rows at most are sent out.
SLOTS = 1 << 18


def _likely(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``rows`` without those whose ``column`` hashes to no name's number: all that are names stay, and few others."""
    slot = F.pmod(F.xxhash64(column), F.lit(SLOTS))
    held = F.broadcast(names.select(slot.alias("_slot")).distinct())
    return rows.withColumn("_slot", slot).join(held, "_slot", "left_semi").drop("_slot")


def mentions(docs: DataFrame, gazetteer: DataFrame, longest: int, also: Sequence[str] = ()) -> DataFrame:
    """``doc_id, pos, n_tokens, surface, entity_id``: where surfaces of the gazetteer stand, and columns ``also`` of their documents.

    Matches are taken from the left, the longest at each place, and none begins
    within the one before.  Each text is cut into words once; only runs whose
    first word begins a surface are built, and they meet the gazetteer by an
    equi-join, so its size doesn't matter.  Before that, words and runs whose hash
    is none of a surface's leave where they lie, so that only what is likely a
    surface is moved.  A surface of several entities gives a row for each.
    """
    words = F.regexp_extract_all(fold("text"), F.lit("([a-z0-9]+)"), 1)
    shifted = [F.col("_w"), *[F.slice("_w", n + 1, F.greatest(F.size("_w") - n, F.lit(0))) for n in range(1, longest)]]
    names = [f"_{n}" for n in range(longest)]
    zipped = F.arrays_zip(*[c.alias(n) for c, n in zip(shifted, names, strict=True)])
    rows = docs.select("doc_id", *also, words.alias("_w")).select("doc_id", *also, F.posexplode(zipped).alias("pos", "_z")).select("doc_id", *also, "pos", *[F.col("_z").getField(n).alias(n) for n in names])
    surfaces = gazetteer.select("surface").where("surface is not null").distinct()
    heads = surfaces.select(F.split("surface", " ")[0].alias("_0")).distinct()
    rows = _likely(rows, heads, "_0").join(heads, "_0", "left_semi")
    runs = F.explode(F.array(*[F.struct(F.lit(n + 1).alias("n_tokens"), F.when(F.col(names[n]).isNotNull(), F.concat_ws(" ", *names[: n + 1])).alias("surface")) for n in range(longest)]))
    hits = rows.select("doc_id", *also, "pos", runs.alias("_r")).select("doc_id", *also, "pos", "_r.*")
    hits = _likely(hits, surfaces, "surface").join(surfaces, "surface", "left_semi")
    carried = F.struct("surface", *also).alias("_x")
    hits = hits.select("doc_id", F.col("pos").alias("_s"), (F.col("pos") + F.col("n_tokens")).alias("_e"), carried)
    kept = non_overlapping(hits, "doc_id", "_s", "_e", "_x").select("doc_id", "_s", "_e", "_x.*")
    return kept.join(gazetteer, "surface").select("doc_id", F.col("_s").alias("pos"), (F.col("_e") - F.col("_s")).alias("n_tokens"), "surface", "entity_id", *also)


def confidence(cue: Column, n_tokens: Column, candidates: Column, in_table: Column, region_known: Column) -> Column:
    """high, medium or low for a mention; several candidates are ``residual``.

    Without a known region a high or low one counts as medium, and a medium one as low.
    """
    level = F.when(cue & (n_tokens > 1), "high").when(~cue & in_table, "low").otherwise("medium")
    unknown = F.when(level == "medium", "low").otherwise("medium")
    return F.when(candidates > 1, "residual").when(region_known, level).otherwise(unknown)


def passage(text: Column, start: Column, length: Column, around: int = 40) -> Column:
    """The text around a place, white space one space, with dots where it was cut."""
    low = F.greatest(start - around, F.lit(0))
    part = F.trim(F.regexp_replace(F.substr(text, low + 1, start - low + length + around), r"\s+", " "))
    return F.concat(F.when(low > 0, "…").otherwise(""), part, F.when(start + length + around < F.length(text), "…").otherwise(""))


def marked_up(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Brackets around stand-off spans, put in from the right so that places stay true."""
    for start, end, name in sorted(spans, reverse=True):
        text = f"{text[:start]}[{text[start:end]}]({name}){text[end:]}"
    return text
