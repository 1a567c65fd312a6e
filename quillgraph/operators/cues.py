"""What a mention is, by the words around it: cues within some characters, guards, and candidates narrowed step by step."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quillgraph.functions.text import fold
from quillgraph.operators.lineage import cut

#: Cue words and the type that each speaks for (fixed values).
CUES = (("agenc(?:y|ies)|superintendency|inspectorate", "agency"), (r"reserves?|i\.? ?r\.?|no\.", "reserve"), ("bands?|indians|tribes?", "band"))
#: Surfaces that are never a mention, and provinces that are never the agency called after them (fixed values).
STOP = "HOPE YORK KENT VICTORIA DOUGLAS GRAVE-YARD GRAVEYARD FISHERY TIMBER ISLAND CREEK LAKE RIVER BAY POINT TOWN MISSION SCHOOL CHURCH MOUNTAIN".split()
NO_AGENCY = (
    "BRITISH COLUMBIA", "MANITOBA", "ONTARIO", "QUEBEC", "ALBERTA", "SASKATCHEWAN", "NOVA SCOTIA", "NEW BRUNSWICK", "PRINCE EDWARD ISLAND",
    "NORTH-WEST TERRITORIES", "NORTHWEST TERRITORIES", "NORTH WEST TERRITORIES", "N.W.T.", "N.W.T", "YUKON", "YUKON TERRITORY", "CANADA", "DOMINION", "OTTAWA", "INDIAN",
)
TABLES = ("tabular_statement", "return", "appendix")
#: Characters before and after a mention of one word and of several in which its cue stands.
NEAR, FAR = (12, 25), (40, 40)


def gazetteer(names: DataFrame) -> DataFrame:
    """The surfaces (``surface, type, entity_id, context, region``) that can be mentions: four characters, three letters on end, no stop word; no province as an agency's bare name."""
    x = F.upper(F.trim(F.regexp_replace("surface", r"\s+", " ")))
    bare = (F.col("type") == "agency") & x.isin(*NO_AGENCY)
    return names.where((F.length(x) >= 4) & x.rlike("[A-Z]{3}") & ~x.isin(*STOP) & ~bare)


def placed(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, pos, n_tokens, surface, char_start, char_end, left, right, window``: where spans of words stand among a text's characters.

    ``spans``: doc_id, pos (of the first word), n_tokens, surface, as ``mentions`` gives them.  ``left`` and ``right`` are the
    characters next to a span, ``window`` the folded text around it, narrower for one word.  A text is cut into words once for all its spans.
    """
    listed = spans.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "n_tokens", "surface")).alias("_s"))
    rows = docs.select("doc_id", fold(text).alias("_t")).join(listed, "doc_id")
    rows = rows.select("doc_id", "_s", _surroundings("_t", F.transform("_s", lambda s: s["pos"].cast("int")), F.transform("_s", lambda s: s["n_tokens"].cast("int"))).alias("_p"))
    return rows.select("doc_id", F.explode(F.arrays_zip("_s", "_p")).alias("_f")).select("doc_id", "_f._s.*", "_f._p.*")


_WORD = re.compile("[a-z0-9]+")
_PLACE = StructType([StructField(n, t) for n, t in (("char_start", IntegerType()), ("char_end", IntegerType()), ("left", StringType()), ("right", StringType()), ("window", StringType()))])


#: Texts whose places a worker holds at once.
SLICE = 64


@F.arrow_udf(ArrayType(_PLACE))
def _surroundings(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Where runs of words stand in folded texts, and what is around them; Spark has no expression for the places of matches.

    A batch is gone through a few texts at a time, so a worker holds the places of these alone.
    """

    def one(t: str, pos: list[int], n: list[int]) -> list[dict[str, object]]:
        last = max(p + k for p, k in zip(pos, n, strict=True))
        at = [m.span() for m in itertools.islice(_WORD.finditer(t), int(last))]
        out = []
        for p, k in zip(pos, n, strict=True):
            a, b = at[p][0], at[p + k - 1][1]
            before, after = NEAR if k == 1 else FAR
            out.append({"char_start": a, "char_end": b, "left": t[a - 1 : a] if a else "", "right": t[b : b + 1], "window": t[max(0, a - before) : b + after]})
        return out

    place = pa.struct([(f.name, pa.int32() if isinstance(f.dataType, IntegerType) else pa.string()) for f in _PLACE])
    for batch in batches:
        for at in range(0, len(batch[0]), SLICE):
            few = [c.slice(at, SLICE).to_pylist() for c in batch]
            yield pa.array([one(t, p, n) for t, p, n in zip(*few, strict=True)], pa.list_(place))


def decided_mentions(docs: DataFrame, spans: DataFrame, names: DataFrame, cues: Sequence[tuple[str, str]] = CUES, text: str = "text") -> DataFrame:
    """``doc_id, char_start, char_end, surface, entity_type, entity_id, confidence, candidates, note`` of the mentions of each segment.

    ``docs``: doc_id, text, kind, region, agency; ``spans`` as ``mentions`` gives them; ``names``: surface, type, entity_id, context, region.
    A span right after or before a hyphen is none, nor is a single word without a cue close by.  Candidates
    are narrowed by the segment's region (agencies and those of no region stay), then by the type
    that the first cue speaks for, then by the segment's agency, each only if that leaves any.  Where the region leaves none, a
    letter's mention is left to be decided, a table's counts as low.  One candidate is a mention: ``high`` with a cue and more words than
    one, else ``medium``; ``low`` without a cue in a table; without a known region one step less for bands and
    reserves, and low is medium.  Several are ``residual``, as are all that are left to be decided; their type and id are null.
    """
    every = "|".join(p for p, _ in cues)
    held = cut(placed(docs, spans, text)).where("left <> '-' and right <> '-'")
    # a point is no word, so a cue that ends in one needs no boundary after it
    cue = F.regexp_extract("window", rf"(?i)(?<![a-z0-9_])({every})(?![a-z0-9_])", 1)
    held = held.withColumn("cue", cue).where("n_tokens > 1 or cue <> ''")
    of = names.groupBy("surface").agg(F.collect_set(F.struct("type", F.col("entity_id").cast("string").alias("id"), "context", "region")).alias("c"))  # the few entities of one name
    rows = held.join(of, "surface").join(docs.select("doc_id", "kind", "region", "agency"), "doc_id")
    kept = lambda c, test: F.when(F.exists(c, test), F.filter(c, test)).otherwise(c)
    here = lambda x: (x["type"] == "agency") | x["region"].isNull() | (x["region"] == F.col("region"))
    rows = rows.withColumn("_odd", F.col("region").isNotNull() & ~F.exists("c", here)).withColumn("c", F.when(F.col("region").isNull(), F.col("c")).otherwise(kept(F.col("c"), here)))
    rows = rows.withColumn("_open", F.col("_odd") & F.col("kind").eqNullSafe("agency_letter"))
    wanted = F.lit(None).cast("string")
    for pattern, kind in cues:
        wanted = F.when(F.col("cue").rlike(f"(?i)^(?:{pattern})$"), kind).otherwise(wanted)
    rows = rows.withColumn("_type", wanted)
    typed = F.when(F.col("_type").isNull() | F.col("_open"), F.col("c")).otherwise(kept(F.col("c"), lambda x: x["type"] == F.col("_type")))
    rows = rows.withColumn("c", typed)
    ours = F.when(F.col("agency").isNull() | F.col("_open") | (F.size("c") < 2), F.col("c")).otherwise(kept(F.col("c"), lambda x: F.coalesce(x["context"] == F.col("agency"), F.lit(False))))
    rows = rows.withColumn("c", F.array_sort(F.array_distinct(F.transform(ours, lambda x: F.struct(x["type"].alias("type"), x["id"].alias("id"))))))
    one = (F.size("c") == 1) & ~F.col("_open")
    kind, has_cue = F.col("c")[0]["type"], F.col("cue") != ""
    level = F.when(has_cue & (F.col("n_tokens") > 1), "high").when(~has_cue & F.col("kind").isin(*TABLES), "low").otherwise("medium")
    level = F.when(F.col("region").isNull() & (kind != "agency"), F.when(level == "medium", "low").otherwise("medium")).otherwise(level)
    level = F.when(F.col("_odd") & (kind != "agency"), "low").otherwise(level)
    note = F.when(F.col("_odd") & (F.col("_open") | (kind != "agency")), F.concat(F.lit("region mismatch: "), "region")).otherwise("")
    names_of = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["type"], x["id"])), "|")
    return rows.select("doc_id", "char_start", "char_end", "surface", F.when(one, kind).alias("entity_type"), F.when(one, F.col("c")[0]["id"]).alias("entity_id"), F.when(one, level).otherwise("residual").alias("confidence"), names_of.alias("candidates"), note.alias("note"))
