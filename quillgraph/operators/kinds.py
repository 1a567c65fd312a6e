"""What a registry's identities are: agencies, schools, staff, accounts and lines that are none of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.names import persons
from quillgraph.functions.similarity import person_score
from quillgraph.operators.lineage import cut

# Fixed forms of the printed rows.
LEDGER = r"(?i)\bno\.?\s*\d+\b.*\bband\b"
SCHOOL = r"(?i)\b(school|schools|institute|institution|home|academy)\b"
APPROPRIATION = (
    r"(?i)\b(repairs?|grant|grants|salar(y|ies)|relief|supplies|expenses?|annuit(y|ies)|surveys?|commutation|interest|contingenc(y|ies)|payments?|purchase|"
    r"construction|maintenance|travelling|medical attendance|implements|seed|provisions|clothing|rations|tools)\b"
)
WORKS = r"(?i)^(cleansing|destroying|spraying|clearing|building|erecting)\b"
OFFICER = r"(?i),\s*([A-Z][A-Za-z.'\- ]{2,40}?),?\s*(agent|agt\.?|inspector|insp\.?|superintendent|supt\.?|clerk|farmer|instructor|missionary)\.?\s*$"
PLACE = (
    r"(?i)\b(agency|agencies|ag'cy|agt|superintendency|inspectorate|district|county|counties|co\.|reserve|reserves|band|bands|treaty|tr'ty|island|lake|river|bay|creek|"
    r"mountain|point|portage|fort|ft\.|mission|indians|nation|nations|division|micmacs?|chippewas?|crees?|saulteaux|ojibb?ewas?|sioux|iroquois|abenakis?|"
    r"hurons?|mohawks?|algonquins?|montagnais|of|at|and|&|mainland|coast|settlement|village|no\.)\b"
)
TITLED = r"(?i)^(mrs|miss|mr|rev|drs?|madame|mme|mlle)\b\.?|\b(m\.?d\.?|d\.?l\.?s\.?)\s*$"
UNIT, OFFICE = r"(?i)\b(agency|county|district)\b", r"(?i)\b(agency|ag'cy|superintendency|county|district)\b"


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def keys(surnames: Column) -> Column:
    """What two surnames that are like enough share: a spelling, or its first four letters, or its consonants after the first letter."""
    thin = lambda v: F.concat(F.lit("*"), F.substring(v, 1, 1), F.regexp_replace(F.substr(v, F.lit(2)), "[aeiouy]", ""))
    return F.array_distinct(F.flatten(F.transform(surnames, lambda v: F.array(v, F.concat(F.lit("^"), F.substring(v, 1, 4)), thin(v)))))


def known_people(names: DataFrame, known: DataFrame, least: float = 0.9) -> DataFrame:
    """The distinct ``name`` of ``names`` that score ``least`` or more with a ``name`` of ``known``; both are parsed names once each.

    They meet at the spellings, the beginnings and the consonants of their surnames.
    """
    sides = []
    for frame, side in ((names, "a"), (known, "b")):
        parsed = cut(persons(frame.select("name").where("name is not null").distinct(), "name")).where("surnames <> ''")
        lists = parsed.select(F.col("name").alias(f"{side}_name"), F.split("surnames", r"\|").alias(f"{side}_s"), F.col("initials").alias(f"{side}_i"), F.filter(F.split("given", r"\|"), lambda g: g != "").alias(f"{side}_g"))
        sides.append(lists.withColumn("_k", F.explode(keys(F.col(f"{side}_s")))))
    met = sides[0].join(sides[1], "_k").drop("_k").dropDuplicates(["a_name", "b_name"])
    score = person_score(F.col("a_s"), F.col("b_s"), F.col("a_i"), F.col("b_i"), F.col("a_g"), F.col("b_g"))
    return met.where(score >= least - 1e-12).select(F.col("a_name").alias("name")).distinct()


def identity_kinds(rows: DataFrame, name: str, known: DataFrame) -> DataFrame:
    """Add ``kind`` and ``unit`` to printed identities, by the first rule that fits.

    Kinds: ``ledger_person``, ``school``, ``appropriation``, ``band_row``, ``agency``, ``staff`` and
    ``other`` (empty or null).  ``unit`` is the agency or band before an officer's name.
    ``known``: ``name``s of people attested elsewhere; a bare name is staff only if it is one of theirs, one that is turned
    by a comma or has a title is staff by itself.
    """
    n = F.trim(F.coalesce(F.col(name), F.lit("")))
    tail = F.when(F.contains("_n", F.lit(",")), F.regexp_extract("_n", r"(?s)^[^,]*,(.*)$", 1))
    names = rows.select(n.alias("_n")).distinct().withColumn("_tail", tail)
    behind = persons(names, "_tail").select("_n", F.col("initials").alias("_tail_initials"))
    named = cut(persons(behind, "_n"))
    shaped = known_people(named.where("initials <> ''").select(F.col("_n").alias("name")), known).select(F.col("name").alias("_n"), F.lit(True).alias("_known"))
    told = named.join(shaped, "_n", "left")
    x = F.col("_n")
    head = F.trim(F.regexp_replace(x, OFFICER, ""), F.lit(" ,."))
    before = F.trim(F.regexp_extract(x, r"(?s)^([^,]*),", 1), F.lit(" ,."))
    bare = F.size(_words(F.regexp_replace(x, PLACE, " "))) < F.size(_words(x))
    size = F.size(_words(F.regexp_replace(x, "[^A-Za-z' ]", " ")))
    by_itself = x.rlike(TITLED) | (x.contains(",") & (F.col("initials") != ""))
    fate = lambda kind, unit=None: F.struct(F.lit(kind).alias("kind"), (F.lit("") if unit is None else unit).alias("unit"))
    rules = [
        (x == "", fate("other")), (x.rlike(LEDGER), fate("ledger_person")), (x.rlike(SCHOOL), fate("school")), ((x.rlike(APPROPRIATION) & ~x.rlike(UNIT)) | x.rlike(WORKS), fate("appropriation")),
        (x.rlike(OFFICER) & head.rlike(r"(?i)\bno\.?\s*\d+|\bband\b"), fate("band_row", head)), (x.rlike(OFFICER), fate("agency", head)),
        (x.contains(",") & before.rlike(OFFICE) & (F.coalesce("_tail_initials", F.lit("")) != ""), fate("agency", before)), (x.rlike(PLACE) & bare, fate("agency")),
        ((F.col("surnames") == "") | (size < 2) | (size > 5), fate("agency")), (by_itself | F.coalesce("_known", F.lit(False)), fate("staff")),
    ]
    pick = fate("agency")
    for fits, kind in reversed(rules):
        pick = F.when(fits, kind).otherwise(pick)
    return rows.withColumn("_n", n).join(told.select("_n", pick.alias("_k")), "_n").select(*rows.columns, "_k.kind", "_k.unit")
