"""Teachers and officers: one identity for the spellings of a name in a school, and for one name across the schools of a province."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.names import persons, title_conflict, titled
from quillgraph.functions.similarity import person_score
from quillgraph.functions.text import fold
from quillgraph.operators.identity import components, grouped
from quillgraph.operators.lineage import cut

#: Occupations that are printed where a name should be (fixed values).
NO_NAMES = ("dispenser", "missionary", "constable", "teacher", "matron", "principal", "agent", "school field matron", "the missionary")


def attested(rows: DataFrame, school: str, teacher: str, province: str) -> DataFrame:
    """``school, name, key, class, role, province`` of every printed teacher; occupations, single letters and nulls are no names.

    ``key`` is the folded name with single spaces; the province is its capitals alone, so NORTH WEST is NORTHWEST.
    """
    told = rows.select(F.col(school).alias("school"), titled(teacher).alias("_t"), F.regexp_replace(F.upper(F.coalesce(F.col(province), F.lit(""))), "[^A-Z]", "").alias("province")).where("school is not null")
    told = told.select("school", F.col("_t.name").alias("name"), F.col("_t.class").alias("class"), F.col("_t.role").alias("role"), "province")
    told = told.where((F.length("name") > 1) & ~F.lower("name").isin(*NO_NAMES, "none"))
    return told.withColumn("key", F.trim(F.regexp_replace(F.regexp_replace(fold("name"), r"[^a-z',\s-]", " "), r"\s+", " "), F.lit(" ,-"))).where("key <> ''")


def nodes(attestations: DataFrame) -> DataFrame:
    """``school, key, class, surnames, initials, given``: one for each name in a school.

    Its class is that of most of its titles, so that one misprint doesn't turn it; ties to f, none is empty.
    """
    votes = attestations.where("class <> ''").groupBy("school", "key", "class").agg(F.count("*").alias("n"))
    most = votes.groupBy("school", "key").agg(F.min(F.struct((-F.col("n")).alias("n"), "class")).alias("_v")).select("school", "key", F.col("_v.class").alias("class"))
    names = cut(persons(attestations.select("key").distinct(), "key"))
    lists = [F.split(F.col(c), r"\|").alias(c) for c in ("surnames", "given")]
    parsed = names.select("key", "initials", *lists)
    return attestations.select("school", "key").distinct().join(most, ["school", "key"], "left").withColumn("class", F.coalesce("class", F.lit(""))).join(parsed, "key")


def alike(nodes: DataFrame, least: float) -> DataFrame:
    """``school, a, b`` of the names of a school that may be one person's, both ways: a score of ``least`` or more, and no titles at odds.

    The names of a school meet; each score is computed once for a pair of names, whatever the schools.
    """
    a, b = (nodes.select("school", *[F.col(c).alias(f"{side}_{c}") for c in ("key", "class", "surnames", "initials", "given")]) for side in "ab")
    met = a.join(b, "school").where((F.col("a_key") < F.col("b_key")) & ~title_conflict(F.col("a_class"), F.col("b_class")))
    names = met.select(*[f"{side}_{c}" for side in "ab" for c in ("key", "surnames", "initials", "given")]).dropDuplicates(["a_key", "b_key"])
    fit = names.where(person_score(*[F.col(f"{side}_{c}") for c in ("surnames", "initials", "given") for side in "ab"]) >= least - 1e-12).select("a_key", "b_key")
    one = met.join(fit, ["a_key", "b_key"]).select("school", F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    return one.unionByName(one.select("school", F.col("b").alias("a"), F.col("a").alias("b")))


def staff(rows: DataFrame, school: str, teacher: str, province: str, least: float = 0.90) -> DataFrame:
    """``school, key, person``: whom each printed teacher's name in a school stands for.

    In a school a name, in order of names, joins the first group of which every member is
    ``alike``.  Then one name in several schools of a province joins its first school's, unless their titles
    are at odds with that one's; these links are a star, so a common name makes no pairs.  A person is
    called by the smallest ``school/key`` of theirs.  Names of one school that aren't alike may still come together
    over another school.  An empty table gives none.
    """
    seen = cut(attested(rows, school, teacher, province))
    node = cut(nodes(seen))
    pairs = alike(node, least).withColumnRenamed("school", "pool")
    inside = grouped(node.select(F.col("school").alias("pool"), "key", F.lit(0).alias("order")), pairs)
    name = lambda c: F.concat_ws("/", F.col("school").cast("string"), F.col(c))
    placed = inside.withColumnRenamed("pool", "school")
    first = F.min("key").over(Window.partitionBy("school", "cluster"))
    links = placed.withColumn("_first", first).where("key <> _first").select(name("_first").alias("a"), name("key").alias("b"))
    where = seen.where("province <> ''").select("school", "key", "province").distinct().join(node.select("school", "key", "class"), ["school", "key"])
    w = Window.partitionBy("province", "key").orderBy("school")
    star = where.withColumn("_s", F.first("school").over(w)).withColumn("_c", F.first("class").over(w)).where((F.col("_s") != F.col("school")) & ~title_conflict(F.col("_c"), F.col("class")))
    across = star.select(F.concat_ws("/", F.col("_s").cast("string"), "key").alias("a"), name("key").alias("b"))
    roots = components(links.unionByName(across).distinct())
    return node.select("school", "key", name("key").alias("node")).join(roots, "node", "left").select("school", "key", F.coalesce("root", "node").alias("person"))
