"""Links decided by tiers, margins and claims; clusters under guards; records matched in passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.similarity import dice, jaccard
from quillgraph.functions.text import norm
from quillgraph.operators.identity import bigram_pairs, components, grouped
from quillgraph.operators.lineage import cut
from quillgraph.operators.relational import spread


def only_in_tier(pairs: DataFrame, key: str, candidate: str, score: str, tiers: Sequence[tuple[str, Column]], near: float) -> DataFrame:
    """``key, tier, candidate, score`` of the first tier in which a key has exactly one candidate.

    ``tiers``: names and conditions on a pair, the strongest first.  Keys without
    such a tier have a null candidate, and are ``ambiguous`` where their best
    score reaches ``near``, else ``no_match``.  A tier's several candidates leave
    the key to the tiers after it.
    """
    found = pairs.groupBy(key).agg(
        F.max(score).alias("_best"),
        *[F.count_if(c).alias(f"_n{i}") for i, (_, c) in enumerate(tiers)],
        *[F.max(F.when(c, F.struct(F.col(candidate).alias("c"), F.col(score).alias("s")))).alias(f"_c{i}") for i, (_, c) in enumerate(tiers)],
    )
    tier = F.when(F.col("_best") >= near, "ambiguous").otherwise("no_match")
    pick = F.lit(None).cast(found.schema["_c0"].dataType)
    for i in reversed(range(len(tiers))):
        tier, pick = F.when(F.col(f"_n{i}") == 1, tiers[i][0]).otherwise(tier), F.when(F.col(f"_n{i}") == 1, F.col(f"_c{i}")).otherwise(pick)
    return found.select(key, tier.alias("tier"), pick.alias("_p"), "_best").select(key, "tier", F.col("_p.c").alias(candidate), F.coalesce("_p.s", "_best").alias(score))


def margin_tiers(pairs: DataFrame, key: str, candidate: str, score: str, tiers: Sequence[tuple[str, Column, float, float]]) -> DataFrame:
    """``key, tier, candidate, score`` of the first tier whose best candidate passes its gate and leads by its margin.

    ``tiers``: name, which pairs take part, gate, margin.  Keys that pass none are left out.
    """
    out = None
    for rank, (name, eligible, gate, margin) in enumerate(tiers):
        rows = pairs.where(eligible)
        w = Window.partitionBy(key).orderBy(F.desc(score), candidate)
        best = rows.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead(score).over(w), F.lit(0.0))).where("_n = 1")
        # a hair of slack, so that a margin met exactly is met in either direction of rounding
        passed = best.where((F.col(score) >= gate) & (F.col(score) - F.col("_next") >= margin - 1e-9)).select(key, F.lit(rank).alias("_rank"), F.lit(name).alias("tier"), candidate, score)
        out = passed if out is None else out.unionByName(passed)
    first = out.groupBy(key).agg(F.min(F.struct("_rank", "tier", candidate, score)).alias("_p"))
    return first.select(key, "_p.tier", f"_p.{candidate}", f"_p.{score}")


def best_claims(pairs: DataFrame, key: str, candidate: str, score: str, gate: float, lead: float, low_gate: float, low_lead: float, same: float = 0.98) -> DataFrame:
    """``candidate, key, score``: what each candidate is taken for.

    A key whose best scores reach ``same`` claims all of them, as one entity
    entered twice; else it claims its best one, at ``gate`` with more than
    ``lead`` before the next, or at ``low_gate`` with ``low_lead``.  A candidate
    claimed by several keys goes to the best score, ties to the first key.
    """
    w = Window.partitionBy(key).orderBy(F.desc(score), candidate)
    ranked = pairs.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead(score).over(w), F.lit(0.0)))
    ranked = ranked.withColumn("_best", F.max(score).over(Window.partitionBy(key))).withColumn("_ties", F.count_if(F.col(score) >= same).over(Window.partitionBy(key)))
    tied = (F.col("_best") >= same) & (F.col("_ties") > 1)
    ahead = F.col(score) - F.col("_next")
    clear = ((F.col(score) >= gate) & (ahead > lead)) | ((F.col(score) >= low_gate) & (ahead >= low_lead))
    claims = ranked.where((tied & (F.col(score) >= same)) | (~tied & (F.col("_n") == 1) & clear))
    return claims.groupBy(candidate).agg(F.min(F.struct((-F.col("_best")).alias("_s"), F.col(key).alias("_k"))).alias("_p")).select(candidate, F.col("_p._k").alias(key), (-F.col("_p._s")).alias(score))


def folded(rows: DataFrame, pool: str, key: str, candidate: str, weight: str) -> DataFrame:
    """``candidate, keeper``: of rows with one key in a pool all point to the weightiest, ties to the smallest id."""
    w = Window.partitionBy(pool, key).orderBy(F.desc(weight), candidate)
    return rows.select(candidate, F.first(candidate).over(w).alias("keeper"))


def canonical(members: DataFrame, group: str, member: str, attested: str, first_year: str) -> DataFrame:
    """``group, canonical``: the member attested most, then earliest, then the smallest."""
    best = F.min(F.struct((-F.col(attested)).alias("a"), F.col(first_year).alias("b"), F.col(member).alias("c")))
    return members.groupBy(group).agg(best.alias("_p")).select(group, F.col("_p.c").alias("canonical"))


def guarded_clusters(keys: DataFrame, pool: str, key: str, least: float, number: str | None = None, places: str | None = None, corroborated: float | None = None) -> DataFrame:
    """Greedy complete-linkage clusters of names in each pool, under guards: ``pool, key, cluster``.

    A key joins the first cluster to whose every member it is like enough (Dice
    of bigram counts), longest keys first.  ``number``: keys whose numbers differ
    are kept apart.  ``places``: arrays of place names; two
    members that have places, but no shared or near-equal one, are kept apart, and where they share one,
    ``corroborated`` is enough.  Keys meet at the bigrams that they share; a pool is one array: block finely.
    """
    none = F.lit(None).cast("string")
    shaped = keys.select(F.col(pool).cast("string").alias("pool"), F.col(key).alias("key"), (F.col(number) if number else none).alias("number"), (F.col(places) if places else F.array().cast("array<string>")).alias("places")).where("key is not null")
    facts = cut(shaped.groupBy("pool", "key").agg(F.coalesce(F.max("number"), F.lit("")).alias("number"), F.array_distinct(F.flatten(F.collect_set("places"))).alias("places")))
    a, b = (facts.select("pool", *[F.col(c).alias(f"{side}_{c}") for c in ("key", "number", "places")]) for side in "ab")
    near = bigram_pairs(facts, "pool", "key").where(F.col("dice") >= min(least, least if corroborated is None else corroborated) - 1e-12)
    met = near.join(a.withColumnRenamed("a_key", "a"), ["pool", "a"]).join(b.withColumnRenamed("b_key", "b"), ["pool", "b"]).where("a_number = b_number")
    shared = F.arrays_overlap("a_places", "b_places")
    close = F.exists("a_places", lambda x: F.exists("b_places", lambda y: dice(x, y) >= 0.9))
    apart = (F.size("a_places") > 0) & (F.size("b_places") > 0) & ~shared & ~close
    enough = F.col("dice") >= least - 1e-12
    if corroborated is not None:
        enough = enough | (shared & (F.col("dice") >= corroborated - 1e-12))
    pairs = met.where(~apart & enough).select("pool", "a", "b")
    return grouped(facts.select("pool", "key", (-F.length("key")).alias("order")), pairs).withColumnsRenamed({"pool": pool, "key": key})


def pruned(members: DataFrame, group: str, member: str, first: str, last: str, weight: str, clash: str) -> DataFrame:
    """``group, member, kept``: the members of each group that agree with its weightiest one and with one another.

    Members come by weight, then first year, then name; two agree if their years don't overlap or their
    ``clash`` values are equal or null.  The others go to review (``kept`` false).
    Members of the same years and ``clash`` agree, and share the fate of the first of them: one array of a group's
    different years and values is folded, not of its members.
    """
    kinds = dict(members.dtypes)
    alike = [F.col(group).alias("_g"), F.col(first).alias("_f"), F.col(last).alias("_l"), F.col(clash).alias("_c")]
    one = F.min(F.struct((-F.col(weight)).alias("w"), F.col(first).alias("first"), F.col(member).alias("member"), F.col(last).alias("last"), F.col(clash).alias("clash")))
    firsts = members.groupBy(*alike).agg(one.alias("_x"))
    start = F.array().cast(f"array<struct<first:{kinds[first]},last:{kinds[last]},clash:{kinds[clash]},kept:boolean>>")

    def put(seen, x):
        fits = F.forall(seen, lambda k: ~k["kept"] | (x["last"] < k["first"]) | (k["last"] < x["first"]) | x["clash"].isNull() | k["clash"].isNull() | (x["clash"] == k["clash"]))
        return F.concat(seen, F.array(F.struct(x["first"].alias("first"), x["last"].alias("last"), x["clash"].alias("clash"), F.coalesce(fits, F.lit(False)).alias("kept"))))

    told = firsts.groupBy("_g").agg(F.aggregate(F.array_sort(F.collect_list("_x")), start, put).alias("_k")).select("_g", F.explode("_k").alias("_k"))
    told = told.select("_g", F.col("_k.first").alias("_f"), F.col("_k.last").alias("_l"), F.col("_k.clash").alias("_c"), F.col("_k.kept").alias("kept"))
    on = F.col(group).eqNullSafe(F.col("_g")) & F.col(first).eqNullSafe(F.col("_f")) & F.col(last).eqNullSafe(F.col("_l")) & F.col(clash).eqNullSafe(F.col("_c"))
    return members.join(told, on).select(group, member, "kept")


# Lines that are no band (fixed values).
NO_BAND = (
    r"(?i)^(british columbia|ontario|quebec|nova scotia|new brunswick|manitoba|saskatchewan|alberta|yukon( territory)?|prince edward island|north ?west "
    r"territories|total|recapitulation|grand total)\b"
)


def compatible_overlaps(pairs: DataFrame, members: DataFrame, figures: DataFrame) -> DataFrame:
    """``a, b, compatible, note`` of pairs of identities of one name whose years overlap.

    ``members``: id, name, agency (a key, or empty), first, last; ``figures``: id, year, value.  They may be one unless either is a
    province or total, their agencies differ and neither holds the other, or a year that both print
    has figures one or more apart.  Pairs of an unknown id are left out; of several figures for a year the largest counts.
    """
    side = lambda s: members.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("name", "agency", "first", "last")])
    met = cut(pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b"))
    year = figures.groupBy("id", "year").agg(F.max("value").alias("value")).where("value is not null")
    one = lambda s: year.select(F.col("id").alias(s), "year", F.col("value").alias(f"_{s}"))
    shared = met.select("a", "b", F.greatest("a_first", "b_first").alias("_lo"), F.least("a_last", "b_last").alias("_hi")).join(one("a"), "a").join(one("b"), ["b", "year"]).where("year between _lo and _hi")
    told = shared.groupBy("a", "b").agg(F.bool_or(F.abs(F.col("_a") - F.col("_b")) >= 1).alias("_differ"))
    rows = met.join(told, ["a", "b"], "left")
    x, y = (F.coalesce(F.col(c), F.lit("")) for c in ("a_agency", "b_agency"))
    lines = F.coalesce(F.col("a_name"), F.lit("")).rlike(NO_BAND) | F.coalesce(F.col("b_name"), F.lit("")).rlike(NO_BAND)
    other = (x != "") & (y != "") & ~F.contains(x, y) & ~F.contains(y, x)
    note = F.when(lines, "province/recap line").when(other, "different agencies").when(F.col("_differ"), "population differs in a shared year").when(F.col("_differ").isNotNull(), "identical population in shared years").otherwise("no conflicting population")
    return rows.select("a", "b", (~lines & ~other & ~F.coalesce("_differ", F.lit(False))).alias("compatible"), note.alias("note"))


def field_agreements(pairs: DataFrame, left: DataFrame, right: DataFrame, texts: Sequence[str], numbers: Sequence[str] = (), like: float = 0.9) -> DataFrame:
    """``field, n, equal, near`` over matched records (``left_id, right_id``) of two extractions, each with an ``id``.

    Texts are equal by their folded words, near if they are or share ``like`` of their words; numbers are equal and near if less than 0.01 apart; two nulls agree.
    """
    ours = left.select(F.col("id").alias("left_id"), *[F.col(f).alias(f"_l_{f}") for f in (*texts, *numbers)])
    other = right.select(F.col("id").alias("right_id"), *[F.col(f).alias(f"_r_{f}") for f in (*texts, *numbers)])
    rows = pairs.select("left_id", "right_id").join(ours, "left_id").join(other, "right_id")
    cells = []
    for f in texts:
        a, b = (norm(F.coalesce(F.col(f"_{s}_{f}"), F.lit(""))) for s in "lr")
        cells.append(F.struct(F.lit(f).alias("field"), (a == b).alias("equal"), ((a == b) | (jaccard(a, b) >= like)).alias("near")))
    for f in numbers:
        a, b = (F.col(f"_{s}_{f}").cast("double") for s in "lr")
        same = F.coalesce(F.abs(a - b) < 0.01, a.isNull() & b.isNull())
        cells.append(F.struct(F.lit(f).alias("field"), same.alias("equal"), same.alias("near")))
    each = rows.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    return each.groupBy("field").agg(F.count("*").alias("n"), F.count_if("equal").alias("equal"), F.count_if("near").alias("near"))


def same_name_links(rows: DataFrame, node: str, name: str, region: str, kind: str) -> DataFrame:
    """``a, b``: links from the first node of a name in a region to the others whose kinds don't conflict.

    A kind is f, m or empty.  The links are a star, so a common name makes no pairs.
    """
    nodes = rows.where(F.col(name).isNotNull() & F.col(region).isNotNull()).groupBy(name, region, node).agg(F.max(kind).alias("_k"))
    w = Window.partitionBy(name, region).orderBy(node)
    star = nodes.withColumn("a", F.first(node).over(w)).withColumn("_ka", F.first("_k").over(w)).where((F.col("a") != F.col(node)) & ~((F.col("_ka") != "") & (F.col("_k") != "") & (F.col("_ka") != F.col("_k"))))
    return star.select("a", F.col(node).alias("b")).distinct()


def merged_people(rows: DataFrame, node: str, name: str, region: str, kind: str) -> DataFrame:
    """``node, root`` of people merged over ``same_name_links``."""
    return components(same_name_links(rows, node, name, region, kind))


def matched_records(left: DataFrame, right: DataFrame, block: str, page: str, number: str, name: str, amount: str, division: str | None = None, likeness: float = 0.5) -> DataFrame:
    """Records of two extractions of one print, matched in each block: ``left_id, right_id, how``.

    In this order: ``exact``, page, number, name and division agree; ``relaxed``, all but the page, which is the one before or the one
    after; ``name``, the name alone, if it is the only one on either side; ``fuzzy``, the number, a page apart at most,
    with amounts less than a cent apart or names that share ``likeness`` of their words.  Each record is used once.  Equal records meet in order of
    ``id``; fuzzy pairs go by score (2 for the amount, the share of words, half the share of the divisions' words), then ids.  A null name is no name to match alone by.
    """
    none = F.lit("")
    sides = [x.select(F.col(block).alias("block"), F.col("id").cast("long").alias("id"), F.col(page).cast("long").alias("page"), F.coalesce(F.col(number).cast("string"), none).alias("number"), F.coalesce(F.col(name), none).alias("name"), F.col(amount).cast("double").alias("amount"), (F.coalesce(F.col(division), none) if division else none).alias("division")) for x in (left, right)]
    # rows of both sides lie together by block and name from here on: no later step but the fuzzy one moves them again
    rows = spread(sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1))), "block", "name", parts=192)
    rows = rows.withColumn("how", F.lit(None).cast("string")).withColumn("mate", F.lit(None).cast("long"))
    mate = lambda test, w: F.when(F.col("side") == 0, F.max(F.when(test & (F.col("side") == 1), F.col("id"))).over(w))
    # each step: how, and what to add to the right side's page
    for how, step in (("exact", 0), ("relaxed", 1), ("relaxed", -1)):
        free = F.col("how").isNull() & F.col("block").isNotNull() & F.col("page").isNotNull() & F.col("id").isNotNull()
        rows = rows.withColumn("_free", free).withColumn("_page", F.col("page") + F.col("side") * step)
        alike = ["block", "name", "number", "division", "_page", "_free"]
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*alike, "side").orderBy("id")))
        met = Window.partitionBy(*alike, "_n")
        rows = rows.withColumn("_met", F.col("_free") & (F.count("*").over(met) == 2)).withColumn("_mate", mate(F.lit(True), met))
        rows = rows.withColumn("how", F.when(F.col("_met"), how).otherwise(F.col("how"))).withColumn("mate", F.when(F.col("_met"), F.col("_mate")).otherwise(F.col("mate")))
    free, named = F.col("how").isNull() & F.col("block").isNotNull() & (F.col("name") != "") & F.col("id").isNotNull(), Window.partitionBy("block", "name")
    once = [(F.count_if(F.col("side") == i).over(named) == 1) & (F.count_if(F.col("_free") & (F.col("side") == i)).over(named) == 1) for i in (0, 1)]
    rows = rows.withColumn("_free", free).withColumn("_met", F.col("_free") & once[0] & once[1]).withColumn("_mate", mate(F.col("_free"), named))
    rows = rows.withColumn("how", F.when(F.col("_met"), "name").otherwise(F.col("how"))).withColumn("mate", F.when(F.col("_met"), F.col("_mate")).otherwise(F.col("mate")))
    # kept once: matched rows by their ids alone, the others whole
    texts = [F.when(F.col("how").isNull(), F.col(c)).alias(c) for c in ("number", "name", "division")]
    rows = cut(rows.where("how is null or side = 0").select("block", "id", "page", *texts, "amount", "side", "how", "mate"))
    found = rows.where("how is not null").select(F.col("id").alias("left_id"), F.col("mate").alias("right_id"), "how")
    rest = [rows.where((F.col("side") == i) & F.col("how").isNull()) for i in (0, 1)]
    pairs = rest[0].alias("l").join(rest[1].alias("r"), ["block", "number"]).where(F.abs(F.col("l.page") - F.col("r.page")) <= 1)
    equal = F.coalesce(F.abs(F.col("l.amount") - F.col("r.amount")) < 0.01, F.lit(False))
    near = _shared_words(F.col("l.name"), F.col("r.name"))
    score = F.when(equal, 2.0).otherwise(0.0) + near + 0.5 * _shared_words(F.col("l.division"), F.col("r.division"))
    pairs = pairs.where(equal | (near >= likeness)).select("block", "number", (-score).alias("s"), F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    # the best pair of a number first, then the best of those whose records are free
    taken = F.aggregate(
        F.array_sort(F.collect_list(F.struct("s", "a", "b"))), F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda kept, x: F.when(F.exists(kept, lambda k: (k["a"] == x["a"]) | (k["b"] == x["b"])), kept).otherwise(F.concat(kept, F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))),
    )
    fuzzy = pairs.groupBy("block", "number").agg(taken.alias("_t")).select(F.explode("_t").alias("_t")).select(F.col("_t.a").alias("left_id"), F.col("_t.b").alias("right_id"), F.lit("fuzzy").alias("how"))
    return found.unionByName(fuzzy)


def _shared_words(a: Column, b: Column) -> Column:
    """The share of the words of two texts that both have; 0 if neither has any."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")) for c in (a, b))
    return F.coalesce(F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0)), F.lit(0.0))


def sampled(rows: DataFrame, kind: str, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of each kind, the same for a seed whatever the partitioning: those of the least hash of key and seed."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(kind).orderBy(order, key))).where(F.col("_n") <= n).drop("_n")


def observed_ids(observed: DataFrame, closure: DataFrame, kind: str, name: str) -> DataFrame:
    """``kind, canonical, observed``: ids in observations whose canonical id is another."""
    seen = observed.select(kind, F.col(name).alias("observed")).distinct()
    return seen.join(closure.select(F.col("id").alias("observed"), "canonical"), "observed").where("canonical <> observed").select(kind, "canonical", "observed")


def unit_for(rows: DataFrame, raw: str, chains: DataFrame, units: DataFrame) -> DataFrame:
    """Add ``unit`` and ``how`` to printed unit names: the chain of that canonical name, else the only unit of that key.

    ``chains``: ``name, chain``.  ``units``: ``key, unit``; a key of several units settles nothing.
    """
    single = units.groupBy("key").agg(F.min("unit").alias("_unit"), F.count_distinct("unit").alias("_n")).where("_n = 1").drop("_n")
    out = rows.join(chains.select(F.col("name").alias(raw), F.col("chain").alias("_chain")).dropDuplicates([raw]), raw, "left")
    out = out.withColumn("_key", F.replace(F.lower(raw), F.lit(" "), F.lit(""))).join(single, F.col("_key") == F.col("key"), "left")
    return out.withColumn("unit", F.coalesce("_chain", "_unit")).withColumn("how", F.when(F.col("_chain").isNotNull(), "chain").when(F.col("_unit").isNotNull(), "unit")).drop("_chain", "_unit", "_key", "key")


def settled_by_number(rows: DataFrame, key: str, number: str, target: str, name: str, score: str, weight: str, least: float) -> DataFrame:
    """``key, target, fate``: links of accounts settled by the account number that they share.

    Where the linked names of a number are unlike (the least Dice of two is under ``least``), all its rows
    are a ``conflict`` and keep their targets.  Else the linked row of the best
    score, then weight, then least target wins: rows without a target are
    ``propagated``, those with another one ``settled``, the others ``linked``.  Rows
    without a number or a linked neighbour are ``linked`` or ``unlinked`` as they are.
    """
    numbered = rows.where(F.col(number) != "")
    linked = numbered.where(F.col(target).isNotNull())
    names = linked.select(number, name).distinct()
    pairs = names.join(names.select(number, F.col(name).alias("_other")), number).where(F.col(name) < F.col("_other"))
    unlike = pairs.groupBy(number).agg(F.min(F.round(dice(F.col(name), F.col("_other")), 6)).alias("_like"))
    best = linked.groupBy(number).agg(F.min(F.struct((-F.col(score)).alias("a"), (-F.col(weight)).alias("b"), F.col(target).alias("t"))).alias("_b")).select(number, F.col("_b.t").alias("_best"))
    out = rows.join(best, number, "left").join(unlike, number, "left")
    clash = F.coalesce(F.col("_like") < least, F.lit(False))
    has, won = F.col(target).isNotNull(), F.col("_best").isNotNull()
    fate = F.when(clash, "conflict").when(won & ~has, "propagated").when(won & (F.col(target) != F.col("_best")), "settled").when(has, "linked").otherwise("unlinked")
    return out.select(key, F.when(clash | ~won, F.col(target)).otherwise(F.col("_best")).alias(target), fate.alias("fate"))


def chosen_unit(named: DataFrame, key: str, unit: str, chain: Column, name: str) -> DataFrame:
    """``key, unit``: which of several named units is meant, null if that is open.

    The only one; else the only chain; else, of several chains, the only one
    whose name stands in another's.
    """
    units = named.select(key, unit, chain.alias("_chain"), F.col(name).alias("_name")).distinct()
    chains = units.where("_chain and _name <> ''")
    inner = chains.alias("a").join(chains.alias("b"), key).where(f"a.{unit} <> b.{unit} and contains(b._name, a._name)").select(key, F.col(f"a.{unit}").alias("_u")).distinct()
    inner = inner.groupBy(key).agg(F.min("_u").alias("_inner"), F.count("*").alias("_ni"))
    every = units.groupBy(key).agg(F.count_distinct(unit).alias("_n"), F.min(unit).alias("_one"), F.count_distinct(F.when(F.col("_chain"), F.col(unit))).alias("_nc"), F.min(F.when(F.col("_chain"), F.col(unit))).alias("_chained"))
    pick = F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_nc") == 1, F.col("_chained")).when((F.col("_nc") > 1) & (F.col("_ni") == 1), F.col("_inner"))
    return every.join(inner, key, "left").select(key, pick.alias(unit))
