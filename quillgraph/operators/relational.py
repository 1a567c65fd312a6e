"""Joins with stated tie rules, decisions over scored candidates, and window-shaped row logic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.lineage import cut


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def unique_keys(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one row, and its value: a lookup that never guesses."""
    return rows.groupBy(key).agg(F.count("*").alias("_n"), F.first(value).alias(value)).where("_n = 1").drop("_n")


def fallback_join(left: DataFrame, fine: DataFrame, coarse: DataFrame, fine_keys: Sequence[str], coarse_keys: Sequence[str], value: str) -> DataFrame:
    """Look ``value`` up by the fine key, and by the coarse one where that has none."""
    a = left.join(fine.withColumnRenamed(value, "_fine"), list(fine_keys), "left")
    return a.join(coarse.withColumnRenamed(value, "_coarse"), list(coarse_keys), "left").withColumn(value, F.coalesce("_fine", "_coarse")).drop("_fine", "_coarse")


def match_status(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Add ``status``: none, one or many rows of ``right`` with the key."""
    n = right.groupBy(key).agg(F.count("*").alias("_n"))
    return left.join(n, key, "left").withColumn("status", F.when(F.col("_n").isNull(), "none").when(F.col("_n") == 1, "one").otherwise("many")).drop("_n")


def margin_gate(scored: DataFrame, key: str, candidate: str, score: str, gate: float, margin: float) -> DataFrame:
    """Each key's best candidate and a decision: accepted, below_gate or ambiguous (the next one is too close)."""
    w = Window.partitionBy(key).orderBy(F.desc(score), candidate)
    ranked = scored.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.lead(score).over(w)).where("_n = 1")
    close = F.col(score) - F.coalesce(F.col("_next"), F.lit(-1e9)) < margin
    return ranked.withColumn("decision", F.when(F.col(score) < gate, "below_gate").when(close, "ambiguous").otherwise("accepted")).drop("_n", "_next")


def lowest_tier(candidates: DataFrame, key: str, candidate: str, tier: str) -> DataFrame:
    """Each key's only candidate of its lowest tier; keys with several there are ambiguous (null candidate)."""
    best = candidates.withColumn("_t", F.min(tier).over(Window.partitionBy(key))).where(F.col(tier) == F.col("_t"))
    agg = best.groupBy(key).agg(F.min(tier).alias(tier), F.count_distinct(candidate).alias("n_candidates"), F.min(candidate).alias("_c"))
    return agg.withColumn(candidate, F.when(F.col("n_candidates") == 1, F.col("_c"))).drop("_c")


def vote(rows: DataFrame, key: str, value: str, ratio: int = 3) -> DataFrame:
    """Each key's most frequent value (ties to the smallest), and a verdict: sole, clear (``ratio`` to one), single or review."""
    n = rows.groupBy(key, value).agg(F.count("*").alias("votes"))
    w = Window.partitionBy(key).orderBy(F.desc("votes"), value)
    top = n.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead("votes").over(w), F.lit(0))).where("_n = 1")
    verdict = F.when((F.col("_next") == 0) & (F.col("votes") == 1), "single").when(F.col("_next") == 0, "sole").when(F.col("votes") >= ratio * F.col("_next"), "clear").otherwise("review")
    return top.withColumn("verdict", verdict).drop("_n", "_next")


def majority(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each key; ties to the smallest."""
    n = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return first_wins(n, keys, [F.desc("_n"), F.asc(value)]).drop("_n")


def carried(rows: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, reset: str | None = None) -> DataFrame:
    """Fill ``column`` from the last row that has it; a change of ``reset`` to another non-null value forgets it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if reset is None:
        return rows.withColumn(column, F.last(column, True).over(w))
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    changed = F.col(reset).isNotNull() & ~F.col(reset).eqNullSafe(F.last(reset, True).over(before))
    rows = rows.withColumn("_new", changed.cast("int")).withColumn("_session", F.sum("_new").over(w))
    inside = Window.partitionBy(*keys, "_session").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(column, True).over(inside)).drop("_new", "_session")


def changes(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Rows whose value differs from the last one before that had any."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.where(F.col(value).isNotNull()).withColumn("before", F.lag(value).over(w)).where(F.col("before").isNotNull() & (F.col("before") != F.col(value)))


def gaps(rows: DataFrame, key: str, year: str, more_than: int) -> DataFrame:
    """Spans of years without a row that are longer than ``more_than``."""
    w = Window.partitionBy(key).orderBy(year)
    return rows.select(key, year).distinct().withColumn("next", F.lead(year).over(w)).where(F.col("next") - F.col(year) > more_than)


def suffixed(rows: DataFrame, base: str, order: Sequence[str], name: str) -> DataFrame:
    """Settle equal ids in order: the first keeps it, then -2, -3, ..., but for numbers that make another row's own id."""
    bases = rows.select(base).where(F.col(base).isNotNull()).distinct()
    numbered = bases.select(F.regexp_extract(base, r"^(.*)-([1-9][0-9]{0,8})$", 1).alias("_b"), F.regexp_extract(base, r"^(.*)-([1-9][0-9]{0,8})$", 2).try_cast("int").alias("_k"))
    taken = numbered.where("_k >= 2").groupBy("_b").agg(F.array_sort(F.collect_set("_k")).alias("_taken"))
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    placed = rows.withColumn("_n", n).join(taken, F.col(base) == F.col("_b"), "left")
    # the n-th number from 2 that is not taken: taken ones below it push it up, in order
    number = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_n"), lambda at, k: F.when(k <= at, at + 1).otherwise(at))
    return placed.withColumn(name, F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("-"), number.cast("string")))).drop("_n", "_b", "_taken")


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def tightest(points: DataFrame, spans: DataFrame, block: Sequence[str], point: str, low: str, high: str, prefer: str) -> DataFrame:
    """Each point's smallest span that holds it, preferred ones first: an equi-join on the block, then a range test."""
    held = points.join(spans, list(block)).where(F.col(point).between(F.col(low), F.col(high)))
    w = Window.partitionBy(*block, point).orderBy(F.desc(prefer), F.col(high) - F.col(low), low, high)
    return held.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


#: Pairs that one task makes, about; tasks that a join of fewer pairs is dealt to; the most tasks of one join.
PAIRS, FEW, TASKS = 10_000_000, 64, 8192
#: Rows on the left that change fastest where pairs are to repeat: few, so that they come again within a page of a file.
AGAIN = 512


def dealt_join(left: DataFrame, right: DataFrame, on: Sequence[str], deal: str, pairs: int | None = None, weights: tuple[str, str] | None = None, near: tuple[str, str] | None = None) -> DataFrame:
    """``left`` joined with ``right`` on keys that may have many rows each.

    The rows of each key are counted first.  Those of a key with more than ``pairs`` pairs are dealt on the left by ``deal`` to as many
    parts as that takes, each of which gets all of the key on the right; other keys stay whole.  The number of tasks follows the number
    of pairs, so a task's work stays the same however large the tables are.
    ``weights`` name a column of either side with how many a row stands for.  ``near`` names a column of either side whose like values are to
    lie together: a key's rows are dealt by their rank in it, and pairs come in its order, the left row changing fastest, so that what
    follows from them repeats and files are small.
    """
    on = list(on)
    of_left, of_right = map(F.sum, weights) if weights else (F.count("*"), F.count("*"))
    counted = left.groupBy(on).agg(of_left.alias("_l")).join(right.groupBy(on).agg(of_right.alias("_r")), on)
    sizes = counted.select(*on, "_l", (F.col("_l").cast("double") * F.col("_r")).alias("_n"))  # doubles, as products of counts may pass 64 bits
    every, most = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0.0)), F.coalesce(F.max("_n"), F.lit(0.0))).first()
    pairs = pairs or int(min(PAIRS, max(every / FEW, PAIRS / FEW)))
    tasks = int(min(every // pairs + 16, TASKS))
    if most > pairs:
        heavy = sizes.where(F.col("_n") > pairs).select(*on, F.ceil(F.greatest(F.col("_n") / pairs, F.col("_l") / AGAIN if near else F.lit(0.0))).alias("_parts"))
        heavy = F.broadcast(cut(heavy))  # fewer keys than the pairs fill tasks
        parts = F.coalesce("_parts", F.lit(1))
        part = F.pmod(F.xxhash64(deal), parts)
        if near:
            key = Window.partitionBy(*on)
            part = F.floor((F.row_number().over(key.orderBy(near[0], deal)) - 1) * parts / F.count("*").over(key))
        left = left.join(heavy, on, "left").withColumn("_part", part).drop("_parts")
        right = right.join(heavy, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
        on = [*on, "_part"]
    left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    if near:
        return right.sortWithinPartitions(*on, near[1]).hint("merge").join(left.sortWithinPartitions(*on, near[0]), on).drop("_part")
    return left.join(right, on).drop("_part")


def spread(rows: DataFrame, *keys: str, parts: int = 96) -> DataFrame:
    """``rows`` dealt by their keys to many tasks: a small file is read by one, whatever work its rows are, and few tasks hold much each."""
    return rows.repartition(parts, *keys)


def preferred(rows: DataFrame, candidates: DataFrame, key: str, block: str, place: str, candidate: str) -> DataFrame:
    """``key, candidate``: the candidates of a row's block that are in its place, or all of the block if none of a key's rows has one there.

    Local ones meet by block and place, and only keys without any meet the whole block.  A null place is
    unlike nothing and like nothing: where no place of either side is known, a key has no candidates.
    """
    rows, candidates = rows.select(key, block, place), candidates.select(block, place, candidate)
    there = candidates.where(F.col(place).isNotNull()).select(block, place).distinct()
    known = there.select(block, F.lit(True).alias("_known")).distinct()
    told = rows.join(there.withColumn("_here", F.lit(True)), [block, place], "left").join(known, block, "left")
    some = F.max(F.when(F.col(place).isNotNull() & F.col("_known"), F.coalesce("_here", F.lit(False))))
    told = cut(told.withColumn("_some", some.over(Window.partitionBy(key))).where("_here or not _some"))  # counted and dealt from there
    local = dealt_join(told.where("_here").select(key, block, place), candidates, [block, place], key)
    return local.select(key, candidate).unionByName(dealt_join(told.where("not _some").select(key, block), candidates, [block], key).select(key, candidate))


def partition_replaced(old: DataFrame, new: DataFrame, column: str, value) -> DataFrame:
    """``old`` without the rows of one partition value, and ``new`` in their place."""
    return old.where(~F.col(column).eqNullSafe(F.lit(value))).unionByName(new)


def referential(edges: DataFrame, nodes: DataFrame, exempt: Sequence[str]) -> DataFrame:
    """Edges whose two ends are known nodes; ends of exempt types need not be."""
    a = nodes.selectExpr("type as src_type", "id as src_id")
    b = nodes.selectExpr("type as dst_type", "id as dst_id").withColumn("_known", F.lit(True))
    kept = edges.join(a, ["src_type", "src_id"], "left_semi").join(b, ["dst_type", "dst_id"], "left")
    return kept.where(F.col("_known").isNotNull() | F.col("dst_type").isin(*exempt)).drop("_known")
