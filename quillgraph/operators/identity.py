"""Identity: components, redirects, clusters, stable ids, assignments in turn."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.similarity import bigrams
from quillgraph.operators.lineage import cut


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable over undirected links ``a, b``.

    Alternating large and small stars; each round is cut off from those before,
    and it ends when a round changes nothing.
    """
    current = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    while True:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        following = cut(large.join(low, "a").select(pairs.alias("e")).select("e.*").where("a <> b").distinct())
        same = following.exceptAll(current).isEmpty() and current.exceptAll(following).isEmpty()
        current = following
        if same:
            break
    return nodes.join(current.toDF("node", "m"), "node", "left").select("node", F.coalesce("m", "node").alias("root"))


def redirect_closure(redirects: DataFrame) -> DataFrame:
    """``id, canonical``: where each id's redirects (``id -> target``, one each) end.

    Targets are doubled: a round takes every id to its target's target, so a
    chain of n takes log2(n) rounds, and the rounds end when one brings no
    further id to an end.  What is left then walks in a circle, and such an id
    is its own.
    """
    walk = cut(redirects.select("id", F.col("target").alias("at")))
    before = None
    while True:
        following = walk.alias("w").join(walk.select(F.col("id").alias("_id"), F.col("at").alias("_at")), F.col("w.at") == F.col("_id"), "left")
        following = cut(following.select("id", F.coalesce("_at", "at").alias("at"), F.col("_id").isNotNull().alias("moved")))
        moved = following.where("moved").count()
        if moved in (0, before):
            return following.select("id", F.when(F.col("moved"), F.col("id")).otherwise(F.col("at")).alias("canonical"))
        walk, before = following.select("id", "at"), moved


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``number``, from 1 in order of some columns that together are unique, without sorting in one task.

    Rows are cut into ranges; what precedes a range is the sum of the ranges before, a number for each of them.
    """
    ranged = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(F.broadcast(before), "_range").withColumn("number", F.col("_before") + inside).drop("_range", "_before")


def minted(rows: DataFrame, order: list[str], prefix: str) -> DataFrame:
    """Sequential ids over the distinct values of ``order``; nulls come first."""
    ids = numbered(rows.select(*order).distinct(), order).withColumn("minted", F.concat(F.lit(prefix), F.lpad(F.col("number").cast("string"), 5, "0"))).drop("number")
    same = ids.select(*[F.col(c).alias(f"_{c}") for c in order], "minted")
    on = F.lit(True)
    for c in order:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(same, on).drop(*[f"_{c}" for c in order])


def taken_in_turn(pairs: DataFrame, left: str, right: str, order: str, score: str, block: str | None = None, open_ties: bool = True) -> DataFrame:
    """``left, right, fate``: in ``order``, each left takes its best right that none before it took.

    Fates: ``assigned``; ``ambiguous``, whose two best free ones score the same, and
    which takes none (without ``open_ties`` the smaller right is taken); ``unmatched``, whose
    rights were all taken.  Lefts of one ``order`` go by themselves.  One set of
    taken rights holds for all of a block; without ``block``, blocks are the components
    that the pairs hang together in, and each is one array, so pairs must be gated before.
    Pairs with a null side or score are left out.
    """
    kinds = dict(pairs.dtypes)
    rows = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull() & F.col(score).isNotNull())
    if block is None:
        rows = cut(rows.select(left, right, order, score))
        name = lambda side, c: F.concat(F.lit(side), F.col(c).cast("string"))
        label = components(rows.select(name("l", left).alias("a"), name("r", right).alias("b")).distinct())
        rows = rows.withColumn("node", name("l", left)).join(label, "node").withColumnRenamed("root", "_block")
    else:
        rows = rows.withColumn("_block", F.col(block))
    best = rows.groupBy("_block", order, left, right).agg(F.max(score).alias("_s"))
    lists = best.groupBy("_block", order, left).agg(F.array_sort(F.collect_list(F.struct((-F.col("_s")).alias("s"), F.col(right).alias("r")))).alias("c"))
    start = F.struct(F.array().cast(f"array<{kinds[right]}>").alias("used"), F.array().cast(f"array<struct<l:{kinds[left]},r:{kinds[right]},fate:string>>").alias("out"))

    def turn(state, x):
        free = F.filter(x["c"], lambda c: ~F.array_contains(state["used"], c["r"]))
        first, second = F.get(free, F.lit(0)), F.get(free, F.lit(1))
        tie = F.lit(open_ties) & F.coalesce(F.abs(first["s"] - second["s"]) < 1e-9, F.lit(False))
        fate = F.when(F.size(free) == 0, "unmatched").when(tie, "ambiguous").otherwise("assigned")
        right_ = F.when((F.size(free) > 0) & ~tie, first["r"])
        used = F.when(right_.isNotNull(), F.concat(state["used"], F.array(right_))).otherwise(state["used"])
        return F.struct(used.alias("used"), F.concat(state["out"], F.array(F.struct(x["l"].alias("l"), right_.alias("r"), fate.alias("fate")))).alias("out"))

    folded = F.aggregate(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(left).alias("l"), "c"))), start, turn, lambda s: s["out"])
    return lists.groupBy("_block").agg(folded.alias("_o")).select("_block", F.explode("_o").alias("_o")).select(*([F.col("_block").alias(block)] if block else []), F.col("_o.l").alias(left), F.col("_o.r").alias(right), "_o.fate")


def complete_linkage(keys: DataFrame, pool: str, key: str, least: float) -> DataFrame:
    """``pool, key, cluster``: greedy clusters in each pool; a key joins the first cluster to whose every member it is like enough.

    Keys come in order of length, longest first, then by name; likeness is the
    multiset Dice of bigrams.  Null keys are left out.  A pool is one array: block finely.
    """
    rows = keys.select(F.col(pool).alias("pool"), F.col(key).alias("key")).where("key is not null").distinct()
    pairs = bigram_pairs(rows, "pool", "key").where(F.col("dice") >= least - 1e-12)
    return grouped(rows.withColumn("order", -F.length("key")), pairs).withColumnsRenamed({"pool": pool, "key": key})


def bigram_pairs(rows: DataFrame, pool: str, key: str) -> DataFrame:
    """``pool, a, b, dice`` of the keys of a pool that share a bigram, each pair both ways: they meet at bigrams, so unlike keys never do.

    ``dice`` is twice the shared bigrams, counted as often as both have them, over all of both.
    """
    grams = rows.select(pool, key, F.explode(bigrams(F.col(key))).alias("g")).groupBy(pool, key, "g").agg(F.count("*").alias("n"))
    other = grams.select(pool, F.col(key).alias("b"), "g", F.col("n").alias("m"))
    shared = grams.withColumnRenamed(key, "a").join(other, [pool, "g"]).where("a <> b").groupBy(pool, "a", "b").agg(F.sum(F.least("n", "m")).alias("both"))
    return shared.select(pool, "a", "b", (2 * F.col("both") / (F.length("a") + F.length("b") - 2)).alias("dice"))


def grouped(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pool, key, cluster``: keys of a pool, by ``order`` and then by name, each into the first group whose every member it is paired with.

    ``rows``: pool, key, order; ``pairs``: pool, a, b, both ways.  A pool is folded as one array; clusters are numbered from 0 as they are opened.
    """
    kind = dict(rows.dtypes)["key"]
    near = pairs.groupBy("pool", F.col("a").alias("key")).agg(F.collect_set("b").alias("near"))
    listed = rows.select("pool", "key", "order").distinct().join(near, ["pool", "key"], "left").withColumn("near", F.coalesce("near", F.array().cast(f"array<{kind}>")))
    groups = F.array().cast(f"array<array<{kind}>>")

    def put(found, x):
        at = F.array_position(F.transform(found, lambda g: F.size(F.array_except(g, x["near"])) == 0), True)
        return F.when(at > 0, F.transform(found, lambda g, i: F.when(i + 1 == at, F.concat(g, F.array(x["key"]))).otherwise(g))).otherwise(F.concat(found, F.array(F.array(x["key"]))))

    folded = F.aggregate(F.array_sort(F.collect_list(F.struct("order", "key", "near"))), groups, put)
    out = listed.groupBy("pool").agg(folded.alias("_g")).select("pool", F.posexplode("_g").alias("_i", "_m"))
    return out.select("pool", F.explode("_m").alias("key"), F.col("_i").cast("long").alias("cluster"))


def one_to_one(scored: DataFrame, block: str, left: str, right: str, score: str, gate: float) -> DataFrame:
    """``block, left, right, fate``: ``taken_in_turn`` in each block, in order of ``left``, of the pairs that reach ``gate``; lefts with none left are left out."""
    return taken_in_turn(scored.where(F.col(score) >= gate), left, right, left, score, block).where("fate <> 'unmatched'")


def stable_ids(previous: DataFrame, current: DataFrame, name: str, old_id: str, new_key: str, kind: str | None = None, prefix: str | None = None, order: str | None = None) -> DataFrame:
    """``new_key, old_id, votes``: the old id that each new cluster keeps.

    A cluster's names vote for the ids that they had, as often as they had them;
    in turn of ``order`` (else of the key) each cluster takes the id of most votes that no cluster before it took, and
    goes on to the next where that is gone; ties to the smaller id.  ``kind``: a column of either side; an id
    goes only to a cluster of its kind, or to any if its own is null or empty.  With a ``prefix`` the clusters that got none are given new ids, numbered
    after the largest old number; else theirs is null.  ``votes`` is null for those.
    """
    old = previous.select(name, old_id, *([F.col(kind).alias("_old")] if kind else []))
    order = order or new_key
    votes = current.join(old, name)
    votes = votes.where(F.coalesce("_old", F.lit("")).isin("") | (F.col("_old") == F.col(kind))) if kind else votes
    votes = cut(votes.groupBy(new_key, old_id).agg(F.count("*").alias("votes")))
    keys = current.groupBy(new_key).agg(F.min(order).alias("_order"))
    kept = taken_in_turn(votes.join(keys, new_key), new_key, old_id, "_order", "votes", open_ties=False).where("fate = 'assigned'").drop("fate")
    out = keys.join(kept.join(votes, [new_key, old_id]), new_key, "left")
    if prefix is None:
        return out.select(new_key, old_id, "votes")
    last = previous.select(F.coalesce(F.max(F.regexp_extract(old_id, "([0-9]+)$", 1).try_cast("long")), F.lit(0)).alias("_last"))
    fresh = numbered(cut(out).where(F.col(old_id).isNull()).select(new_key, "_order"), ["_order", new_key])
    fresh = fresh.crossJoin(F.broadcast(last)).select(new_key, F.concat(F.lit(prefix), F.lpad((F.col("_last") + F.col("number")).cast("string"), 5, "0")).alias("_fresh"))  # one row
    return out.join(fresh, new_key, "left").select(new_key, F.coalesce(old_id, "_fresh").alias(old_id), "votes")


def _values(column: pa.Array) -> list:
    """The column as a list; whole numbers without nulls go by numpy, many times faster."""
    return column.to_numpy().tolist() if pa.types.is_integer(column.type) and not column.null_count else column.to_pylist()


def _first_come(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, start and falling end, those that begin where the last one kept has ended, or after it."""
    key = start = end = last = object()  # unlike any key
    for batch in batches:
        kept = []
        for i, (k, s, e) in enumerate(zip(*map(_values, batch.columns[:3]), strict=True)):
            if k != key or ((s, e) != (start, end) and (last is None or s is None or s >= last)):
                kept.append(i)
                last = e
            key, start, end = k, s, e
        yield batch.take(pa.array(kept, pa.int32()))


def non_overlapping(spans: DataFrame, key: str, start: str, end: str, carried: str | None = None) -> DataFrame:
    """Of each key's spans keep the earliest, the longest of those, and drop what overlaps a kept one.

    Spans are dealt by their key and sorted once, and gone through in order, a batch at a time; equal ones are one.
    ``carried`` names a column that stays; of equal spans the least value of it.
    Other columns take no part and are dropped.
    """
    rows = spans.select(key, start, end, *([carried] if carried else []))
    order = [F.asc(key), F.asc(start), F.desc(end), *([F.asc_nulls_last(carried)] if carried else [])]
    return rows.repartition(key).sortWithinPartitions(*order).mapInArrow(_first_come, rows.schema)