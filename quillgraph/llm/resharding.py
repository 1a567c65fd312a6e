"""Shards of near equal bytes, resharded by a minimum-cost flow that moves the fewest bytes.

Documents fall into hash blocks, blocks into shards, and a shard's files each
hold a run of its blocks.  Given the old shard sizes and the new capacities, a
minimum-cost flow says how many bytes go from which shard to which; blocks at a
shard's end are handed over until each amount is met, the last block of each
amount is cut between two documents, and only files with moved blocks are
written again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import scratch_path

#: Hash blocks of a table: the most rows that the plan brings to the driver.
BLOCKS = 1 << 16
#: Bytes of texts in one file of a shard, about; and shuffle partitions for each file, so that few meet in a task.
FILE_BYTES, SPREAD = 32 << 20, 3


def minimum_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Units from each source to each target, of the least total cost; ``cost(i, j)`` is for a unit.

    Successive shortest paths over the residual network, found by relaxation;
    each path carries as much as it can.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the targets can't hold what the sources have")
    n, m = len(supply), len(capacity)
    left, room = list(supply), list(capacity)
    flow: dict[tuple[int, int], int] = {}
    while any(left):
        distance = {("s", i): 0 for i in range(n) if left[i]}
        came: dict[tuple[str, int], tuple[str, int]] = {}
        for _ in range(n + m):
            changed = False
            for i in range(n):
                for j in range(m):
                    a, b = ("s", i), ("t", j)
                    if a in distance and distance[a] + cost(i, j) < distance.get(b, float("inf")):
                        distance[b], came[b], changed = distance[a] + cost(i, j), a, True
                    if flow.get((i, j)) and b in distance and distance[b] - cost(i, j) < distance.get(a, float("inf")):
                        distance[a], came[a], changed = distance[b] - cost(i, j), b, True
            if not changed:
                break
        end = min((("t", j) for j in range(m) if room[j] and ("t", j) in distance), key=lambda t: (distance[t], t[1]))
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        amount = min(left[path[0][1]], room[end[1]])
        steps = list(zip(path, path[1:], strict=False))
        for a, b in steps:
            if a[0] == "t":
                amount = min(amount, flow[b[1], a[1]])
        for a, b in steps:
            if a[0] == "s":
                flow[a[1], b[1]] = flow.get((a[1], b[1]), 0) + amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def even(total: int, n: int) -> list[int]:
    """``total`` in ``n`` parts that differ by at most one."""
    return [total * (i + 1) // n - total * i // n for i in range(n)]


@dataclass
class Plan:
    """Whole blocks by new shard, and of cut blocks the (before this many bytes, new shard) parts in order."""

    moved: dict[int, int] = field(default_factory=dict)
    cut: dict[int, list[tuple[int, int]]] = field(default_factory=dict)


def planned(sizes: dict[int, int], old_shard: dict[int, int], capacities: list[int]) -> Plan:
    """Hand blocks over from the end of each shard until each amount of the flow is met."""
    n_old = max(old_shard.values(), default=-1) + 1
    supply = [0] * max(n_old, len(capacities))
    for block, size in sizes.items():
        supply[old_shard[block]] += size
    flow = minimum_cost_flow(supply, capacities, lambda i, j: int(i != j))
    plan = Plan()
    for shard in range(len(supply)):
        due = [[j, amount] for (i, j), amount in sorted(flow.items()) if i == shard != j]
        for block in sorted((b for b in sizes if old_shard[b] == shard), reverse=True):
            if not due:
                break
            at, size = 0, sizes[block]
            parts: list[tuple[int, int]] = []
            while due and at < size:
                take = min(due[0][1], size - at)
                at += take
                parts.append((at, due[0][0]))
                due[0][1] -= take
                if not due[0][1]:
                    due.pop(0)
            if len(parts) == 1 and at == size:
                plan.moved[block] = parts[0][1]
            else:
                plan.cut[block] = parts + ([(size, shard)] if at < size else [])
    return plan


def _block() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS)).cast("int")


def _size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


@dataclass
class ShardStore:
    """A sharded table in a shared folder: parquet files below ``shard=…/run=…`` of one or two versions."""

    spark: SparkSession
    paths: list[tuple[str, list[tuple[int, int]] | None]]  # version folder, and its (shard, run)s (None: all)
    n_shards: int
    runs: int

    @classmethod
    def create(cls, docs: DataFrame, n_shards: int) -> tuple[ShardStore, dict[int, int]]:
        """Write ``docs`` in equal ranges of blocks; also gives the bytes of each block."""
        spark = docs.sparkSession
        rows = docs.select("doc_id", "text").withColumns({"block": _block(), "size": _size()})
        sizes = {r.block: r.bytes for r in rows.groupBy("block").agg(F.sum("size").alias("bytes")).collect()}  # at most BLOCKS rows
        runs = max(1, min(BLOCKS // n_shards, -(-sum(sizes.values()) // (FILE_BYTES * n_shards))))
        store = cls(spark, [(scratch_path(spark, "shards"), None)], n_shards, runs)
        store._write(rows.withColumn("shard", F.floor(F.col("block") * n_shards / BLOCKS).cast("int")), store.paths[0][0])
        return store, sizes

    def _run(self) -> Column:
        """The file of a block within its shard."""
        return F.floor(F.pmod(F.col("block") * self.n_shards, F.lit(BLOCKS)) * self.runs / BLOCKS).cast("int")

    def _write(self, rows: DataFrame, path: str) -> None:
        rows = rows.withColumn("run", self._run())
        rows.repartition(SPREAD * self.n_shards * self.runs, "shard", "run").write.partitionBy("shard", "run").option("compression", "zstd").parquet(path)

    def read(self) -> DataFrame:
        """``doc_id, text, block, size, shard, run`` of every row, from the files."""
        found = None
        for path, only in self.paths:
            where = [path] if only is None else [f"{path}/shard={s}/run={r}" for s, r in only]
            if where:
                part = self.spark.read.option("basePath", path).schema("doc_id long, text string, block int, size long, shard int, run int").parquet(*where)
                found = part if found is None else found.unionByName(part)
        return found

    def reshard(self, sizes: dict[int, int], capacities: list[int]) -> ShardStore:
        """Move the fewest bytes that bring every shard to its capacity; write only files with moved blocks again."""
        home = {b: b * self.n_shards // BLOCKS for b in sizes}
        plan = planned(sizes, home, capacities)
        if not plan.moved and not plan.cut:
            return self
        (base, _) = self.paths[0]
        touched = {(home[b], b * self.n_shards % BLOCKS * self.runs // BLOCKS) for b in [*plan.moved, *plan.cut]}
        present = {(home[b], b * self.n_shards % BLOCKS * self.runs // BLOCKS) for b in sizes}
        rows = ShardStore(self.spark, [(base, sorted(touched))], self.n_shards, self.runs).read()
        if plan.moved:
            new = F.broadcast(self.spark.createDataFrame(sorted(plan.moved.items()), "block int, to int"))  # at most BLOCKS rows
            rows = rows.join(new, "block", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
        if plan.cut:
            # bytes before a document in its block; few blocks, each a small part of the table
            before = F.sum("size").over(Window.partitionBy("block").orderBy("doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1))
            some = F.col("block").isin(sorted(plan.cut))
            inside = rows.where(some).withColumn("before", F.coalesce(before, F.lit(0)))
            goes = F.col("shard")
            for block, parts in sorted(plan.cut.items()):
                for upto, shard in reversed(parts):
                    goes = F.when((F.col("block") == block) & (F.col("before") + F.col("size") / 2 < upto), F.lit(shard)).otherwise(goes)
            rows = rows.where(~some).unionByName(inside.withColumn("shard", goes).drop("before"))
        path = scratch_path(self.spark, "shards")
        moved = ShardStore(self.spark, [(path, None)], len(capacities), self.runs)
        rows = rows.drop("run")
        rows = rows.withColumn("run", F.floor(F.pmod(F.col("block") * self.n_shards, F.lit(BLOCKS)) * self.runs / BLOCKS).cast("int"))
        rows.repartition(SPREAD * len(touched), "shard", "run").write.partitionBy("shard", "run").option("compression", "zstd").parquet(path)
        moved.paths = [(base, sorted(present - touched)), (path, None)]
        return moved


def slotted(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard: a base for each of its blocks, and the place within it."""
    counts = rows.groupBy("shard", "block").count().collect()  # at most BLOCKS rows and those of cut blocks
    bases, at = [], {}
    for r in sorted(counts, key=lambda r: (r.shard, r.block)):
        bases.append((r.shard, r.block, at.get(r.shard, 0)))
        at[r.shard] = at.get(r.shard, 0) + r["count"]
    base = F.broadcast(rows.sparkSession.createDataFrame(bases, "shard int, block int, base long"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32"))
    return rows.join(base, ["shard", "block"]).withColumn("slot", F.col("base") + within - 1).drop("base")


def balanced(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row, from shard files of near equal bytes.

    A row's size is its text's UTF-8 bytes (null: none) and one.  Shards differ
    from equal parts by no more than half a document for each transfer.  Rows with
    the same ``doc_id`` share a block, and equal texts aren't kept together, as
    one group may hold more than a shard.  Null texts and ids are kept as they
    are; other columns are dropped; an empty table gives no rows.
    """
    store, sizes = ShardStore.create(docs, n_shards)
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, size long, text_crc32 long, shard int, slot long")
    rows = store.reshard(sizes, even(sum(sizes.values()), n_shards)).read()
    digests = rows.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "shard", "block")
    return slotted(digests).select("doc_id", "size", "text_crc32", "shard", "slot")
