"""Exact top-k inner products by no-random-access aggregation over sorted component lists.

A block of candidates has a list for each component, sorted by it and cut into
runs.  A query reads every list from its better end, run after run, the runs
first that leave most uncertain; no entry is looked up by candidate.  What was
read of a candidate, with the unread lists' frontiers and ends, bounds its score
from above and below.  When few candidates can still reach the k-th best bound,
reading stops for all others, and the scores of the few are resolved.  The sums
of runs, for many queries and candidates at once, are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import batched, stored

#: Queries of one pass over the candidates: at most this many vectors are sent to the workers at once.
QUERIES_PER_PASS = 8192
BLOCK_ROWS, QUERY_ROWS = 4096, 512
#: Runs of a list, and shares of all runs read before each look at the bounds.
RUNS, READS = 4, (0.7, 0.85, 1.0)
#: Share of a block's candidates that may be left when reading stops.
FEW = 0.02
_EXACT = 2.0**53


def scaled(vector) -> np.ndarray | None:
    """floor(256 x) of every component; None if the vector takes no part."""
    if vector is None:
        return None
    x = np.array([np.nan if v is None else v for v in vector], np.float64)
    return np.floor(256 * x) if np.isfinite(x).all() and np.isfinite(256 * x).all() else None


def scaled_batch(column: pa.ListArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of the vectors of a batch that take part."""
    lengths = np.array([-1 if n is None else n for n in column.value_lengths().to_pylist()])
    flat = column.flatten()
    values = np.where(np.asarray(flat.is_valid()), np.nan_to_num(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), nan=np.inf), np.inf)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    out = []
    for n in sorted({*lengths.tolist()} - {-1, 0}):
        rows = np.flatnonzero(lengths == n)
        matrix = 256 * values[starts[rows][:, None] + np.arange(n)]
        fine = np.isfinite(matrix).all(axis=1)
        if fine.any():
            out.append((n, rows[fine], np.floor(matrix[fine])))
    return out


class SortedLists:
    """The lists of a block: which run of each list a candidate is in, and the values where runs begin.

    Runs are counted from the high end.  Single precision serves the bounds; ``slack`` covers its rounding.
    """

    def __init__(self, block: np.ndarray):
        n, d = block.shape
        order = np.argsort(-block, axis=0, kind="stable")
        run = np.empty((n, d), np.int64)
        np.put_along_axis(run, order, np.broadcast_to((np.arange(n) * RUNS // n)[:, None], (n, d)), axis=0)
        ranked = np.take_along_axis(block, order, axis=0)
        starts = np.searchsorted(np.arange(n) * RUNS // n, np.arange(RUNS + 1))
        self.high = ranked[np.minimum(starts[:-1], n - 1)].T  # [list, run]: the first value of the run
        self.low = ranked[np.maximum(starts[1:] - 1, 0)].T  # the last
        member = run.T[:, None, :] == np.arange(RUNS)[None, :, None]
        self.member = member.reshape(d * RUNS, n).astype(np.float32)
        self.values = (member * block.T[:, None, :]).reshape(d * RUNS, n).astype(np.float32)
        self.most = np.abs(block).max(initial=0)

    def frontiers(self, q: np.ndarray) -> np.ndarray:
        """[query, list, runs read]: the most that an entry beyond them can add; 0 past the end."""
        out = np.zeros((*q.shape, RUNS + 1))
        up = q > 0
        out[:, :, :-1] = np.where(up[:, :, None], q[:, :, None] * self.high, q[:, :, None] * self.low[:, ::-1])
        return out

    def tails(self, q: np.ndarray) -> np.ndarray:
        """[query, list]: the least that an entry can add."""
        return np.where(q > 0, q * self.low[:, -1], q * self.high[:, 0])

    def bound(self, q: np.ndarray, depth: np.ndarray, unread: np.ndarray) -> np.ndarray:
        """[query, candidate]: what was read, and ``unread`` for each list where the candidate was not met."""
        run = np.arange(RUNS)
        met = np.where((q > 0)[:, :, None], run < depth[:, :, None], run >= RUNS - depth[:, :, None])
        flat = (len(q), q.shape[1] * RUNS)
        read = (met * q[:, :, None]).reshape(flat).astype(np.float32) @ self.values
        return unread.sum(axis=1)[:, None] + read - (met * unread[:, :, None]).reshape(flat).astype(np.float32) @ self.member

    def slack(self, q: np.ndarray) -> np.ndarray:
        """More than single precision can lose in a bound: a rounding for each of its terms."""
        return 2.4e-7 * (len(self.member) + 8) * (1 + np.abs(q).sum(axis=1) * self.most)


class BoundedReader:
    """The best k of each query so far, over candidates that come in blocks."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, queries, k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
        self.bar = np.full(len(ids), -np.inf)  # the k-th best score, where there are k
        self.entries = self.entries_read = self.resolved = 0  # of all lists and queries; candidates whose scores were resolved

    def read(self, keys: np.ndarray, block: np.ndarray) -> None:
        if np.abs(self.q).max(initial=0) * np.abs(block).max(initial=0) * block.shape[1] >= _EXACT:
            return self._resolve_exactly(keys, block)
        lists = SortedLists(block)
        for at in range(0, len(self.q), QUERY_ROWS):
            self._some(slice(at, at + QUERY_ROWS), keys, block, lists)

    def _some(self, part: slice, keys: np.ndarray, block: np.ndarray, lists: SortedLists) -> None:
        q, bar = self.q[part], self.bar[part]
        mine = keys[None, :] == self.ids[part][:, None]  # any number of rows may be the query's own
        frontier, tail = lists.frontiers(q), lists.tails(q)
        unsure = frontier[:, :, :-1] - tail[:, :, None]  # what reading a run, and those after it, can tell
        for share in READS:
            n = unsure[0].size
            first_left = min(int(share * n), n - 1)
            limit = -np.inf if share == 1 else np.partition(-unsure.reshape(len(q), n), first_left, axis=1)[:, first_left]
            depth = (unsure > -np.reshape(limit, (-1, 1, 1)) if share < 1 else np.ones_like(unsure, bool)).sum(axis=2)
            front = np.take_along_axis(frontier, depth[:, :, None], axis=2)[:, :, 0]
            upper = lists.bound(q, depth, front)
            if not np.isfinite(bar).all() and len(block) >= self.k:
                lower = np.where(mine, -np.inf, lists.bound(q, depth, tail))
                bar = np.maximum(bar, np.partition(lower, len(block) - self.k, axis=1)[:, len(block) - self.k] - lists.slack(q))
            able = (upper + lists.slack(q)[:, None] >= bar[:, None]) & ~mine
            if able.sum() <= FEW * able.size:
                break
        self.entries += q.size * len(block)
        self.entries_read += int(depth.sum()) * len(block) // RUNS
        self.resolved += int(able.sum())
        for i in range(len(q)):
            rows = np.flatnonzero(able[i])
            if len(rows):
                self._take(part.start + i, keys[rows], block[rows] @ q[i])

    def _resolve_exactly(self, keys: np.ndarray, block: np.ndarray) -> None:
        """Scores beyond what doubles hold exactly: whole numbers of any size."""
        wide = [[int(x) for x in row] for row in block]
        for i, query in enumerate(self.q):
            rows = np.flatnonzero(keys != self.ids[i])
            mine = [int(x) for x in query]
            self._take(i, keys[rows], np.array([sum(a * b for a, b in zip(mine, wide[r], strict=True)) for r in rows], object))

    def _take(self, i: int, keys: np.ndarray, scores: np.ndarray) -> None:
        old_scores, old_keys = self.best[i]
        scores, keys = np.concatenate([old_scores.astype(scores.dtype), scores]), np.concatenate([old_keys, keys])
        if len(scores) > self.k:
            bar = np.sort(scores)[-self.k] if scores.dtype == object else np.partition(scores, -self.k)[-self.k]
            keep = scores >= bar
            scores, keys = scores[keep], keys[keep]
            self.bar[i] = float(bar) if abs(bar) < _EXACT else -np.inf
        order = np.array(sorted(range(len(keys)), key=lambda r: (-scores[r], keys[r]))[: self.k], int) if len(keys) <= 64 else np.lexsort((keys, -scores))[: self.k]
        self.best[i] = scores[order], keys[order]
        if len(order) == self.k:
            self.bar[i] = max(self.bar[i], float(scores[order][-1])) if abs(scores[order][-1]) < _EXACT else self.bar[i]


def top_k(vectors: DataFrame, is_query, k: int = 5, per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` highest integer inner products.

    ``vectors``: ``vec_id, embedding``; ``is_query``: a condition on ``vec_id``.
    Ties go to the smaller ``vec_id``.  Null vectors, those with null or
    non-finite components and empty ones take no part; a query meets only
    vectors of its own length.  Rows that share the query's ``vec_id`` are its
    own; a repeated query counts once, by the least of its vectors, repeated candidates as often as they come
    (a null ``vec_id`` is not a candidate).  Queries are sent out in passes of a
    bounded number; each pass is a scan with a top-k per task and query.
    """
    spark = vectors.sparkSession
    batched(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    queries = stored(rows.where(is_query).where(whole & (F.size("embedding") > 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    n_passes = max(1, -(-queries.count() // per_pass))
    schema = "query_id long, vec_id long, score long"
    found = None
    for number in range(n_passes):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_passes)) == number) if n_passes > 1 else queries
        table = own.toArrow()
        by_length = {}
        for n, at, matrix in scaled_batch(table.column("embedding").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))):
            by_length[n] = (table.column("vec_id").to_numpy()[at], matrix)
        sent = spark.sparkContext.broadcast(by_length)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            readers = {n: BoundedReader(ids, matrix, k) for n, (ids, matrix) in sent.value.items()}
            for batch in batches:
                keys = batch.column("vec_id").to_numpy(zero_copy_only=False)
                for n, at, matrix in scaled_batch(batch.column("embedding")):
                    if n in readers:
                        readers[n].read(keys[at], matrix)
            for reader in readers.values():
                got = [(int(q), int(v), int(s)) for q, (scores, ids) in zip(reader.ids, reader.best, strict=True) for s, v in zip(scores, ids, strict=True)]
                for at in range(0, len(got), 20_000):
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*got[at : at + 20_000], strict=True)], ["query_id", "vec_id", "score"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
