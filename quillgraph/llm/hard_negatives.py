"""Hard negatives of anchors, by an inverted multi-index.

Vectors are cut in two halves, each with a codebook; a cell holds the vectors of
one centroid in either half.  What a cell can score is bounded by the sum of two
half scores, a centroid's and its radius times the length of the anchor's half.  A
heap over the two sorted lists of half scores (the multi-sequence walk) gives the
cells of a block in order of that sum, so a walk may stop as soon as every window
of scores that an anchor asks for is certain: it has its ten best, or the
rest lies below it.  Cells whose lower bound lies above all windows are passed over.

Anchors are sent out in passes of a bounded number; a pass is a scan of the
vectors, in blocks, for the positives, and another for the negatives.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import batched, let_go, stored
from quillgraph.llm.topk import scaled_batch

#: Rows that the codebooks are fitted on, centroids of a half, rounds of fitting.
SAMPLE_ROWS, CENTROIDS, ROUNDS = 16_384, 16, 8
#: Bytes of a block of vectors, anchors of a pass, rows scored at once in a walk.
BLOCK_BYTES, ANCHORS_PER_PASS, STEP_ROWS = 32 << 20, 4096, 512
_EXACT, _LONG = 2.0**53, 2**63 - 1


class Codebook:
    """Centroids of a half of the vectors, by k-means."""

    def __init__(self, sample: np.ndarray, n: int = CENTROIDS):
        self.centroids = sample[: min(n, len(sample))].copy()  # the sample comes in order of a hash
        for _ in range(ROUNDS):
            nearest, _ = self.nearest(sample)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, nearest, sample)
            times = np.bincount(nearest, minlength=len(sums))[:, None]
            self.centroids = np.where(times > 0, sums / np.maximum(times, 1), self.centroids)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, and the distance."""
        size = (self.centroids**2).sum(axis=1)
        nearest = np.concatenate([np.argmin(size - 2 * rows[at : at + 8192] @ self.centroids.T, axis=1) for at in range(0, len(rows), 8192)] or [np.zeros(0, np.int64)])
        return nearest, np.linalg.norm(rows - self.centroids[nearest], axis=1)


class MultiIndex:
    """The cells of a block of vectors."""

    def __init__(self, books: tuple[Codebook, Codebook], keys: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.half = rows.shape[1] // 2
        self.books = books
        found = [book.nearest(part) for book, part in zip(books, (rows[:, : self.half], rows[:, self.half :]), strict=True)]
        self.radii = []
        for book, (nearest, far) in zip(books, found, strict=True):
            radius = np.full(len(book.centroids), -np.inf)  # no row of the block is there
            np.maximum.at(radius, nearest, far)
            self.radii.append(radius)
        self.wide = len(books[1].centroids)
        cell = found[0][0] * self.wide + found[1][0]
        order = np.argsort(cell, kind="stable")
        self.start = np.searchsorted(cell[order], np.arange(len(books[0].centroids) * self.wide + 1))
        self.keys, self.labels, self.rows = keys[order], labels[order], rows[order]
        self.most = np.abs(rows).max(initial=0)

    def walk(self, q: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, first row, end) of the cells with rows, by falling upper bound."""
        sides = []
        for book, radius, part in zip(self.books, self.radii, (q[: self.half], q[self.half :]), strict=True):
            there = np.flatnonzero(np.isfinite(radius))
            middle, reach = book.centroids[there] @ part, np.linalg.norm(part) * radius[there]
            order = np.argsort(-(middle + reach), kind="stable")
            sides.append((there[order].tolist(), (middle + reach)[order].tolist(), (middle - reach)[order].tolist()))
        (cells_a, high_a, low_a), (cells_b, high_b, low_b) = sides
        slack = 1e-9 * (1 + np.abs(q).sum() * self.most)  # more than the rounding of a bound
        heap, start = [(-(high_a[0] + high_b[0]), 0, 0)] if cells_a and cells_b else [], self.start
        while heap:
            bound, a, b = heapq.heappop(heap)
            if b + 1 < len(cells_b):
                heapq.heappush(heap, (-(high_a[a] + high_b[b + 1]), a, b + 1))
            if b == 0 and a + 1 < len(cells_a):  # every pair is reached by one way: down the first list, then along the second
                heapq.heappush(heap, (-(high_a[a + 1] + high_b[0]), a + 1, 0))
            cell = cells_a[a] * self.wide + cells_b[b]
            first, end = start[cell], start[cell + 1]
            if end > first:
                yield -bound + slack, low_a[a] + low_b[b] - slack, first, end


class Best:
    """The ``k`` best rows of a window of scores: by score, then the smaller key."""

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf):
        self.k, self.low, self.high = k, low, high
        self.scores, self.keys = np.zeros(0), np.zeros(0, np.int64)

    @property
    def bar(self) -> float:
        """A row below it is not asked for."""
        return self.scores[-1] if len(self.scores) == self.k else self.low

    def take(self, scores: np.ndarray, keys: np.ndarray) -> None:
        fit = (scores >= self.bar) & (scores >= self.low) & (scores <= self.high)
        if fit.any():
            scores, keys = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.keys, keys[fit]])
            order = np.lexsort((keys, -scores))[: self.k]
            self.scores, self.keys = scores[order], keys[order]


def searched(index: MultiIndex, anchor: int, label: int, q: np.ndarray, same: bool, windows: list[Best]) -> int:
    """Fill the windows of an anchor from the rows of a block, of its label or of others; the number of rows scored."""
    top, scored = max((w.high for w in windows), default=-np.inf), 0
    waiting: list[tuple[int, int]] = []
    held = 0

    def score() -> None:
        nonlocal held, scored
        at = np.concatenate([np.arange(a, b) for a, b in waiting])
        at = at[((index.labels[at] == label) == same) & (index.keys[at] != anchor)]
        scores = index.rows[at] @ q
        for w in windows:
            w.take(scores, index.keys[at])
        scored += len(at)
        waiting.clear()
        held = 0

    for upper, lower, first, end in index.walk(q):
        if upper < min((w.bar for w in windows), default=np.inf):
            break  # every window is certain
        if lower > top:
            continue
        waiting.append((first, end))
        held += end - first
        if held >= STEP_ROWS:
            score()
    if waiting:
        score()
    return scored


def searched_widely(index: MultiIndex, anchor: int, label: int, q: np.ndarray, same: bool, windows: list[Best]) -> None:
    """The same for scores beyond what doubles hold exactly: whole numbers of any size, without bounds."""
    mine = [int(x) for x in q]
    for key, other, row in zip(index.keys.tolist(), index.labels.tolist(), index.rows, strict=True):
        if key != anchor and (other == label) == same:
            exact = sum(a * int(b) for a, b in zip(mine, row, strict=True))
            for w in windows:
                w.scores = w.scores.astype(object)
                w.take(np.array([exact], object), np.array([key]))


def _blocks(batches: Iterator[pa.RecordBatch], books: dict[int, tuple[Codebook, Codebook]]) -> Iterator[tuple[int, MultiIndex]]:
    """Length and index of the blocks of a task."""
    open_: dict[int, list] = {}

    def closed(d: int) -> tuple[int, MultiIndex]:
        keys, labels, rows = (np.concatenate(x) for x in zip(*open_.pop(d), strict=True))
        return d, MultiIndex(books[d], keys, labels, rows)

    for batch in batches:
        keys, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for d, at, rows in scaled_batch(batch.column("embedding")):
            if d in books:
                open_.setdefault(d, []).append((keys[at], labels[at], rows))
                if sum(len(x[0]) for x in open_[d]) * 8 * d >= BLOCK_BYTES:
                    yield closed(d)
    for d in list(open_):
        yield closed(d)


def _pass(rows: DataFrame, books: dict[int, tuple[Codebook, Codebook]], anchors: DataFrame, same: bool, windows: Callable[[dict], list[tuple[int, Best]]]) -> DataFrame:
    """``anchor_id, number, vec_id, score``: what each task's blocks hold for the windows of each anchor.

    ``windows``: numbers and empty windows of a row of ``anchors``.
    """
    asked: dict[int, list] = {}
    for row in anchors.collect():  # no more than a pass has
        asked.setdefault(len(row.embedding), []).append((row.anchor_id, row.label, np.floor(256 * np.array(row.embedding, np.float64)), windows(row.asDict())))
    sent = rows.sparkSession.sparkContext.broadcast((books, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        books, asked = sent.value
        found = {d: [[Best(w.k, w.low, w.high) for _, w in ws] for *_, ws in rows] for d, rows in asked.items()}
        for d, index in _blocks(batches, {d: b for d, b in books.items() if d in asked}):
            for (anchor, label, q, _), mine in zip(asked[d], found[d], strict=True):
                plain = np.abs(q).max(initial=0) * index.most * d < _EXACT and all(w.scores.dtype != object for w in mine)
                (searched if plain else searched_widely)(index, anchor, label, q, same, mine)
        out = [(anchor, number, key, max(-_LONG, min(_LONG, int(score)))) for d, rows in asked.items() for (anchor, _, _, ws), mine in zip(rows, found[d], strict=True) for (number, _), w in zip(ws, mine, strict=True) for score, key in zip(w.scores.tolist(), w.keys.tolist(), strict=True)]
        for at in range(0, len(out), 20_000):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out[at : at + 20_000], strict=True)], ["anchor_id", "number", "vec_id", "score"])

    return rows.mapInArrow(run, "anchor_id long, number long, vec_id long, score long")


def mined(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: hard negatives of anchors.

    ``vectors``: ``vec_id, label, embedding``.  Components are taken as floor(256 x); a score is their integer inner
    product.  The positives of an anchor are its ``n_positives`` best other rows of its label; its negatives, for each
    of them, the ``n_negatives`` best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    Ties go to the smaller ``vec_id``.  Rows with a null id, label or vector, an empty vector, or null or non-finite
    components take no part; an anchor meets vectors of its own length alone.  Rows that share an anchor's id are its
    own; an anchor that comes twice counts once, by the least of its rows; others count as often as they come.  Scores
    past 64 bits are given as the largest or smallest long.  Other columns are dropped; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    batched(spark)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(256 * x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(whole & (F.size("embedding") > 0))
    sample = rows.select("embedding").orderBy(F.xxhash64("embedding", F.lit(1)), "embedding").limit(SAMPLE_ROWS).toArrow()
    column = sample.column("embedding").combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.float64()))
    books = {d: (Codebook(x[:, : d // 2]), Codebook(x[:, d // 2 :])) for d, _, x in scaled_batch(column)}
    anchors = stored(rows.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "embedding")).alias("a")).select("anchor_id", "a.label", "a.embedding"), "anchors")
    lengths = [r[0] for r in anchors.select(F.size("embedding")).distinct().collect()]
    books |= {d: (Codebook(np.zeros((1, d // 2))), Codebook(np.zeros((1, d - d // 2)))) for d in lengths if d not in books}
    n_passes = max(1, -(-anchors.count() // ANCHORS_PER_PASS))
    found = None
    for number in range(n_passes):
        own = anchors.where(F.pmod(F.xxhash64("anchor_id"), F.lit(n_passes)) == number) if n_passes > 1 else anchors
        near = _pass(rows, books, own, True, lambda _: [(0, Best(n_positives))])
        first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
        positives = stored(near.withColumn("number", F.row_number().over(first)).where(F.col("number") <= n_positives).select("anchor_id", "number", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        ranged = own.join(positives.groupBy("anchor_id").agg(F.collect_list(F.struct("number", "positive_score")).alias("positives")), "anchor_id")
        far = _pass(rows, books, ranged, False, lambda r: [(p.number, Best(n_negatives, -(-low * p.positive_score // 100), high * p.positive_score // 100)) for p in r["positives"]])
        best = Window.partitionBy("anchor_id", "number").orderBy(F.desc("score"), "vec_id")
        part = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives).join(positives, ["anchor_id", "number"])
        found = part if found is None else found.unionByName(part)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Labels moved on by one, of ``labels``, where ``vec_id`` is divisible by ``every``: noise for a test of mining."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
