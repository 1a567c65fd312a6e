"""Near duplicates among embeddings: cells of spherical k-means, blocked cosine products in them, one vector of each group kept.

1. Equal vectors are one, with a weight.
2. Centroids are fitted on a bounded sample.  Where more than a few sampled
   vectors lie within half the limiting angle of one direction, that is a core:
   all that lie so near to it are linked with one another, by the angle alone, so
   a group of near copies, however large, is counted and never compared.
3. Every other vector lives in the cell of its nearest centroid.  It visits the
   cells of lower number that a partner of its could live in: their bisecting
   plane is no further away than a partner can be (``Z`` below), and cores
   that are within reach.
4. Residents and visitors of a cell meet in blocks; cells of many residents are
   cut into tiles, and each tile meets those before it.  What comes out is a
   row for each vector, its number of links and one partner; never pairs.
5. Groups are components over those partners.

A pair at angle t differs by sin t in a direction; a component of a direction in d
dimensions has a standard deviation of 1 / sqrt(d).  A partner beyond a plane is
looked for up to ``Z`` of them: up to 16 dimensions that is all of sin t, and no pair
is missed; beyond, one may be, if it differs along the line of two centroids
and next to nowhere else.  ``certain`` takes the whole of sin t, at the price of more visits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_map, batched, let_go, parts_for, stored
from quillgraph.llm.simhash import components

LIKE = 0.95
#: Rows that the centroids are fitted on, and the most centroids; there is one for each 4 sqrt(n) of n vectors.
SAMPLE_ROWS, MOST_CELLS = 32_768, 2048
ROUNDS, Z = 8, 4.0
#: Sampled vectors that make a core.
CORE_LEAST = 16
#: Bytes of the residents of a tile, and of the vectors that a task meets, about.
TILE_BYTES, TASK_BYTES = 32 << 20, 128 << 20
_BLOCK = 1024
_SLACK = 1e-12


def unit_rows(column: pa.ListArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, unit vectors) of a batch of vectors without nulls."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = column.offsets.to_numpy()[:-1] - column.offsets.to_numpy()[0]
    out = []
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        vectors = flat[starts[rows][:, None] + np.arange(n)]
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
        out.append((n, rows, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)))
    return out


def normed(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(size > 0, size, 1)


class Cells:
    """Cores, then cells, of vectors of one length."""

    def __init__(self, sample: np.ndarray, n_cells: int, like: float, certain: bool = False):
        angle = math.acos(like)
        self.core_like, self.core_reach = math.cos(angle / 2) + _SLACK, math.cos(min(math.pi, 1.5 * angle)) - _SLACK
        self.margin = math.sin(min(angle, math.pi / 2)) * (1.0 if certain else min(1.0, Z / math.sqrt(sample.shape[1]))) + _SLACK
        self.centroids = self._fitted(sample, min(n_cells, len(sample)))
        self.cores = self._cores(sample)
        gaps = 2 - 2 * self.centroids @ self.centroids.T
        self.planes = self.margin * np.sqrt(np.maximum(gaps, 0))

    @staticmethod
    def _fitted(sample: np.ndarray, n: int) -> np.ndarray:
        centroids = sample[:n].copy()  # the sample comes in order of a hash
        for _ in range(ROUNDS):
            nearest = Cells._nearest(sample, centroids)
            sums = np.zeros_like(centroids)
            np.add.at(sums, nearest, sample)
            empty = ~np.bincount(nearest, minlength=n).astype(bool)
            sums[empty] = centroids[empty]
            centroids = normed(sums)
        return centroids

    @staticmethod
    def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        return np.concatenate([np.argmax(rows[at : at + 4096] @ centroids.T, axis=1) for at in range(0, len(rows), 4096)] or [np.zeros(0, np.int64)])

    def _cores(self, sample: np.ndarray) -> np.ndarray:
        """Directions with many sampled vectors around them, the fullest first, each outside those before."""
        found = []
        for centre in self.centroids:
            for _ in range(3):
                near = sample @ centre >= self.core_like
                if near.any():
                    centre = normed(sample[near].sum(axis=0))
            if near.sum() >= CORE_LEAST:
                found.append((int(near.sum()), centre))
        cores: list[np.ndarray] = []
        for _, centre in sorted(found, key=lambda f: -f[0]):
            if not cores or max(c @ centre for c in cores) < self.core_like:
                cores.append(centre)
        return np.array(cores).reshape(-1, sample.shape[1])

    def placed(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The home of each row, cores first by number, and the cells of lower number that it visits."""
        n_cores = len(self.cores)
        home, visits = np.empty(len(rows), np.int64), []
        for at in range(0, len(rows), _BLOCK):
            part = rows[at : at + _BLOCK]
            scores = part @ self.centroids.T
            nearest = scores.argmax(axis=1)
            best = scores[np.arange(len(part)), nearest]
            mine = nearest + n_cores
            visited = np.zeros((len(part), n_cores + len(self.centroids)), bool)
            visited[:, n_cores:] = best[:, None] - scores <= self.planes[nearest]
            if n_cores:
                near = part @ self.cores.T
                core = near.argmax(axis=1)
                within = near[np.arange(len(part)), core] >= self.core_like
                mine[within] = core[within]
                visited[:, :n_cores] = near >= self.core_reach
            visited &= np.arange(visited.shape[1]) < mine[:, None]
            home[at : at + len(part)] = mine
            visits += [np.flatnonzero(v) for v in visited]
        return home, visits


_NOWHERE = -1


def _codebooks(distinct: DataFrame, n: int, like: float, certain: bool) -> dict[int, Cells]:
    """Cells for each length of vector in a sample of ``SAMPLE_ROWS`` rows, those of the least hashes."""
    sample = distinct.orderBy(F.xxhash64("embedding", F.lit(1)), "embedding").limit(SAMPLE_ROWS).select("embedding").toArrow()
    column = sample.column("embedding").combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.float64()))
    n_cells = min(MOST_CELLS, math.ceil(math.sqrt(n) / 4))
    return {d: Cells(rows, n_cells, like, certain) for d, _, rows in unit_rows(column)}


def _meetings(units: DataFrame, like: float) -> DataFrame:
    """``uid, links, partner``: what each vector found in a tile.  Rows come by unit, residents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        unit, tile = None, None
        for batch in batches:
            keys = batch.column("unit").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
                if keys[a] != unit:
                    if tile is not None:
                        yield from tile.residents()
                    unit, tile = keys[a], Tile(like)
                yield from tile.take(batch.slice(a, b - a))
        if tile is not None:
            yield from tile.residents()

    return units.mapInArrow(run, "uid long, links long, partner long")


class Tile:
    """The residents of a tile, met by one another and by visitors in blocks."""

    def __init__(self, like: float):
        self.like, self.open = like, []
        self.ready = False

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(batch.num_rows, -1)
        uid, weight, role = (batch.column(c).to_numpy() for c in ("uid", "w", "role"))
        living = role != 2
        if living.any():
            self.open.append((uid[living], weight[living], rows[living]))
            self.core = bool((role == 0).any())
        if (~living).any():
            if not self.ready:
                self._close()
            for at in range(0, int((~living).sum()), _BLOCK):
                part = np.flatnonzero(~living)[at : at + _BLOCK]
                yield from self._visited(uid[part], weight[part], rows[part])

    def _close(self) -> None:
        self.ready = True
        if not self.open:
            self.uid = np.zeros(0, np.int64)
            return
        self.uid, self.weight, self.rows = (np.concatenate(x) for x in zip(*self.open, strict=True))
        self.open = []
        self.links, self.label = np.zeros(len(self.uid), np.int64), np.arange(len(self.uid))
        if self.core:
            return  # the angle to the core says that all are linked
        for at in range(0, len(self.uid), _BLOCK):
            for other in range(0, at + 1, _BLOCK):
                near = self.rows[at : at + _BLOCK] @ self.rows[other : other + _BLOCK].T >= self.like
                if other == at:
                    near = np.tril(near, -1)
                hit, seen = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if len(hit):
                    near = near[np.ix_(hit, seen)]
                    self.links[at + hit] += near @ self.weight[other + seen]
                    self.links[other + seen] += self.weight[at + hit] @ near
                    for i, row in zip((at + hit).tolist(), near, strict=True):
                        self._join(np.append(other + seen[row], i))

    def _join(self, members: np.ndarray) -> None:
        labels = np.unique(self.label[members])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def _visited(self, uid: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(self.uid):
            return
        near = rows @ self.rows.T >= self.like
        hit = np.flatnonzero(near.any(axis=1))
        if not len(hit):
            return
        near = near[hit]
        self.links += weight[hit] @ near
        if not self.core:
            for row in near:
                self._join(np.flatnonzero(row))
        yield pa.record_batch([pa.array(uid[hit]), pa.array(near @ self.weight), pa.array(self.uid[near.argmax(axis=1)])], ["uid", "links", "partner"])

    def residents(self) -> Iterator[pa.RecordBatch]:
        if not self.ready:
            self._close()
        if not len(self.uid):
            return
        told = np.flatnonzero((self.links > 0) | (self.label != np.arange(len(self.uid))))
        for at in range(0, len(told), 8192):
            part = told[at : at + 8192]
            yield pa.record_batch([pa.array(self.uid[part]), pa.array(self.links[part]), pa.array(self.uid[self.label[part]])], ["uid", "links", "partner"])


def near_duplicates(vectors: DataFrame, like: float = LIKE, certain: bool = False) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``).

    Links join rows whose cosine, in doubles, is ``like`` or more; equal vectors
    are linked too.  ``component_id`` is the smallest ``vec_id`` reachable, and a row
    is kept if that is its own.  Null, empty and zero vectors, those with null or
    non-finite components, and vectors of unlike length are linked with nothing.  Rows that share an id are
    rows of their own; a null id counts in no minimum, and a group of nulls
    alone has a null id, and is kept.  Other columns are dropped; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    batched(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    distinct = stored(rows.where("usable").groupBy("embedding").agg(F.count("*").alias("w"), F.min("vec_id").alias("least")).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n = distinct.count()
    books = _codebooks(distinct, n, like, certain)
    placed = stored(_placed(distinct, books), "cells")
    homes = placed.groupBy("d", "home").agg(F.sum("w").alias("all"), F.count("*").alias("n"), F.min("uid").alias("first"))
    n_cores = {d: len(b.cores) for d, b in books.items()}
    # one row for each cell: bounded by the number of centroids
    cells = [(r.d, r.home, r.all, r["n"], r.first, 0 <= r.home < n_cores.get(r.d, 0)) for r in homes.collect()]
    tiles = {(d, h): max(1, -(-size * 8 * d // TILE_BYTES)) for d, h, _, size, _, _ in cells}
    table = spark.createDataFrame([(d, h, tiles[d, h], every, first, core) for d, h, every, _, first, core in cells], "d int, home long, tiles long, every long, first long, core boolean")
    table = stored(table, "cell-sizes")
    found = stored(_meetings(_units(spark, placed, table, n), like), "meetings")
    core = placed.join(F.broadcast(table.where("core")), ["d", "home"])
    links = found.select("uid", "links").unionByName(core.select("uid", (F.col("every") - F.col("w")).alias("links"))).groupBy("uid").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("uid").alias("a"), F.col("partner").alias("b")).unionByName(core.select(F.col("uid").alias("a"), F.col("first").alias("b"))).where("a <> b").distinct()
    label = components(stored(edges, "embedding-links"))
    rooted = placed.select("uid", "w", "least").join(label.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    said = rooted.join(least, "root").join(links, "uid", "left").select("uid", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    said = distinct.select("uid", "embedding").join(said, "uid").drop("uid")
    linked = rows.where("usable").join(said, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _placed(distinct: DataFrame, books: dict[int, Cells]) -> DataFrame:
    """``uid, w, least, d, home, visits, v``: each unit vector with its home and the cells that it visits."""
    sent = distinct.sparkSession.sparkContext.broadcast(books)

    def make():
        books = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = []
            for d, at, rows in unit_rows(batch.column("embedding")):
                home, visits = books[d].placed(rows) if d in books else (np.full(len(rows), _NOWHERE), [[]] * len(rows))
                taken = pa.array(at)
                whole = [*[batch.column(c).take(taken) for c in ("uid", "w", "least")], pa.array(np.full(len(at), d), pa.int32()), pa.array(home), pa.array(visits, pa.list_(pa.int64())), pa.array(list(rows), pa.list_(pa.float64()))]
                parts.append(pa.record_batch(whole, ["uid", "w", "least", "d", "home", "visits", "v"]))
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        return one

    return arrow_map(distinct.select("uid", "w", "least", "embedding"), make, "uid long, w long, least long, d int, home long, visits array<long>, v array<double>")


def _units(spark, placed: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """Rows by tile, residents first: role 0 lives in a core, 1 in a cell, 2 visits.  Cores without visitors are left out."""
    visits = placed.select("uid", "w", "v", "d", F.explode("visits").alias("home"))
    sizes = F.broadcast(table)  # one row for each cell
    mine = placed.join(sizes, ["d", "home"]).withColumn("tile", F.pmod(F.xxhash64("uid"), F.col("tiles")))
    called = stored(visits.select("d", "home").groupBy("d", "home").agg(F.count("*").alias("visitors")), "visitors")
    inside = mine.join(F.broadcast(called), ["d", "home"], "left").where("not core or visitors is not null")
    living = inside.select("uid", "w", "v", "d", "home", "tile", F.when(F.col("core"), 0).otherwise(1).alias("role"))
    earlier = inside.where("not core and tile > 0").select("uid", "w", "v", "d", "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tile") - 1)).alias("tile"), F.lit(2).alias("role"))
    guests = visits.join(sizes, ["d", "home"]).select("uid", "w", "v", "d", "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), F.lit(2).alias("role"))
    units = living.unionByName(earlier).unionByName(guests)
    unit = F.col("d").cast("long") * 2**42 + (F.col("home") + 1) * 2**24 + F.col("tile")
    n_visits, widest = called.agg(F.sum("visitors")).first()[0] or 0, table.agg(F.max("d")).first()[0] or 0
    parts = parts_for(spark, (n + n_visits) * 8 * widest, TASK_BYTES)
    return units.select(unit.alias("unit"), "role", "uid", "w", "v").repartition(parts, "unit").sortWithinPartitions("unit", "role")
