"""SimHash near-duplicates at Hamming distance 2 or less, by meet-in-the-middle ball hashing.

Two fingerprints at distance 2 or less share a variant: a word within distance 1
of both.  Every distinct fingerprint emits its 65 variants; those that meet at a
variant are within distance 2 of one another, so a star from the smallest of
them carries all their links, and no pairs within a group are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_map, batched, carried, parts_for, restored, stored, texts_of

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Variants that one task of the meeting sorts in memory (16 bytes each).
VARIANTS_PER_TASK = 2_000_000
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority of the shingles' XXH64 bits; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - shingle + 1
    total = np.zeros(64, np.int64)
    begin, end = starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist()
    for at in range(0, n, 65536):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[at : at + 65536], end[at : at + 65536], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep_key: bool = False) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every whole text, and its hash if asked for; a null text has no words."""
    names = ["doc_id", *["text_key"] * keep_key]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
            return pa.record_batch([*[batch.column(n) for n in names], pa.array(fps)], [*names, "fp"])

        return one

    rows = docs.select("doc_id", "text", *[F.xxhash64("text").alias("text_key")] * keep_key)
    return arrow_map(rows, make, ", ".join(f"{n} long" for n in [*names, "fp"]))


def links(distinct: DataFrame, n_distinct: int) -> DataFrame:
    """Links ``a, b`` (a != b) whose components are those of all pairs within distance 2, from distinct ``fp``."""
    spark = distinct.sparkSession
    batched(spark)

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            ball = np.concatenate([fps[:, None], fps[:, None] ^ _BITS], axis=1).ravel()
            yield pa.record_batch([pa.array(ball.view(np.int64)), pa.array(np.repeat(fps, 65).view(np.int64))], ["variant", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("variant").to_numpy(), b.column("fp").to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        variant, fp = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((fp, variant))
        variant, fp = variant[order], fp[order]
        new = np.ones(len(fp), bool)
        new[1:] = variant[1:] != variant[:-1]
        least = fp[np.flatnonzero(new)][np.cumsum(new) - 1]
        pairs = np.unique(np.stack([least, fp], 1)[~new & (least != fp)], axis=0)
        near = np.bitwise_count(pairs[:, 0].view(np.uint64) ^ pairs[:, 1].view(np.uint64)) <= RADIUS if len(pairs) else np.zeros(0, bool)
        pairs = pairs[near]
        for at in range(0, len(pairs), 10_000):
            part = pairs[at : at + 10_000]
            yield pa.record_batch([pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())], ["a", "b"])

    n = parts_for(spark, 65 * n_distinct, VARIANTS_PER_TASK)
    return distinct.select("fp").mapInArrow(variants, "variant long, fp long").repartition(n, "variant").mapInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for nodes that have a link.

    Alternating stars: every node's larger neighbours are linked to its smallest
    one, then every node's smaller ones; the links end as stars.  Each round is
    a table of its own, no component meets in one task but as rows of a join,
    and it ends when a round changes nothing.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # star(node): each neighbour b of a, itself included, to the least of them
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the smaller neighbours of a node, and the node, to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        following = stored(small, "links")
        after, before = (x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first() for x in (following, current))
        current = following
        if (after.n, after.s) == (before.n, before.s):
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of two or
    fewer differing bits.  Rows with equal fingerprints are one node, so copies
    are never paired.  Null and empty texts have fingerprint zero and link like
    any other; a null ``doc_id`` counts in no minimum, and a component of nulls
    alone has a null id.  Other columns are dropped; an empty table gives none.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    return rows.join(_least(rows), "fp").select("doc_id", "fp", "component_id")


def _least(rows: DataFrame) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``rows`` (``doc_id, fp``).

    ``root``, the smallest fingerprint, is a component's own; ids that are null or come with several texts may be shared.
    """
    groups = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    label = components(stored(links(groups, groups.count()), "fingerprint-links"))
    rooted = groups.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their components: those of the smallest ``doc_id``, with all columns.

    Rows that share that ``doc_id`` are told apart by a hash of their texts, and
    copies of one row stay as often as they come only if they are equal in both.
    A component of null ids alone keeps the rows of its least text hash.  Components
    are told apart by their roots: those that share an id, or have none, each keep one.
    """
    keyed = carried(docs).withColumn("text_key", F.xxhash64("text"))
    rows = stored(fingerprints(docs, keep_key=True), "fingerprints")
    found = rows.join(_least(rows.select("doc_id", "fp")), "fp").where("doc_id <=> component_id")
    # of a component's rows with the smallest id, the least text hash; rows are few where ids are unique
    least = found.groupBy("root", "fp").agg(F.min("component_id").alias("id"), F.min("text_key").alias("text_key"))
    stay = least.groupBy("root").agg(F.min("id").alias("stay_id"), F.min("text_key").alias("stay_key"))
    # equal texts are of one component, so id and text hash name its rows alone
    return restored(keyed.join(stay.hint("shuffle_hash"), keyed.doc_id.eqNullSafe(stay.stay_id) & (keyed.text_key == stay.stay_key), "left_semi"), docs)
