"""Token-id shards with a minimal perfect hash index from document keys to offsets.

A shard file, little-endian::

    raw ids of its documents, one after the other (2 or 4 bytes each)
    offsets   uint64 [documents + 1]   first id of each document, in key order
    keys      int64  [documents]       and nulls uint8 [documents]
    level sizes uint64 [levels], then the levels' bits as uint64 words
    first     uint32 [distinct keys]   by slot: the first document of the key
    count     uint32 [distinct keys]   by slot: how many documents have the key
    print     uint32 [distinct keys]   by slot: the key's fingerprint
    tail      8 x uint64: magic, version, id bytes, documents, ids, distinct keys, levels, place of offsets
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import batched, parts_for, scratch_path, stored, texts_of
from quillgraph.llm.library_ids import encoder_for

#: Text of a shard, about.
SHARD_BYTES = 64 << 20
MAGIC, VERSION, END_ID = 0x51474944, 1, 1
#: Bits of the first level for each key of the index; more bits, fewer levels.
GAMMA = 2.0
_NULL_KEY = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijective 64-bit finaliser, different for each seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_words(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """Keys as unsigned words; null has one of its own."""
    return np.where(nulls.astype(bool), _NULL_KEY, keys.astype(np.int64).view(np.uint64))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit words: levels of bit arrays, a key's slot is the rank of its bit.

    At each level the keys that share a bit with no other keep it; the others go on to the next, smaller level.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes.astype(np.uint64), words
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = -(-int(GAMMA * len(left) + 1) // 64) * 64
            at = _mix(left, len(sizes)) % np.uint64(size)
            seen = np.bincount(at.astype(np.int64), minlength=size)
            levels.append(np.packbits(seen == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[seen[at.astype(np.int64)] > 1]
        return cls(np.array(sizes, np.uint64), np.concatenate([*levels, np.zeros(0, np.uint64)]).astype(np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 for a key that falls through every level."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = self.starts[level] + _mix(keys[todo], level) % size
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        return out


class ShardWriter:
    """Writes documents, in key order, to one shard file; only keys and lengths stay in memory."""

    def __init__(self, path: str, id_bytes: int):
        where, name = fs.FileSystem.from_uri(path)
        where.create_dir(name.rpartition("/")[0], recursive=True)
        self.out, self.kind = where.open_output_stream(name), np.dtype(f"<u{id_bytes}")
        self.keys: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> 8 * self.kind.itemsize:
            raise ValueError(f"id {int(ids.max())} doesn't fit in {self.kind.itemsize} bytes")
        self.out.write(ids.astype(self.kind).tobytes())
        self.keys.append(key)
        self.lengths.append(len(ids))

    def close(self) -> tuple[int, int]:
        """Write the index; give the numbers of documents and ids."""
        nulls = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.array(self.lengths, np.int64))]).astype("<u8")
        words = key_words(keys, nulls)
        new = np.ones(len(words), bool)
        new[1:] = words[1:] != words[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(words)))
        index = PerfectHash.build(words[first])
        slot = index.slots(words[first])
        by_slot = np.zeros((3, len(first)), "<u4")
        by_slot[0, slot], by_slot[1, slot], by_slot[2, slot] = first, count, _mix(words[first], 1 << 20) & np.uint64(0xFFFFFFFF)
        place = int(offsets[-1]) * self.kind.itemsize
        tail = np.array([MAGIC, VERSION, self.kind.itemsize, len(words), offsets[-1], len(first), len(index.sizes), place], "<u8")
        for part in (offsets, keys.astype("<i8"), nulls, index.sizes.astype("<u8"), index.words.astype("<u8"), by_slot, tail):
            self.out.write(part.tobytes())
        self.out.close()
        return len(words), int(offsets[-1])


class ShardReader:
    """Keyed access to a shard file: a lookup touches one slot of the index, whatever the shard's size."""

    def __init__(self, path: str):
        where, name = fs.FileSystem.from_uri(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        magic, version, id_bytes, self.n_docs, self.n_ids, distinct, levels, place = (int(x) for x in np.frombuffer(self.file.read_at(64, size - 64), "<u8"))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError(f"{path}: not a token shard")
        self.kind = np.dtype(f"<u{id_bytes}")
        rest, at = self.file.read_at(size - 64 - place, place), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(rest, kind, n, at)
            at += part.nbytes
            return part

        self.offsets = take("<u8", self.n_docs + 1).astype(np.int64)
        self.keys, self.nulls = take("<i8", self.n_docs), take("u1", self.n_docs)
        sizes = take("<u8", levels)
        self.index = PerfectHash(sizes, take("<u8", int(sizes.sum()) // 64))
        self.first, self.count, self.prints = (take("<u4", distinct) for _ in range(3))

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; none where the fingerprint differs."""
        slot = self.index.slots(words)
        safe = np.maximum(slot, 0)
        if not len(self.first):
            return np.full(len(words), -1), np.zeros(len(words), np.int64)
        known = (slot >= 0) & (self.prints[safe] == (_mix(words, 1 << 20) & np.uint64(0xFFFFFFFF)))
        return np.where(known, self.first[safe].astype(np.int64), -1), np.where(known, self.count[safe].astype(np.int64), 0)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids of the documents from ``begin`` to before ``end``, read from the file."""
        a, b = int(self.offsets[begin]) * self.kind.itemsize, int(self.offsets[end]) * self.kind.itemsize
        return np.frombuffer(self.file.read_at(b - a, a), self.kind)

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of every document with this key."""
        first, count = self.find(key_words(np.array([key or 0]), np.array([key is None])))
        return [self.ids(i, i + 1) for i in range(int(first[0]), int(first[0] + count[0]))]


def written(docs: DataFrame, definition: str, id_bytes: int | None = None, end_id: int = END_ID) -> list[tuple[str, int, int]]:
    """Tokenize every whole text, end it with ``end_id``, and write shards in ascending ``doc_id`` order.

    Returns (path, documents, ids) of each shard, in order: a row per shuffle
    partition, not per document.  Null texts are empty; null keys come first;
    documents that share a key stand together, ordered by a hash of their texts,
    and a key with very many rows may go on into the next shard.  A task that
    runs again writes a new file; only files of tasks that ended are listed.  A
    shard has about ``SHARD_BYTES`` of text.  Ids take ``id_bytes``, 2 or 4 by the
    vocabulary if none are given; an id that doesn't fit is an error.
    """
    spark = docs.sparkSession
    spark.sparkContext.setJobDescription("token shards")
    data = spark.sparkContext.broadcast(open(definition, "rb").read())
    folder = scratch_path(spark, "token-shards")
    batched(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, out, part = encoder_for(data.value), None, TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                if out is None:
                    path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.tok"
                    size = max(library.whole.get_vocab_size(with_added_tokens=True), end_id + 1)
                    out = ShardWriter(path, id_bytes or (2 if size <= 1 << 16 else 4))
                out.add(key, np.frombuffer(library.encode(text) + end, "<u4"))
        if out is not None:
            n_docs, n_ids = out.close()
            yield pa.record_batch([pa.array([x]) for x in (part, path, n_docs, n_ids)], ["part", "path", "n_docs", "n_ids"])

    rows = docs.select("doc_id", "text")
    n = parts_for(spark, rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, SHARD_BYTES)
    rows = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = stored(rows.mapInArrow(run, "part long, path string, n_docs long, n_ids long"), "token-manifest")
    return [(r.path, r.n_docs, r.n_ids) for r in manifest.orderBy("part").collect()]


def read_back(spark, shards: list[tuple[str, int, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, looked up by key in the shard files."""
    starts = [0]
    for _, _, n_ids in shards:
        starts.append(starts[-1] + n_ids)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                shard = ShardReader(shards[number][0])
                new = np.ones(shard.n_docs, bool)
                words = key_words(shard.keys, shard.nulls)
                new[1:] = words[1:] != words[:-1]
                first, count = shard.find(words[new])
                for at in range(0, len(first), 4096):
                    rows = np.concatenate([np.arange(f, f + c) for f, c in zip(first[at : at + 4096], count[at : at + 4096], strict=True)])
                    sums = [zlib.crc32(shard.ids(int(i), int(i) + 1).astype("<u4").tobytes()) for i in rows]
                    keys = pa.array(shard.keys[rows], pa.int64(), mask=shard.nulls[rows].astype(bool))
                    lengths = shard.offsets[rows + 1] - shard.offsets[rows]
                    yield pa.record_batch([keys, pa.array(starts[number] + shard.offsets[rows]), pa.array(lengths), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(shards), 1, len(shards)).mapInArrow(run, schema)
