"""Exact removal of repeated word passages, found by an FM-index per shard.

A window is 20 consecutive words.  Each window has an anchor: the least hash
among its five-word shingles.  Windows of equal words have equal anchors at
equal places, so what stands around one anchor holds every copy of its windows.
Consecutive windows with one anchor place are a segment.

1. Anchors are counted, with the least and greatest hash of the segments around
   them.  An anchor that occurs once is put aside.  One that always has the same
   segment is plain: its first occurrence stays, the others go.
2. The segments at mixed anchors, those with unlike surroundings, are collapsed
   where equal within a task and dealt to shards by anchor.
3. Each shard builds an FM-index of its segments, a wavelet matrix over the
   Burrows-Wheeler transform of their words, and streams the segments' windows
   through it by backward search.  A window whose interval holds an earlier
   place is repeated.
4. Segments that come again take the verdict of their first occurrence, and
   every document removes the words of its repeated windows.

A mixed anchor in more than ``HOT`` places (a common phrase) is not dealt to one
shard: each of its windows is a segment of its own, and plain.

Segments of one anchor are told apart by 64 bits that don't depend on the
anchor's: m unlike segments of one anchor are taken for equal with a chance of
m^2 / 2^65.  In the shards words are compared by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_map, batched, carried, let_go, parts_for, restored, stored
from quillgraph.llm.wordbytes import Words, mix

WINDOW, SHINGLE = 20, 5
_SPAN = WINDOW - SHINGLE + 1  # shingles of a window
#: Bits of the filters of anchors that are sent to the workers: between these bounds, 16 for each repeated anchor.
FILTER_BITS = (20, 28)
#: Bytes of segments that a task collapses before it gives them out, and that one index holds, about.
COLLAPSE_BYTES, SHARD_BYTES = 12 << 20, 6 << 20
#: Places of a mixed anchor beyond which its windows go one by one.
HOT = 2_000
_ROOT = 0x9E3779B97F4A7C15
_FACTORS = np.array([pow(_ROOT, i + 1, 2**64) for i in range(SHINGLE)], np.uint64)


def segments(hashes: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, and anchor hash of each segment of texts of words with these hashes.

    ``first``: where each text begins, and the end (none: it is one text).
    """
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.array([0, n]) if first is None else first
    shingles = np.zeros(n - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        shingles += hashes[i : i + len(shingles)] * _FACTORS[i]
    shingles = mix(shingles)
    least, place, reach = shingles, np.arange(len(shingles), dtype=np.int32), 1
    while reach < _SPAN:  # the leftmost least of 2, 4, 8, 16 shingles
        later = least[reach:] < least[:-reach]
        least, place = np.where(later, least[reach:], least[:-reach]), np.where(later, place[reach:], place[:-reach])
        reach *= 2
    whole = np.flatnonzero(np.arange(WINDOW, n + 1) <= np.repeat(first[1:], np.diff(first))[: n - WINDOW + 1])  # windows within one text
    place = place[whole]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(place)), bool), place[1:] != place[:-1]]))
    return whole[new], np.diff(np.append(new, len(place))), shingles[place[new]].view(np.int64)


def segment_hashes(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of the words of each segment, from sums of the words' hashes times odd powers."""
    n = len(hashes)
    powers, undo = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, root, np.uint64)])) for root in (_ROOT, pow(_ROOT, -1, 2**64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * powers[:n])])
    return mix((sums[first + count + WINDOW - 1] - sums[first]) * undo[first] + count.astype(np.uint64)).view(np.int64)


class WaveletMatrix:
    """Ranks of symbols in a sequence, from one packed bit vector for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.n, self.levels = len(sequence), []
        for bit in range(bits - 1, -1, -1):
            ones = (sequence >> bit) & 1 == 1
            packed = np.zeros(-(-(self.n + 1) // 64) * 8, np.uint8)
            packed[: -(-self.n // 8)] = np.packbits(ones, bitorder="little")
            words = packed.view("<u8")
            before = np.zeros(len(words), np.uint32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:], dtype=np.uint32)
            zeros = self.n - int(ones.sum())
            self.levels.append((bit, words, before, zeros))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        self.start = np.zeros((1 << bits) + 1, np.int64)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low, high = np.zeros_like(at), at
        for bit, words, before, zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            ends = []
            for x in (low, high):
                word, rest = x >> 6, (x & 63).astype(np.uint64)
                ranks = before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << rest) - np.uint64(1)))
                ends.append(np.where(one, zeros + ranks, x - ranks))
            low, high = ends
        return high - low


class FMIndex:
    """Backward search over words; ``text`` holds symbols from 1, with 0 between segments.

    Suffixes are sorted by their first 32 symbols, which holds the order that
    intervals of patterns of up to 32 words need.
    """

    DEPTH = 32

    def __init__(self, text: np.ndarray, n_symbols: int):
        self.n = len(text)
        rank, reach = text.astype(np.int64), 1
        while reach < self.DEPTH and self.n:
            after = np.zeros_like(rank)
            after[: self.n - reach] = rank[reach:] + 1
            key = rank * (int(after.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            new = np.ones(self.n, bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(new) - 1
            reach *= 2
            if new.all():
                break
        self.places = np.argsort(rank, kind="stable")
        before = text[self.places - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.matrix = WaveletMatrix(before, max(1, int(n_symbols).bit_length()))
        self.text = text

    def intervals(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the patterns ``text[s : s + length]`` those that occur twice or more: their numbers, and intervals."""
        alive = np.arange(len(starts))
        symbol = self.text[starts + length - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for back in range(length - 2, -1, -1):
            keep = high - low > 1
            alive, low, high = alive[keep], low[keep], high[keep]
            if not len(alive):
                break
            symbol = self.text[starts[alive] + back]
            both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = self.first[symbol] + both[: len(symbol)], self.first[symbol] + both[len(symbol) :]
        keep = high - low > 1
        return alive[keep], low[keep], high[keep]


def repeated_windows(texts: list[bytes], n_windows: np.ndarray) -> list[bytes]:
    """For segments in corpus order, words joined by a space: a byte for each window, 1 if its words occur at an earlier place."""
    data = b" ".join([*texts, b""])
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20) + 1
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(data)])
    codes = words.dictionary_encode()
    n_codes, lengths = len(codes.dictionary), n_windows + WINDOW - 1
    begin = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(len(words) + len(texts), np.int64)  # 0 after each segment
    text[np.arange(len(words)) + np.repeat(np.arange(len(texts)), lengths)] = codes.indices.to_numpy() + 1
    del words, codes, data, ends
    # words that occur once can be one symbol: no window with such a word is searched
    times = np.bincount(text, minlength=n_codes + 1)
    common = times > 1
    common[0] = True
    symbol = np.where(common, np.cumsum(common) - 1, int(common.sum()))
    single = ~common[text]
    text = symbol[text]
    index = FMIndex(text, int(common.sum()))
    owner = np.repeat(np.arange(len(texts)), n_windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    starts = begin[owner] + offset
    rare = np.concatenate([[0], np.cumsum(single)])
    able = np.flatnonzero(rare[starts + WINDOW] == rare[starts])
    verdict = np.zeros(len(starts), np.uint8)
    if len(able):
        got, low, high = index.intervals(starts[able], WINDOW)
        if len(got):
            pairs, which = np.unique(np.stack([low, high], 1), axis=0, return_inverse=True)
            # intervals of patterns of one length are equal or apart: the least place of each
            edges = pairs.ravel()
            least = np.minimum.reduceat(np.append(index.places, np.iinfo(np.int64).max), edges)[::2]
            verdict[able[got]] = least[which.ravel()] < starts[able[got]]
    ends = np.cumsum(n_windows)
    data = verdict.tobytes()
    return [data[e - n : e] for e, n in zip(ends.tolist(), n_windows.tolist(), strict=True)]


def _anchors(docs: DataFrame) -> DataFrame:
    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(batch.column("text"))
            hashes = words.hashes()
            first, count, anchors = segments(hashes, words.first)
            return pa.record_batch([pa.array(anchors), pa.array(segment_hashes(hashes, first, count))], ["anchor", "segment"])

        return one

    return arrow_map(docs, make, "anchor long, segment long")


def repeated_anchors(docs: DataFrame, hot: int) -> DataFrame:
    """``anchor, mixed, hot`` of the anchors that occur more than once."""
    seen = _anchors(docs).groupBy("anchor").agg(F.count("*").alias("n"), F.min("segment").alias("low"), F.max("segment").alias("high")).where("n > 1")
    mixed = F.col("low") != F.col("high")
    return seen.select("anchor", mixed.alias("mixed"), (mixed & (F.col("n") > hot)).alias("hot"))


class AnchorFilter:
    """A bit for each hash of an anchor that is repeated, mixed, hot: what isn't set is not.  The size is bounded.

    A bit that is set for another anchor costs work alone: a segment that needn't be looked at.
    """

    KINDS = ("repeated", "mixed", "hot")

    def __init__(self, anchors: DataFrame, n: int):
        self.bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (16 * n).bit_length()))
        place = F.shiftrightunsigned("anchor", 64 - self.bits)
        mask = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - self.bits}) & 63 as int))")
        none = F.lit(0).cast("long")
        sums = [F.bit_or(mask).alias("repeated"), *[F.bit_or(F.when(F.col(k), mask).otherwise(none)).alias(k) for k in self.KINDS[1:]]]
        table = anchors.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(*sums).toArrow()
        self.words = {}
        for kind in self.KINDS:
            self.words[kind] = np.zeros(1 << (self.bits - 6), np.uint64)
            self.words[kind][table.column("word").to_numpy()] = table.column(kind).to_numpy().view(np.uint64)

    def has(self, kind: str, anchors: np.ndarray) -> np.ndarray:
        place = anchors.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.words[kind][(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


_OCCURRENCE = "doc_id long, text_key long, start int, n_windows int, anchor long, segment long, mixed boolean, words binary, times long"


def _occurrences(docs: DataFrame, known: AnchorFilter) -> DataFrame:
    """A narrow row for each segment at an anchor that may be repeated; at mixed anchors also, with its words, each distinct one of a task, at its first place."""
    batched(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(known)
    names = [c.split()[0] for c in _OCCURRENCE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        known = sent.value
        distinct: dict[tuple[int, int], list] = {}  # (anchor, segment) -> [order, doc, windows, words, times]
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = [(v[1], v[0][2], v[0][3], v[2], a, s, True, v[3], v[4]) for (a, s), v in distinct.items()]
            for at in range(0, len(rows), 8192):
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 8192], strict=True), kinds, strict=True)], names)
            distinct.clear()
            held = 0

        for batch in batches:
            words = Words(batch.column("text"))
            hashes = words.hashes()
            first, count, anchors = segments(hashes, words.first)
            hit = np.flatnonzero(known.has("repeated", anchors))
            if not len(hit):
                continue
            first, count, anchors = first[hit], count[hit], anchors[hit]
            mixed, hot = known.has("mixed", anchors), known.has("hot", anchors)
            if hot.any():  # every window of theirs by itself
                n = count[hot]
                single = np.repeat(first[hot] - np.cumsum(n) + n, n) + np.arange(n.sum())
                first, count, anchors = np.concatenate([first[~hot], single]), np.concatenate([count[~hot], np.ones(len(single), np.int64)]), np.concatenate([anchors[~hot], np.repeat(anchors[hot], n)])
                mixed = np.concatenate([mixed[~hot], np.zeros(len(single), bool)])
            passages = segment_hashes(hashes, first, count)
            owner = np.searchsorted(words.first, first, side="right") - 1
            start = first - words.first[owner]
            docs_of, keys_of = batch.column("doc_id").take(pa.array(owner)), batch.column("text_key").take(pa.array(owner))
            nothing = pa.nulls(len(first), pa.binary()), pa.nulls(len(first), pa.int64())
            whole = pa.record_batch([docs_of, keys_of, pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array(anchors), pa.array(passages), pa.array(mixed), *nothing], names)
            for at in range(0, len(first), 8192):
                yield whole.slice(at, 8192)
            if not (which := np.flatnonzero(mixed)).size:
                continue
            raw, taken = memoryview(words.data), pa.array(which)
            places = zip(docs_of.take(taken).to_pylist(), keys_of.take(taken).to_pylist(), start[which].tolist(), count[which].tolist(), anchors[which].tolist(), passages[which].tolist(), words.starts[first[which]].tolist(), words.ends[first[which] + count[which] + WINDOW - 2].tolist(), strict=True)
            for doc, key, at, n, anchor, passage, begin, end in places:
                where = (doc is not None, doc or 0, key, at)  # nulls first, as in the corpus order
                if (had := distinct.get((anchor, passage))) is None:
                    part = b" ".join(bytes(raw[begin:end]).split())
                    distinct[anchor, passage] = [where, doc, n, part, 1]
                    held += len(part) + 400
                else:
                    had[4] += 1
                    if where < had[0]:
                        had[0], had[1] = where, doc
                if held > COLLAPSE_BYTES:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, _OCCURRENCE)


def _verdicts(shards: DataFrame) -> DataFrame:
    """Per distinct segment: its first place, and whether each of its windows is repeated there."""
    schema = "anchor long, segment long, first_doc long, first_key long, first_start int, verdict binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        del got
        doc, key, start, windows, anchor, segment, times = (table.column(c).fill_null(0).to_numpy() for c in ("doc_id", "text_key", "start", "n_windows", "anchor", "segment", "times"))
        dated = np.asarray(table.column("doc_id").is_valid())
        # equal segments side by side, the first place of each in front
        order = np.lexsort((start, key, doc, dated, segment, anchor))
        new = np.ones(len(order), bool)
        new[1:] = (anchor[order[1:]] != anchor[order[:-1]]) | (segment[order[1:]] != segment[order[:-1]])
        every = np.add.reduceat(times[order], np.flatnonzero(new))
        first = order[new]
        in_turn = np.lexsort((start[first], key[first], doc[first], dated[first]))
        first, every = first[in_turn], every[in_turn]
        rows = table.take(pa.array(first))
        del table, order
        masks = repeated_windows(rows.column("words").to_pylist(), windows[first].astype(np.int64))
        told = np.flatnonzero((every > 1) | np.array([1 in m for m in masks], bool))
        rows = rows.take(pa.array(told))
        out = pa.table([*[rows.column(c) for c in ("anchor", "segment", "doc_id", "text_key", "start")], pa.array([masks[i] for i in told.tolist()], pa.binary())], names)
        yield from out.combine_chunks().to_batches(max_chunksize=8192)

    return shards.mapInArrow(run, schema)


def _covered(words: Words, marks: pa.Array) -> np.ndarray:
    """For each word of a batch, whether a repeated window covers it."""
    n_marks = np.array([n or 0 for n in marks.value_lengths().to_pylist()], np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    flat = marks.flatten()
    if len(flat):
        start = np.repeat(words.first[:-1], n_marks) + flat.field("start").to_numpy(zero_copy_only=False)
        windows, verdict = flat.field("n_windows").to_numpy(zero_copy_only=False), flat.field("verdict")
        whole = ~np.asarray(verdict.is_valid())
        np.add.at(change, start[whole], 1)
        np.add.at(change, start[whole] + windows[whole] + WINDOW - 1, -1)
        own = np.flatnonzero(~whole)
        if len(own):
            said = np.frombuffer(b"".join(verdict.take(pa.array(own)).to_pylist()), np.uint8)
            at = np.repeat(start[own] - np.cumsum(windows[own]) + windows[own], windows[own]) + np.arange(len(said))
            at = at[said == 1]
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def marked(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``, and others by unlike names) with ``text_key`` and ``marks``: the segments with repeated windows."""
    spark = docs.sparkSession
    batched(spark)
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    narrow = keyed.select("doc_id", "text_key", "text")
    anchors = stored(repeated_anchors(narrow.select("text"), HOT), "anchors")
    found = stored(_occurrences(narrow, AnchorFilter(anchors, anchors.count())), "segments")
    places, distinct = found.where("words is null").drop("words", "times"), found.where("words is not null")
    total = distinct.agg(F.sum(F.length("words"))).first()[0] or 0
    verdicts = stored(_verdicts(distinct.repartition(parts_for(spark, total, SHARD_BYTES), "anchor")), "verdicts")
    where = F.struct("doc_id", "text_key", "start")
    plain = places.where("not mixed").groupBy("anchor", "segment").agg(F.min(where).alias("at"), F.count("*").alias("n")).where("n > 1")
    first = plain.select("anchor", "segment", F.col("at.doc_id").alias("first_doc"), F.col("at.text_key").alias("first_key"), F.col("at.start").alias("first_start"), F.lit(None).cast("binary").alias("verdict"))
    here = places.join(verdicts.unionByName(first), ["anchor", "segment"])
    own = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_key") == F.col("first_key")) & (F.col("start") == F.col("first_start"))
    rows = here.select("doc_id", "text_key", "start", "n_windows", F.when(own, F.col("verdict")).alias("verdict"), own.alias("own"))
    rows = rows.where("not own or instr(hex(verdict), '01') > 0").drop("own").dropDuplicates(["doc_id", "text_key", "start"])
    marks = rows.groupBy(F.col("doc_id").alias("m_doc"), F.col("text_key").alias("m_key")).agg(F.collect_list(F.struct("start", "n_windows", "verdict")).alias("marks"))
    return keyed.join(marks.hint("shuffle_hash"), keyed.doc_id.eqNullSafe(marks.m_doc) & (keyed.text_key == marks.m_key), "left").drop("m_doc", "m_key")


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``.

    Windows are judged on the input: the first place, by ``doc_id`` (nulls
    first) and then position, stays.  Rows with equal ``doc_id`` and equal text
    are one document; rows that share an id alone are ordered by a hash of the
    text.  Null and short texts lose nothing; other columns are dropped; an
    empty table gives no rows.
    """

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(batch.column("text"))
            gone = _covered(words, batch.column("marks"))
            data, offsets = words.joined(~gone)
            n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            digest = [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            return pa.record_batch([batch.column("doc_id"), pa.array(words.counts(), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

        return one

    return arrow_map(marked(docs.select("doc_id", "text")).select("doc_id", "text", "marks"), make, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words cut out of ``text``; the white space around what stays is kept, and all columns.

    A removed word goes with the white space before it, but line ends stay.  A
    text that loses every word becomes empty; its row stays.  Null texts stay null.
    """
    plain = carried(docs)
    columns = plain.columns
    rows = marked(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            words = Words(batch.column("text"))
            gone = _covered(words, batch.column("marks"))
            lost = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first]))
            texts = batch.column("text").to_pylist()
            for i in lost.tolist():
                base, mine = words.offsets[i], slice(words.first[i], words.first[i + 1])
                data, starts, ends = words.data[base : words.offsets[i + 1] - 1], words.starts[mine] - base, words.ends[mine] - base
                before = np.concatenate([[0], ends[:-1]])
                lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
                begin = np.where(lines[starts] > lines[before], starts, before)
                change = np.zeros(len(data) + 1, np.int64)
                change[begin[gone[mine]]] += 1
                change[ends[gone[mine]]] -= 1
                texts[i] = data[np.cumsum(change[:-1]) == 0].tobytes().decode("utf-8", "surrogatepass").strip(" \t\n\v\f\r")
            kept = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.record_batch(kept, columns)

    return restored(rows.select(*columns, "marks").mapInArrow(run, plain.schema), docs)
