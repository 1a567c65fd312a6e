"""Phrase collocations of each language, by dynamic itemset counting.

The texts become rows of word numbers, dealt to shards, which are read in turn,
over and over.  Words are counted from the start; a longer phrase is counted from
the first shard after both its subphrases, without its last and without its
first word, have reached the threshold in what was counted so far, and until the
shards have gone round once.  Lengths are so interleaved: a phrase of five words may begin
before all pairs are known.  After n rounds all phrases of n words are
complete, so words that are in no frequent one leave the shards.

Phrases are counted as 64-bit hashes, in sums for each task, so that no string is
shuffled for the many that stay rare.  What has reached the threshold is a set of
bits of fixed size, sent to the workers; a bit set for another phrase costs a
needless count alone.  As that set only grows, and a phrase is counted where the
present set lets it in and the set of the shard's last turn didn't, each phrase
is counted once in each shard.  Hashes that meet can only raise a sum: a last pass
over the texts counts the phrases that reached the threshold by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import batched, discarded, let_go, scratch_path, stored
from quillgraph.llm.wordbytes import Words, mix

MOST_WORDS, LEAST, SHARDS = 5, 100, 3
#: Bits of the set of frequent phrases: between these bounds, one for every ten bytes of text.
FILTER_BITS = (20, 28)
#: Phrases that a task gathers before it sums and gives them out.
CHUNK = 2_000_000
#: Bytes of text that a task of the last pass reads, about: each gives a row for every frequent phrase that it meets.
TASK_BYTES = 64 << 20
#: First parts of the ranking of a language, so that no language is sorted in one task.
RANK_PARTS = 64
_ROOT = np.uint64(0x9E3779B97F4A7C15)

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[[*b".,;:!?", *range(0x0A, 0x0E)]] = 0x0A


class Pieces:
    """The words of a batch of texts, lower-cased, and the piece that each is in."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = texts.buffers()
        plain = _PLAIN[np.frombuffer(data, np.uint8)] if data is not None and data.size else np.zeros(0, np.uint8)
        self.words = Words(pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(plain)], offset=texts.offset))
        self.owner = np.repeat(np.arange(len(texts)), self.words.counts())
        ends = np.cumsum(self.words.data == 0x0A)
        self.piece = (ends[self.words.starts] if len(self.words) else np.zeros(0, np.int64)) + self.owner

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """A 32-bit number for each word, 0 where a piece ends, and where each text's begin, and the end."""
        word = (self.words.hashes() >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        last = np.flatnonzero(np.append(self.piece[1:] != self.piece[:-1], np.ones(min(1, len(word)), bool)))
        ends = np.searchsorted(last, self.words.first)  # pieces that end before each text
        return np.insert(word, last + 1, 0), self.words.first + ends

    def phrases(self, seeds: np.ndarray, most: int, salt: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``most`` words: the hash of the phrase from each word on, and whether it ends in its piece.

        ``seeds``: a number for each text, of its language.  With a ``salt`` the hashes are those of the whole words, else of their numbers.
        """
        word = self.words.hashes()
        word = word + np.uint64(salt) if salt else (word >> np.uint64(32)) | np.uint64(1)
        for n, hashed in enumerate(chained(word, seeds[self.owner], most), 1):
            yield hashed, self.piece[: len(hashed)] == self.piece[n - 1 :]

    def text(self, first: int, n: int) -> str:
        return " ".join(self.words.data[a:b].tobytes().decode("utf-8", "surrogatepass") for a, b in zip(self.words.starts[first : first + n], self.words.ends[first : first + n], strict=True))


def chained(word: np.ndarray, seeds: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The hashes of the runs of 1, 2, ... ``most`` words from each word on."""
    hashed = mix(mix(word) ^ seeds)
    yield hashed
    for n in range(1, most):
        hashed = mix(hashed[:-1] * _ROOT + word[n:]) if len(hashed) else hashed
        yield hashed


class Rows:
    """The word numbers of a batch of rows, one after the other, 0 between pieces and after each row."""

    def __init__(self, batch: pa.RecordBatch):
        words = batch.column("words").cast(pa.large_binary())
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] // 4
        self.word = np.frombuffer(data, "<u4")[offsets[0] : offsets[-1]].astype(np.uint64)
        self.first = offsets - offsets[0]
        self.seeds = np.repeat(batch.column("seed").to_numpy().view(np.uint64), np.diff(self.first))
        self.gaps = np.concatenate([[0], np.cumsum(self.word == 0)])

    def phrases(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``most`` words: the hash of the phrase from each word on, and whether it ends in its piece."""
        for n, hashed in enumerate(chained(self.word, self.seeds, most), 1):
            yield hashed, self.gaps[n : n + len(hashed)] == self.gaps[: len(hashed)]

    def trimmed(self, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers with words that aren't kept as gaps, gaps next to one another as one, and where each row's begin, and the end."""
        word = np.where(kept, self.word, 0)
        stay = (word != 0) | np.concatenate([[True], word[:-1] != 0])[: len(word)]
        return word[stay].astype("<u4"), np.concatenate([[0], np.cumsum(stay)])[self.first]


def _packed(batch: pa.RecordBatch, kept: list[str], numbers: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Rows of word numbers with the columns that are kept; those without a word are left out."""
    words = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(numbers.astype("<u4").tobytes())])
    return pa.record_batch([*[batch.column(c) for c in kept], words], [*kept, "words"]).filter(pa.array(np.diff(first) > 1))


class HashSet:
    """Bits by the leading bits of 64-bit hashes, set in Spark and bounded in size."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64) if words is None else words

    @staticmethod
    def of(bits: int, rows: DataFrame, **kinds: Column) -> list[HashSet]:
        """A set for each condition on the rows of ``hash, n``."""
        mask = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int))")
        sums = [F.bit_or(F.when(c, mask).otherwise(F.lit(0).cast("long"))).alias(k) for k, c in kinds.items()]
        table = rows.groupBy(F.shiftrightunsigned("hash", 70 - bits).alias("word")).agg(*sums).toArrow()
        out = [HashSet(bits) for _ in kinds]
        for one, kind in zip(out, kinds, strict=True):
            one.words[table.column("word").to_numpy()] = table.column(kind).to_numpy().view(np.uint64)
        return out

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def summed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``hash, n`` of the distinct ones of some hashes."""
    if parts:
        hashes, n = np.unique(np.concatenate(parts), return_counts=True)
        for at in range(0, len(hashes), 65536):
            yield pa.record_batch([pa.array(hashes[at : at + 65536].view(np.int64)), pa.array(n[at : at + 65536].astype(np.int64))], ["hash", "n"])


def _counted(rows: DataFrame, turn: int, known: HashSet, before: HashSet, most: int) -> DataFrame:
    """``hash, n`` in each task of the phrases of more than ``turn`` words that ``known`` lets in and ``before`` didn't; words in the first turn."""
    sent = rows.sparkSession.sparkContext.broadcast((known, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        known, before = sent.value
        parts, held = [], 0
        for batch in batches:
            shorter, inside = None, None
            for n, (hashes, whole) in enumerate(Rows(batch).phrases(most), 1):
                taken = whole if n == 1 and turn == 0 else None
                if n > max(turn, 1):  # the shorter ones are complete
                    now = known.has(shorter) & inside
                    taken = whole & now[:-1] & now[1:]
                    at = np.flatnonzero(taken)
                    taken = at[~(before.has(shorter[at]) & before.has(shorter[at + 1]))]
                if taken is not None:
                    parts.append(hashes[taken])
                    held += len(parts[-1])
                shorter, inside = hashes, whole
            if held > CHUNK:
                yield from summed(parts)
                parts, held = [], 0
        yield from summed(parts)

    return rows.mapInArrow(run, "hash long, n long")


def _trimmed(rows: DataFrame, known: HashSet, size: int) -> DataFrame:
    """The rows without the words that are in no known phrase of ``size`` words."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            found = Rows(batch)
            for hashes, whole in found.phrases(size):
                pass
            change = np.zeros(len(found.word) + 1, np.int64)
            at = np.flatnonzero(whole & known.has(hashes)) if len(hashes) else np.zeros(0, np.int64)
            change[at] += 1
            change[at + size] -= 1
            yield _packed(batch, ["shard", "seed"], *found.trimmed(np.cumsum(change[:-1]) > 0))

    return rows.mapInArrow(run, "shard long, seed long, words binary")


def _within(rows: DataFrame, kept: HashSet) -> DataFrame:
    """The rows of ``hash, n`` whose hashes are in a set of bounded size."""
    sent = rows.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sent.value
        for batch in batches:
            yield batch.filter(pa.array(kept.has(batch.column("hash").to_numpy())))

    return rows.select("hash", "n").mapInArrow(run, "hash long, n long")


def _by_words(texts: DataFrame, known: HashSet, most: int) -> DataFrame:
    """``lang, size, phrase, n`` in each task of the phrases in ``known``; a row of size 0 has the number of all words."""
    sent = texts.sparkSession.sparkContext.broadcast(known)
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        known = sent.value
        seen: dict[tuple[int, int], list] = {}  # two hashes -> [language, words, phrase, times]
        total: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [*seen.values(), *([lang, 0, "", n] for lang, n in total.items())]
            for at in range(0, len(rows), 20_000):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 20_000], strict=True), schema, strict=True)], schema=schema)
            seen.clear()
            total.clear()

        for batch in batches:
            pieces, seeds = Pieces(batch.column("text")), batch.column("seed").to_numpy().view(np.uint64)
            langs = batch.column("lang").to_pylist()
            for lang, n in zip(langs, pieces.words.counts().tolist(), strict=True):
                total[lang] = total.get(lang, 0) + n
            twice = zip(pieces.phrases(seeds, most), pieces.phrases(seeds, most, salt=1), strict=True)
            for n, ((hashes, whole), (other, _)) in enumerate(twice, 1):
                at = np.flatnonzero(whole)
                at = at[known.has(hashes[at])]
                order = at[np.argsort(other[at])]
                a, b = other[order], hashes[order]
                new = np.flatnonzero(np.append(np.ones(min(1, len(a)), bool), a[1:] != a[:-1]))
                if len(new) and (np.minimum.reduceat(b, new) != np.maximum.reduceat(b, new)).any():  # two phrases with one hash
                    order = at[np.lexsort((hashes[at], other[at]))]
                    a, b = other[order], hashes[order]
                    new = np.flatnonzero(np.append(np.ones(1, bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                times = np.diff(np.append(new, len(a)))
                for key, second, first, n_times in zip(a[new].tolist(), b[new].tolist(), order[new].tolist(), times.tolist(), strict=True):
                    if (had := seen.get((key, second))) is None:
                        seen[key, second] = [langs[pieces.owner[first]], n, pieces.text(first, n), n_times]
                    else:
                        had[3] += n_times
            if len(seen) > CHUNK // 5:
                yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "lang string, size int, phrase string, n long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, shards: int = SHARDS) -> DataFrame:
    """``lang, size, phrase, n`` of every phrase of 1 to ``most`` words that occurs ``least`` times or more in its language.

    ``docs``: ``text, lang``.  A null language is ``und``; a null text has no words.  A
    row of size 0 has the number of all words of a language.  Other columns are dropped.
    """
    spark = docs.sparkSession
    batched(spark)
    lang = F.coalesce("lang", F.lit("und"))
    texts = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("seed")).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (size // 10).bit_length()))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            yield _packed(batch, ["seed"], *Pieces(batch.column("text")).numbered())

    rows, path = _dealt(texts.select("seed", "text").mapInArrow(numbered, "seed long, words binary").withColumn("shard", F.monotonically_increasing_id() % shards))
    sets, n_reached, counts, able = [HashSet(bits)], [0], [], HashSet(bits)
    for turn in range(most * shards):
        if turn >= shards and n_reached[-1] == n_reached[-1 - shards]:
            break  # a whole round has brought nothing
        if turn and turn % shards == 0:
            done = path
            rows, path = _dealt(_trimmed(rows, sets[-1], turn // shards))
            discarded(spark, done)
        before = sets[turn - shards] if turn >= shards else sets[0]
        part = _counted(rows.where(F.col("shard") == turn % shards), turn // shards, sets[turn], before, most)
        place = scratch_path(spark, "phrase-counts")
        part.groupBy("hash").agg(F.sum("n").alias("n")).write.option("compression", "zstd").parquet(place)
        counts.append((spark.read.schema("hash long, n long").parquet(place), place))
        if len(counts) > shards:  # a phrase is counted in so many turns on end: what is in older counts is complete
            discarded(spark, counts.pop(0)[1])
        # a phrase has a count for each shard it was counted in; with a sum of `least`, one of them is at least least / shards
        heavy, touched = HashSet.of(bits, counts[-1][0], heavy=F.col("n") >= -(-least // shards), touched=F.lit(True))
        able = HashSet(bits, able.words | heavy.words)
        sets.append(HashSet(bits, sets[-1].words | _reached([c for c, _ in counts], least, HashSet(bits, able.words & touched.words)).words))
        n_reached.append(int(np.bitwise_count(sets[-1].words).sum()))
        if turn >= shards:
            sets[turn - shards] = sets[0]  # not asked for again
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    found = _by_words(texts.coalesce(tasks), sets[-1], most).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    out = stored(found.where((F.col("size") == 0) | (F.col("n") >= least)), "phrases")
    for place in [path, *[p for _, p in counts]]:
        discarded(spark, place)
    return out


def _dealt(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows of word numbers written by shard, and where."""
    path = scratch_path(rows.sparkSession, "phrase-shards")
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema("seed long, words binary, shard long").parquet(path), path


def _reached(counts: list[DataFrame], least: int, able: HashSet) -> HashSet:
    """Those of ``able`` whose counts so far sum up to ``least``."""
    if not able.words.any():
        return able
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    sums = _within(every, able).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return HashSet.of(able.bits, sums, reached=F.lit(True))[0]


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` of each phrase of two words or more, by its lowest-scoring cut.

    ``phrases`` as ``frequent_phrases`` gives them.  The score of a cut is
    floor(1000 a n / (l r)) in decimals of 38 digits; equal ones go to the earliest cut.
    """
    known = phrases.where("size > 0").select("lang", "phrase", F.col("n").alias("f"))
    total = phrases.where("size = 0").select("lang", F.col("n").alias("n"))
    longer = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", _joined("w", F.lit(1), F.col("k")).alias("first"), _joined("w", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(total, "lang")
    score = F.expr("cast((1000 * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(l as decimal(17, 0)) * cast(r as decimal(17, 0))) as long)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("best")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "best.l", "best.r", "best.n", "best.score")


def _joined(words: str, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def undominated(phrases: DataFrame, share: int = 100) -> DataFrame:
    """``lang, phrase`` of the phrases of two words or more that no longer one holds with ``share`` percent of their count."""
    longer = phrases.where("size > 2").select("lang", "size", "n", F.split("phrase", " ").alias("w"))
    inner = longer.select("lang", "n", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("lang", "n", "m", "w", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    most = inner.groupBy("lang", _joined("w", F.col("i"), F.col("m")).alias("phrase")).agg(F.max("n").alias("most"))
    rows = phrases.where("size > 1").join(most, ["lang", "phrase"], "left")
    return rows.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("n"))).select("lang", "phrase")


def collocations(docs: DataFrame, k: int = 2000, least: int = LEAST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``k`` best phrases of each language.

    Texts are lower-cased in A-Z, cut at ``.,;:!?`` and line ends into pieces, and
    these at spaces and tabs into words; phrases of two to five words that occur
    ``least`` times in pieces take part.  By score, then count, then phrase in
    byte order.  A null language is ``und``; null and empty texts have no words,
    repeated rows count as often as they come, other columns are dropped, and an
    empty table gives no rows.
    """
    phrases = frequent_phrases(docs, least)
    rows = scored(phrases).join(undominated(phrases), ["lang", "phrase"])
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part of a language first, so that one task sorts no more than k of each
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= k)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= k)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
