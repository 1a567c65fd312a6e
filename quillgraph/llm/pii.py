"""Personal data by pattern, and the terms that give it away by co-occurrence.

The patterns find e-mail and IP addresses, card and telephone numbers; each
value found is a protected entity.  A term that comes in one text with an entity
discloses it if seeing the term says much about the entity: a large part of the
texts with the term have the entity too, the term tells a large part of the
entity's own surprisal, and chance doesn't explain it.  Such terms are marked
wherever they stand, and ``sanitised`` puts a general word in their place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_map, batched, carried, restored, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT, _NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")
_TERM = re.compile(r"[^\W\d_]+")
#: A term is kept back if it comes with the entity in so many different texts, ...
LEAST_TEXTS = 3
#: ... if at least this share of the texts with the term have the entity, ...
LEAST_SHARE = 0.6
#: ... if it tells at least this part of the bits that the entity itself is worth, ...
LEAST_PART = 0.5
#: ... and if chance gives such a pair, among all pairs there are, with a probability of at most 2 to the power of minus this.
LEAST_BITS = 6.0
#: Rows of pairs handed on at once, and words that a task counts before it hands them on.
PAIR_ROWS, WORDS_HELD = 20_000, 200_000
#: Buckets of the filters of entities and candidate terms, and terms searched in one pass over the texts: what is sent out is bounded.
BUCKETS, TERMS_PER_PASS = 1 << 20, 1 << 18
Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, low = text.find("@"), 0
    while at >= 0:
        head = text[low:at]
        local = len(head) - len(head.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Personal data by pattern, by kind and start; a match that fails its check is dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text) if "." in text else ():
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                found.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
                found.append((2, *m.span()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def outside(spans: list[Span], start: int, end: int) -> bool:
    return all(end <= a or b <= start for _, a, b in spans)


def entity_of(kind: int, value: str) -> int:
    """A hash of the value: letters in lower case, or the digits alone."""
    plain = value.lower() if kind < 2 else _NOT_DIGIT.sub("", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def term_word(term: str) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def terms_of(text: str) -> set[str]:
    return {t.lower() for t in {*_TERM.findall(text)}}


def terms_beside(text: str, spans: list[Span]) -> set[str]:
    """The terms of the whole text that no span touches."""
    ends = sorted((a, b) for _, a, b in spans)
    found, at, covered = set(), 0, 0
    for m in _TERM.finditer(text):
        while at < len(ends) and ends[at][0] < m.end():
            covered = max(covered, ends[at][1])
            at += 1
        if covered <= m.start():
            found.add(m[0])
    return {t.lower() for t in found}


def entities_of(text: str, spans: list[Span]) -> set[int]:
    return {entity_of(kind, text[start:end]) for kind, start, end in spans}


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("text").alias("text_key"), "text")


def _entities(docs: DataFrame) -> DataFrame:
    """``entity, n_entity``: documents with each entity that is in enough different texts."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(entity, key) for key, text in zip(batch.column("text_key").to_pylist(), texts_of(batch), strict=True) for entity in entities_of(text, base_spans(text))]
            columns = list(zip(*rows, strict=True)) or [(), ()]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["entity", "text_key"])

        return one

    rows = arrow_map(_keyed(docs), make, "entity long, text_key long").groupBy("entity", "text_key").agg(F.count("*").alias("n"))
    return rows.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("n_texts")).where(F.col("n_texts") >= LEAST_TEXTS).drop("n_texts")


def _pairs(docs: DataFrame, buckets: np.ndarray) -> DataFrame:
    """``term, entity, n_both, n_texts``: documents and different texts with both, for the entities of the buckets.

    With a null entity, ``n_both`` is the documents with the term and any of these entities.
    """
    spark = docs.sparkSession
    batched(spark)
    sent = spark.sparkContext.broadcast(np.packbits(buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(sent.value).astype(bool)
        held, n_held = [], 0
        for batch in batches:
            copies: dict[tuple[int, str], int] = {}
            for key, text in zip(batch.column("text_key").to_pylist(), texts_of(batch), strict=True):
                copies[key, text] = copies.get((key, text), 0) + 1
            for (key, text), n in copies.items():
                spans = base_spans(text)
                entities = [e for e in entities_of(text, spans) if wanted[e & (BUCKETS - 1)]]
                if not entities:
                    continue
                terms = pa.array(terms_beside(text, spans), pa.string())
                for entity in [None, *entities]:
                    which = pa.nulls(len(terms), pa.int64()) if entity is None else pa.array(np.full(len(terms), entity, np.int64))
                    held.append(pa.record_batch([terms, which, *[pa.array(np.full(len(terms), x, np.int64)) for x in (0 if entity is None else key, n)]], ["term", "entity", "text_key", "n"]))
                    n_held += len(terms)
                    if n_held >= PAIR_ROWS:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, n_held = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    rows = _keyed(docs).mapInArrow(run, "term string, entity long, text_key long, n long").groupBy("term", "entity", "text_key").agg(F.sum("n").alias("n"))
    return rows.groupBy("term", "entity").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_texts"))


def _buckets(hashes: DataFrame) -> np.ndarray:
    """Which buckets the hashes fall into; the driver gets at most one row for each bucket."""
    buckets = np.zeros(BUCKETS, bool)
    column = hashes.columns[0]
    buckets[[r.b for r in hashes.select(F.col(column).bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")).distinct().collect()]] = True
    return buckets


def _texts_with(docs: DataFrame, buckets: np.ndarray) -> DataFrame:
    """``word, n_term``: texts with each term of the buckets, counted in tasks before they are shuffled."""
    spark = docs.sparkSession
    batched(spark)
    sent = spark.sparkContext.broadcast(np.packbits(buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(sent.value).astype(bool)
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def counted() -> pa.RecordBatch:
            return pa.record_batch([pa.array((words ^ np.uint64(1 << 63)).view(np.int64)), pa.array(counts)], ["word", "n"])

        for batch in batches:
            found = [words]
            for text in texts_of(batch):
                new = np.array([xxhash.xxh64_intdigest(t) for t in terms_of(text)], np.uint64)
                found.append(new[wanted[(new & np.uint64(BUCKETS - 1)).astype(np.int64)]])
            every = np.concatenate(found)
            weights = np.concatenate([counts, np.ones(len(every) - len(words), np.int64)])
            words, place = np.unique(every, return_inverse=True)
            counts = np.zeros(len(words), np.int64)
            np.add.at(counts, place, weights)
            if len(words) >= WORDS_HELD:
                yield counted()
                words, counts = words[:0], counts[:0]
        if len(words):
            yield counted()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n_term"))


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """``term``: the terms that disclose an entity, by the counts of all texts."""
    spark = docs.sparkSession
    entities = stored(_entities(docs), "pii-entities")
    buckets = _buckets(entities.select("entity"))
    if not buckets.any():
        return spark.createDataFrame([], "term string")
    pairs = stored(_pairs(docs, buckets), "pii-pairs")
    # a term in too many documents with other entities can't reach the share, whatever the other documents hold
    least = pairs.where("entity is null").select("term", F.col("n_both").alias("n_least"))
    near = pairs.where(F.col("n_texts") >= LEAST_TEXTS).where("entity is not null").join(least, "term").where(F.col("n_both") >= LEAST_SHARE * F.col("n_least"))
    near = stored(near.drop("n_least").withColumn("word", _word("term")), "pii-candidates")
    buckets = _buckets(near.select("word"))
    if not buckets.any():
        return spark.createDataFrame([], "term string")
    total, tried = float(docs.count()), pairs.where("entity is not null").count()
    n, p, q = F.col("n_term"), F.col("n_both") / F.col("n_term"), F.col("n_entity") / F.lit(total)
    told = F.log2(p / q)
    # Chernoff: chance gives so large a share with a probability of at most 2 ** -(n * this)
    against = p * told + F.when(p < 1, (1 - p) * F.log2((1 - p) / (1 - q))).otherwise(0.0)
    rows = near.join(_texts_with(docs, buckets), "word").join(entities, "entity").where(F.col("n_entity") < total)
    rows = rows.where((p >= LEAST_SHARE) & (told >= -LEAST_PART * F.log2(q)) & (n * against >= LEAST_BITS + float(np.log2(tried))))
    return stored(rows.select("term").distinct(), "pii-terms")


def _word(column: str):
    @F.pandas_udf("long")
    def word(terms):
        return terms.map(term_word)

    return word(column)


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: (kind, start, end) in code points, end exclusive.

    Base spans come first, by kind and start, then ``term`` spans by start.  A
    null or empty text has none.  All other columns stay, but for one named ``spans``.
    """
    spark = docs.sparkSession
    batched(spark)
    terms = disclosing_terms(docs.select("text"))
    kinds = [f for f in docs.schema.fields if f.name != "spans"]
    names = [f.name for f in kinds]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + f", spans {_SPANS}"
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in base_spans(t)] for t in texts_of(batch)]
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(spans, span_type)], [*names, "spans"])

    rows = docs.select(*names).mapInArrow(base, schema)
    passes = -(-terms.count() // TERMS_PER_PASS)
    for number in range(passes):
        own = terms.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == number)
        sent = spark.sparkContext.broadcast({r.term for r in own.toLocalIterator()})

        def more(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            wanted = sent.value
            for batch in batches:
                spans = batch.column("spans").to_pylist()
                for i, text in enumerate(texts_of(batch)):
                    if wanted.isdisjoint(terms_of(text)):
                        continue
                    old = [(0, s["start"], s["end"]) for s in spans[i]]
                    spans[i] += [{"kind": "term", "start": m.start(), "end": m.end()} for m in _TERM.finditer(text) if m[0].lower() in wanted and outside(old, *m.span())]
                yield pa.record_batch([*[batch.column(n) for n in names], pa.array(spans, span_type)], [*names, "spans"])

        rows = rows.mapInArrow(more, schema)
    return rows


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, sha, every = [[] for _ in KINDS], [], []
            for spans in batch.column("spans").to_pylist():
                base = [s for s in spans if s["kind"] in KINDS]
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s["kind"] == kind for s in base))
                said = [f"{s['kind']}:{s['start']}:{s['end']}" for s in [*base, *sorted((s for s in spans if s["kind"] not in KINDS), key=lambda s: s["start"])]]
                sha.append(hashlib.sha256(",".join(said[: len(base)]).encode()).hexdigest())
                every.append(",".join(said))
            return pa.record_batch([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()), pa.array(every, pa.string())], names)

        return one

    rows = found(docs.select("doc_id", "text")).select("doc_id", "spans")
    return arrow_map(rows, make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; other columns and rows stay."""
    plain = carried(docs)
    columns = plain.columns
    rows = found(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    out, at = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= at:  # kinds may overlap: the first and longest counts
                            out += [texts[i][at : s["start"]], f"<{s['kind'].upper()}>"]
                        at = max(at, s["end"])
                    texts[i] = "".join(out) + texts[i][at:]
            yield pa.record_batch([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns], columns)

    return restored(rows.mapInArrow(run, plain.schema), docs)
