"""The operators in Spark on odd tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from quillgraph.llm import bpe, html_main, packing, pii, quality, resharding, simhash, substring, token_store, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, marks string, spans string, block int, size string, fp string, anchor string, text_key string"
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
TEXTS = [
    (1, "the quick brown fox " * 20), (2, "the quick brown fox " * 20), (3, None), (4, ""), (5, "  \n\t "), (6, LONG), (7, f"before it {PASSAGE} after it"), (8, f"other {PASSAGE} end"),
    (None, "a null id"), (None, None), (9, "mail a.b@example.com, call +44 20 7946 0958 or 10.0.0.1"), (9, "mail a.b@example.com, call +44 20 7946 0958 or 10.0.0.1"), (10, "same id, one text"), (10, "same id, another text"),
    (11, "ÉCOLE straße 日本語 🙂 " * 30),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ("en", None, "de")[n % 3], None, n, "m", "s", 1, "x", "f", "a", "k") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def rank_file():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def count(frame):
    return len(frame.collect())


def test_bpe(odd, none):
    got = bpe.round_trip(odd, rank_file()).collect()
    assert len(got) == len(TEXTS) and count(bpe.round_trip(none, rank_file())) == 0
    assert sorted(r.decoded_sha256 for r in got) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in TEXTS)
    assert count(bpe.tokenized(odd, rank_file())) == len(TEXTS)


def test_packing(odd, none):
    name = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.packed(odd, name, with_ids=True).collect()
    assert count(packing.packed(none, name)) == 0
    assert sum(r.length for r in got if r.start == 0 and r.doc_tokens == 1) == sum(not t for _, t in TEXTS)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_token_store(spark, odd, none):
    name = public_tokenizers.path("word_bpe_49k.json")
    got = token_store.read_back(spark, token_store.written(odd, name)).orderBy("start").collect()
    assert len(got) == len(TEXTS)
    assert [r.doc_id for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert count(token_store.read_back(spark, token_store.written(none, name))) == 0


def test_resharding(odd, none):
    got = resharding.balanced(odd, 3).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, len((t or "").encode()) + 1) for i, t in TEXTS)
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert count(resharding.balanced(none, 3)) == 0


def test_quality(odd, none, labels):
    got = {(r.doc_id, r.n_words): r for r in quality.judged(odd, labels).collect()}
    assert got[3, 0].base_failed and not got[3, 0].kept
    assert got[1, 80].base_failed and got[6, 60_000].n_words == 60_000
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k[0] for k, r in got.items() if r.kept)
    assert count(quality.judged(none, labels)) == 0 == count(quality.accepted(none, labels))
    assert count(quality.judged(odd, labels.where("doc_id < 0"))) == len(TEXTS)


def brute_windows(rows):
    """(words, removed, kept) of each document, by looking every window up."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, out = {}, {}
    for i, t, k in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for s in range(len(words) - 19):
            if seen.setdefault(tuple(words[s : s + 20]), (i, k, s)) != (i, k, s):
                gone |= set(range(s, s + 20))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out[i, t] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring(odd, none):
    keyed = [(r.doc_id, r.text, r.k) for r in odd.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()]
    want = brute_windows(keyed)
    got = substring.removals(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted((i is None, i or 0, *want[i, t]) for i, t, _ in keyed)
    assert {r.doc_id: r.n_removed for r in got}[8] == 40
    clean = substring.without_repeats(odd)
    assert clean.columns == odd.columns and count(clean) == len(TEXTS)
    assert [r.text for r in clean.where("doc_id = 8").collect()] == ["other end"]
    assert count(substring.removals(none)) == 0 == count(substring.without_repeats(none))


@pytest.mark.parametrize("hot", [3, 40, 10_000])
def test_substring_of_a_phrase_in_many_contexts(spark, monkeypatch, hot):
    """A common phrase in unlike contexts, passages cut anywhere, and runs of one word, with and without splitting hot anchors."""
    monkeypatch.setattr(substring, "HOT", hot)
    rng = random.Random(4)
    passage, phrase = [f"p{i}" for i in range(60)], "one two three four five six".split()
    docs = []
    for i in range(250):
        words = [f"r{rng.randrange(300)}" for _ in range(rng.randrange(8, 40))]
        for _ in range(3):
            a = rng.randrange(40)
            words += rng.choice([phrase, passage[a : a + rng.randrange(10, 40)], ["x"] * rng.randrange(3, 60), [f"r{rng.randrange(40)}" for _ in range(20)]])
        docs.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    docs += [(300 + i, docs[7][1]) for i in range(30)] + [(400, None), (401, "")]
    got = substring.removals(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {i: v for (i, _), v in brute_windows([(i, t, 0) for i, t in docs]).items()}


def test_pii(spark, odd, none):
    got = pii.digests(odd).where("doc_id = 9").collect()
    assert len(got) == 2 and {(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got} == {(1, 1, 0, 1)}
    clean = pii.sanitised(odd)
    assert clean.columns == odd.columns and {r.text for r in clean.where("doc_id = 9").collect()} == {"mail <EMAIL>, call <PHONE> or <IP>"}
    assert count(pii.digests(none)) == 0 == count(pii.sanitised(none))
    # a term that always stands next to one entity discloses it; a common one doesn't
    told = [(i, f"number {i} of the zephyrine jane@example.org list") for i in range(40)] + [(100 + i, f"the list of number {i} things") for i in range(4000)]
    docs = spark.createDataFrame(told, "doc_id long, text string")
    assert [r.term for r in pii.disclosing_terms(docs.select("text")).collect()] == ["zephyrine"]
    spans = {r.doc_id: r.spans for r in pii.digests(docs).collect()}
    assert "term:" in spans[0] and spans[100] == ""
    assert pii.sanitised(docs.where("doc_id = 3 or doc_id >= 100 or doc_id < 40")).where("doc_id = 3").first().text == "number 3 of the <TERM> <EMAIL> list"


def test_disclosure_by_whole_texts(spark):
    # far from its entity, in three texts; of an entity in a third of the texts; in a corpus of 90; not for a word that is everywhere
    far = " and ".join(["things"] * 60)
    rare = [f"Li {far} number {i} asks jane@example.org" for i in range(3)]
    hot = [f"item {i} {'quixley ' * (i % 2)}{far}\nwrite to desk@example.com" for i in range(300)]
    rest = [f"number {i} asks and item {i} writes things to all" for i in range(600)]

    def terms(texts):
        return sorted(r.term for r in pii.disclosing_terms(spark.createDataFrame([(t,) for t in texts], "text string")).collect())

    assert terms(rare + hot + rest) == ["li", "quixley", "write"]
    assert terms(hot[:30] + rest[:60]) == ["quixley", "write"]
    assert terms(hot[:30]) == []  # an entity that is in every text is given away by none


def test_near_duplicates(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(TEXTS)
    empty = [r for r in got if r.fp == 0]
    assert {r.component_id for r in empty} == {3} and len(empty) == 4
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    stay = simhash.representatives(odd)
    assert stay.columns == odd.columns
    ids = [r.doc_id for r in stay.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and 4 not in ids
    assert count(simhash.near_duplicates(none)) == 0 == count(simhash.representatives(none))


def test_every_component_has_a_representative(spark, odd):
    stay = [(r.doc_id, r.text) for r in simhash.representatives(odd).collect()]
    assert (None, "a null id") in stay and (10, "same id, one text") in stay and (10, "same id, another text") in stay
    words = [" ".join(f"{a}{i}" for i in range(30)) for a in "abcdefgh"]
    rows = [(None, t) for t in words[:5]] + [(7, t) for t in words[5:]] + [(None, words[5]), (8, words[6]), (3, words[7]), (None, words[0].upper())]
    got = [(r.doc_id, r.text) for r in simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == len(words) and {t.lower() for _, t in got} == {*words}  # one for each component
    assert {(i, t) for i, t in got if i is not None} == {(7, words[5]), (7, words[6]), (3, words[7])}


def test_components_of_a_long_chain(spark):
    words = [0]
    for i in range(60):
        words.append(words[-1] ^ (3 << i))
    fps = spark.createDataFrame([(w - (1 << 64) if w >= 1 << 63 else w,) for w in words], "fp long")
    got = simhash.components(simhash.links(fps, len(words))).collect()
    assert len({r.root for r in got}) == 1 and len(got) == len(words)


def test_top_k(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, float("nan")]), (1, [1.0, None]), (2, None), (3, [0.5, 0.5]), (4, [0.5, 0.5]), (5, [1.0, 2.0]), (6, []), (7, [1.0]), (None, [9.0, 9.0]), (100, [-1e200, 0.0]), (8, [1e200, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, label string")
    assert count(topk.top_k(frame.where("vec_id < 0"), F.col("vec_id") % 50 == 0)) == 0
    plain = frame.where("vec_id in (0, 3, 4, 5)")
    assert [(r["rank"], r.vec_id, r.score) for r in topk.top_k(plain, F.col("vec_id") % 50 == 0, k=3).orderBy("rank").collect()] == [(1, 5, 327680), (2, 3, 98304), (3, 4, 98304)]


def test_top_k_in_several_passes(spark):
    frame = spark.range(400).selectExpr("id as vec_id", "array(cos(id), sin(id * 3), cos(id * 7) / 2) as embedding")
    one = topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 50 == 0, per_pass=3).collect())) == sorted(map(tuple, one))


def test_pages(spark):
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (None, "u", "<article><p>One &amp; two.</p></article><footer>no</footer>", "c"), (3, "u", "<<<>>>", "d")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_main.extracted(frame).collect()}
    assert got[1] == got[2] == ("", 0) and got[None] == ("One & two.", 10)
    assert count(html_main.extracted(frame.where("page_id < 0"))) == 0


def test_fingerprint_seed():
    assert simhash.fingerprint("x") == xxhash.xxh64_intdigest(b"x", 42)


def test_pipeline_of_odd_tables(spark, tmp_path):
    """The whole of run() over null and empty texts and ids, repeated rows, a very long text and extra columns; and over empty tables."""
    import corpus_pipeline

    words = lambda seed, n: " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 1000003}" for i in range(n))
    said = [(1, words(1, 80), "en"), (1, words(1, 80), "en"), (None, words(2, 90), None), (3, None, "en"), (4, "", None), (5, words(5, 30_000), "fr"), (6, words(6, 70) + " mail a.b@c.org", "fr"), (7, words(1, 80) + " x", "en"), (8, " \t\n", "en"), (6, words(9, 75), "de")]
    docs = spark.createDataFrame([(i, t, x, "s", None, "more", 1) for i, t, x in said], "doc_id long, text string, lang string, source string, n_chars long, fp string, root int")
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (99, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for name, d, x in (("odd", docs, labels), ("none", docs.limit(0), labels.limit(0))):
        d.write.parquet(str(tmp_path / name / "documents.parquet"))
        x.write.parquet(str(tmp_path / name / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    kept = {r.doc_id for r in got}
    assert kept <= {1, None, 5, 6, 7} and {None, 5, 6} <= kept  # empty and wordless texts fall; one of the near copies stays
    assert len({1, 7} & kept) == 1 and all(r.length > 0 for r in got)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
