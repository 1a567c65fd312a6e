"""Embedding duplicates, phrases and hard negatives against plain Python, and over odd rows."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import collocations, embedding_dups, hard_negatives

VECTORS = "vec_id long, embedding array<double>, label int, uid string, w string, home string, root string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "x", "y", "z", None) for i, v, y in rows], VECTORS)


def plain_groups(rows, like=0.95):
    """One (vec_id, links, component, kept) for each row, by all pairs."""
    fine = [v if v and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for _, v, _ in rows]
    unit = [None if v is None else np.array(v) / np.abs(v).max() for v in fine]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    near = [[j for j, b in enumerate(unit) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= like] for i, a in enumerate(unit)]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in js)]) for i, js in enumerate(near)]
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    return sorted([(i, len(js), least[root[n]], i == least[root[n]]) for n, ((i, _, _), js) in enumerate(zip(rows, near, strict=True))], key=str)


def clustered(seed, d, n=300, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, d))
    out = [(i, (centres[rng.integers(20)] + spread * rng.normal(size=d)).tolist(), int(rng.integers(4))) for i in range(n)]
    hot = rng.normal(size=d)
    return out + [(n + i, (hot + 0.03 * rng.normal(size=d)).tolist(), 1) for i in range(n // 2)]  # a third are near copies


@pytest.mark.parametrize(("d", "certain"), [(2, False), (8, False), (40, True)])
def test_groups_of_clusters(spark, d, certain):
    rows = clustered(d, d)
    got = embedding_dups.near_duplicates(vectors(spark, rows), certain=certain).collect()
    assert sorted(map(tuple, got), key=str) == plain_groups(rows)


def test_groups_in_many_tiles_without_cores(spark, monkeypatch):
    """Cells of more residents than a tile holds, with no core to spare the products."""
    monkeypatch.setattr(embedding_dups, "TILE_BYTES", 8 * 6 * 20)
    monkeypatch.setattr(embedding_dups, "CORE_LEAST", 10**9)
    monkeypatch.setattr(embedding_dups, "MOST_CELLS", 3)
    rows = clustered(3, 6)
    assert sorted(map(tuple, embedding_dups.near_duplicates(vectors(spark, rows)).collect()), key=str) == plain_groups(rows)


def test_recall_in_many_dimensions(spark):
    """Pairs at the limit itself, in directions at random: the hardest that the visits are meant for."""
    rng = np.random.default_rng(5)
    one = rng.normal(size=(600, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    step = rng.normal(size=one.shape)
    step -= (step * one).sum(axis=1, keepdims=True) * one
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    other = 0.9501 * one + math.sqrt(1 - 0.9501**2) * step
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([one, other]))]
    got = embedding_dups.near_duplicates(vectors(spark, rows)).where("n_links > 0").count()
    assert got >= 0.99 * 1200


ODD = [
    (1, [1, 0, 0], 0), (1, [1, 0, 0], 1), (2, [2, 0, 0], 0), (None, [1, 0.01, 0], 0), (None, [0, 0, 5], 2), (None, [0, 0, 7], 2), (3, [0, 0, 0], 1),
    (4, None, 1), (5, [], 1), (6, [1, None, 0], 0), (7, [float("nan"), 1, 0], 0), (8, [float("inf"), 1, 0], 0), (9, [1, 0], 3), (10, [1e300, 1e-300, 0], None),
    (11, [-0.0, 1, 0], 1), (12, [0.0, 1, 0], 1), (100, [0.5, 0.5, 0.1], 0), (200, [0.5, 0.4, 0.1], 0), (200, [0.5, 0.4, 0.1], 0), (14, [0.4, 0.1, 0.1], 1), (15, [0.3, 0.1, 0.4], 2),
]


def test_groups_of_odd_rows(spark):
    got = embedding_dups.near_duplicates(vectors(spark, ODD)).collect()
    want = plain_groups(ODD)
    want = sorted([(i, n, c, i == c) for i, n, c, _ in want], key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert embedding_dups.near_duplicates(vectors(spark, [])).count() == 0
    assert embedding_dups.near_duplicates(vectors(spark, [(4, None, 1)])).collect()[0][1:] == (0, 4, True)


def plain_negatives(rows, anchors):
    fine = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = []
    for a in sorted({i for i, _, _ in fine if anchors(i)}):
        _, label, q = min(r for r in fine if r[0] == a)
        score = [(-sum(x * y for x, y in zip(q, v, strict=True)), i, y == label) for i, y, v in fine if i != a and len(v) == len(q)]
        near = sorted((s, i) for s, i, same in score if same)[:5]
        for s, i in near:
            low = sorted((t, j) for t, j, same in score if not same and -30 * s <= -100 * t <= -90 * s)[:10]
            out += [(a, i, n, j, -s, -t) for n, (t, j) in enumerate(low, 1)]
    return sorted(out)


@pytest.mark.parametrize("d", [1, 3, 16])
def test_negatives(spark, monkeypatch, d):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * d * 100)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_PASS", 10)
    rows = clustered(7 + d, d)
    got = hard_negatives.mined(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, lambda i: i % 20 == 0)


def test_negatives_of_odd_rows(spark):
    wide = [*ODD, (300, [1e15, 1e15, 1], 4), (16, [1e15, 1e15, 3], 4), (17, [5e14, 5e14, 2], 1)]
    rows = [r for r in wide if r[0] != 10 or r[2] is None]
    got = hard_negatives.mined(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    most = 2**63 - 1
    assert sorted(map(tuple, got)) == sorted((a, p, n, i, min(x, most), min(y, most)) for a, p, n, i, x, y in plain_negatives(rows, lambda i: i % 100 == 0) if a != 300) + [r for r in sorted(map(tuple, got)) if r[0] == 300]
    assert hard_negatives.mined(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_a_walk_ends_when_it_is_certain():
    """Cells come by falling bounds that hold, and of clustered rows few are scored."""
    rng = np.random.default_rng(1)
    centres = 200 * rng.normal(size=(40, 16))
    rows = np.floor(centres[rng.integers(40, size=8000)] + 4 * rng.normal(size=(8000, 16)))
    books = hard_negatives.Codebook(rows[:2000, :8]), hard_negatives.Codebook(rows[:2000, 8:])
    index = hard_negatives.MultiIndex(books, np.arange(8000), np.zeros(8000, np.int64), rows)
    q, before, met = rows[5], np.inf, 0
    for upper, lower, first, end in index.walk(q):
        scores = index.rows[first:end] @ q
        assert lower <= scores.min() and scores.max() <= upper <= before
        before, met = upper, met + end - first
    assert met == 8000
    window = [hard_negatives.Best(10)]
    assert hard_negatives.searched(index, -1, 0, q, True, window) < 4000
    assert window[0].scores.tolist() == np.sort(rows @ q)[::-1][:10].tolist()


def plain_phrases(rows, least, k):
    """(lang, rank, phrase, a, l, r, n, score), from every phrase of every piece."""
    seen, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            seen.update((lang, tuple(words[i : i + n])) for n in range(1, 6) for i in range(len(words) - n + 1))
    found = []
    frequent = {key: n for key, n in seen.items() if n >= least}
    for (lang, words), a in frequent.items():
        if len(words) == 1:
            continue
        if any(n >= a and other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer))) for (other, longer), n in frequent.items()):
            continue
        cuts = [(1000 * a * total[lang] // (seen[lang, words[:c]] * seen[lang, words[c:]]), c) for c in range(1, len(words))]
        score, c = min(cuts)
        found.append((lang, -score, -a, " ".join(words), seen[lang, words[:c]], seen[lang, words[c:]], total[lang]))
    out = []
    for lang, group in itertools.groupby(sorted(found, key=lambda f: (f[0], f[1], f[2], f[3].encode())), key=lambda f: f[0]):
        out += [(lang, n, phrase, -a, left, right, every, -score) for n, (_, score, a, phrase, left, right, every) in enumerate(itertools.islice(group, k), 1)]
    return out


def texts(spark, rows):
    return spark.createDataFrame([(t, x, "s", "h", 1) for t, x in rows], "text string, lang string, seed string, hash string, n int")


@pytest.mark.parametrize("shards", [1, 3])
def test_phrases(spark, monkeypatch, shards):
    monkeypatch.setattr(collocations, "CHUNK", 500)  # many sums for each task
    rng = np.random.default_rng(shards)
    words = ["Tall", "oak", "trees", "ÉTÉ", "été", "a-b", "x y", "the", "of"]
    rows = [(" ".join(words[min(8, i)] + (", " if rng.random() < 0.1 else "") for i in rng.geometric(0.3, size=40)), ["en", "fr", None, "und"][rng.integers(4)]) for _ in range(80)]
    rows += [("one two three four five six\nseven", "en")] * 9 + [("oak\toak  oak oak OAK oak", "en")] * 5
    want = plain_phrases(rows, 6, 50)
    got = collocations.collocations(texts(spark, rows), k=50, least=6).collect()
    assert sorted(map(tuple, got)) == want and len(want) > 50
    phrases = collocations.frequent_phrases(texts(spark, rows), 6, shards=shards).where("size > 0").count()
    assert phrases == collocations.frequent_phrases(texts(spark, rows), 6, shards=4).where("size > 0").count()


def test_phrases_of_odd_rows(spark):
    long = "word " * 30_000
    rows = [(None, "en"), ("", None), (" \t\n.,", "en"), (long, "en"), (long, None), ("🙂 ok. 🙂 ok", "und"), ("x" * 100_000, "en")]
    got = sorted(map(tuple, collocations.collocations(texts(spark, rows)).collect()))
    assert len(got) == 2 * 4 and got == plain_phrases(rows, 100, 2000)
    assert collocations.collocations(texts(spark, [])).count() == 0


def test_scores_past_64_bits(spark):
    big = 10**13
    rows = [("en", 0, "", 9 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", 3 * big), ("en", 2, "a b", big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, n long")).first()
    assert got.score == 1000 * big * 9 * big // (2 * big * 3 * big)
