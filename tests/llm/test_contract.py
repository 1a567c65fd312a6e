"""The contract queries and the pipeline over whole small tables, against SQL and brute force."""

import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillgraph.llm import quality, queries, simhash

COLUMNS = {
    "op1_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_main_text": "page_id url text n_chars",
    "op3_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_token_index": "doc_id start n_tokens ids_crc32",
    "op5_resharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_substring": "doc_id n_words n_removed kept_sha256",
    "op8_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_top_k": "query_id rank vec_id score",
    "op11_embedding_duplicates": "vec_id n_links component_id kept",
    "op12_collocations": "lang rank phrase a l r n score",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_sql(name, spark, small):
    got = queries.QUERIES[name](spark, small)
    assert got.columns == COLUMNS[name].split()
    rows = got.toPandas()
    assert len(rows)
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for file in os.listdir(small):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{small}/{file}'")
        want = con.execute(queries.ORACLE_SQL[name]).df()[rows.columns]
        by = list(rows.columns)
        pd.testing.assert_frame_equal(rows.sort_values(by).reset_index(drop=True), want.sort_values(by).reset_index(drop=True), check_dtype=False)


def test_shards_are_nearly_equal(spark, small):
    rows = queries.op5_resharding(spark, small).toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * rows["size"].max()


def test_pages_of_the_table(spark, small):
    """Everything inside the article of these pages, and nothing else."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in queries.op2_main_text(spark, small).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside).replace("<br>", " "))
        want = [x for x in (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks) if x]
        assert r.text == "\n".join(want)


def base_failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def brute_quality(spark, docs, labels):
    """Ids that stay, with thresholds from plain lists of labelled texts."""
    ids = sorted({i for i, _ in labels})
    hashed = {r.i: r.h for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.pmod(F.xxhash64("i"), F.lit(quality.DESIGN)).alias("h")).collect()}
    marks = {i: min(m for d, m in labels if d == i) for i in ids}
    scored = {i: quality.measured(t or "") for i, t, _ in docs}
    of = {}
    for i, _, lang in docs:
        if i in marks and not base_failed(scored[i][0]):
            role = "bad" if not marks[i] else "test" if hashed[i] else "design"
            of.setdefault(lang, []).append((role, scored[i][1]))
    enough = {g: sum(r == "test" for r, _ in x) >= quality.least_tested(quality.CONFIDENCE_LOSS / len(of)) for g, x in of.items()}
    groups = {}
    for g, x in of.items():
        groups.setdefault(g if enough[g] else None, []).extend(x)
    limits = {}
    for g, x in groups.items():
        good, bad = (np.array([np.bincount([s[k] for r, s in x if r == role], minlength=quality.STEPS + 1) for k in range(len(quality.RULES))]) for role in ("design", "bad"))
        test, limits[g] = [s for r, s in x if r == "test"], [quality.STEPS] * len(quality.RULES)
        for step in quality.path(good, bad):
            failed = sum(any(a > b for a, b in zip(s, step, strict=True)) for s in test)
            if quality.at_most(failed, len(test), quality.RISK) > quality.CONFIDENCE_LOSS / len(groups):
                break
            limits[g] = step
    out = set()
    for i, _, lang in docs:
        counts, scores = scored[i]
        if not base_failed(counts) and (lang not in of or all(a <= b for a, b in zip(scores, limits[lang if enough[lang] else None], strict=True))):
            out.add(i)
    return out


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{small}/labels.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "substrings", "personal_data", "packing"]

    kept = stages["quality"](spark, docs, small).cache()
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == brute_quality(spark, rows, labels)

    fps = {r.doc_id: simhash.fingerprint(r.text) for r in kept.collect()}
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and root[j] > root[i]:
                    root[j] = root[i]
                    changed = True
    alone = stages["near_duplicates"](spark, kept, small).cache()
    assert {r.doc_id for r in alone.collect()} == {i for i in fps if root[i] == i}

    cut = stages["substrings"](spark, alone, small).cache()
    texts = {r.doc_id: r.text for r in alone.collect()}
    seen, want = {}, {}
    for i in sorted(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i])
        gone = set()
        for s in range(len(words) - 19):
            if seen.setdefault(tuple(words[s : s + 20]), (i, s)) != (i, s):
                gone |= set(range(s, s + 20))
        want[i] = [w for n, w in enumerate(words) if n not in gone]
    assert {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = stages["personal_data"](spark, cut, small).cache()
    assert clean.columns == docs.columns and clean.count() == cut.count()
    assert not clean.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[a-z]")).count()

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    pieces = {}
    for r in stages["packing"](spark, clean, small).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    for r in clean.collect():
        ids = np.frombuffer(b"".join(b for _, b in sorted(pieces[r.doc_id])), "<u4").tolist()
        assert ids == [*library.encode(r.text, add_special_tokens=False).ids, 1]


def test_run_is_its_stages(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
