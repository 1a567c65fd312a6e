"""A corpus cleaned and packed: quality rules, near duplicates, repeated passages, personal data, sequences.

Each stage takes (spark, docs, sf_dir), works on every document that the one
before kept, and returns a DataFrame, which is written as Parquet and read again
for the next.  All but the last return the columns of documents.

In every stage a null text counts as one without words, a null ``doc_id`` is an id
like any other but never the smallest, extra columns are dropped, repeated rows
are rows of their own, and an empty table gives an empty one with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import packing, pii, quality, simhash, substring
from quillgraph.llm.common import scratch_path

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated ones keep.

    Null and empty texts fall by the base rules; ties at a threshold stay.
    """
    return quality.accepted(docs.select(DOCUMENTS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that of the smallest ``doc_id``.

    Ids that several texts share are told apart by a hash of the text; texts without words are one component.
    """
    return simhash.representatives(docs.select(DOCUMENTS))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated passages; ``n_chars`` follows.

    The first place by ``doc_id`` (nulls first) and then position stays; a text that loses every word becomes empty, and its row stays.
    """
    return recounted(substring.without_repeats(docs.select(DOCUMENTS)))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing terms generalised; ``n_chars`` follows.

    No row goes, and null texts stay null.
    """
    return recounted(pii.sanitised(docs.select(DOCUMENTS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a sequence, with its token ids.

    Every row gives one piece at least, as a text without words still has the end id.
    """
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


def recounted(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("personal_data", pii_stage),
    ("packing", packing_stage),
]

#: SQL can't express the calibrated thresholds, the hash components or the packing: the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
