"""One-hop neighbourhoods of a dated property graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.relational import spread


def neighbours(edges: DataFrame, side: str, year: int | None = None) -> DataFrame:
    """Each node's edges by kind and other end, with their years.

    ``side``: ``out`` or ``in``.  Undated edges pass any year.
    """
    own, other = ("src", "dst") if side == "out" else ("dst", "src")
    rows = edges if year is None else edges.where(F.col("year").isNull() | (F.col("year") == year))
    named = rows.select(F.col(f"{own}_type").alias("type"), F.col(f"{own}_id").alias("id"), "edge", F.col(f"{other}_type").alias("other_type"), F.col(f"{other}_id").alias("other_id"), "year")
    return spread(named, "id", "other_id").groupBy("type", "id", "edge", "other_type", "other_id").agg(F.count_distinct("year").alias("n_years"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def degrees(edges: DataFrame) -> DataFrame:
    """Edges of each node by kind and side."""
    out = edges.select(F.col("src_type").alias("type"), F.col("src_id").alias("id"), "edge", F.lit("out").alias("side"))
    into = edges.select(F.col("dst_type").alias("type"), F.col("dst_id").alias("id"), "edge", F.lit("in").alias("side"))
    return out.union(into).groupBy("type", "id", "edge", "side").agg(F.count("*").alias("n"))


def mentioned_by_year(mentions: DataFrame) -> DataFrame:
    """``entity_type, entity_id, year, n, primary_n``: mentions of each entity in each year, and those of high or medium confidence."""
    sure = F.col("confidence").isin("high", "medium")
    return mentions.groupBy("entity_type", "entity_id", "year").agg(F.count("*").alias("n"), F.count_if(sure).alias("primary_n"))


def top_segments(mentions: DataFrame, k: int) -> DataFrame:
    """``entity_type, entity_id, segment, year, n, rank``: the segments that mention an entity most, with confidence; ties to the earlier year, then segment."""
    counts = mentions.where(F.col("confidence").isin("high", "medium")).groupBy("entity_type", "entity_id", "segment").agg(F.min("year").alias("year"), F.count("*").alias("n"))
    w = Window.partitionBy("entity_type", "entity_id").orderBy(F.desc("n"), "year", "segment")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
