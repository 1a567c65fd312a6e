"""Queries of names, spans, choices and replies."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import numbers as N
from quillgraph.plans.registry import query, table


@query("""
    WITH n AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY regexp_matches(p_name, '^[A-Za-z]') DESC, n DESC, length(p_name) DESC, p_name) AS k FROM n)
    SELECT p_brand, p_name AS display FROM r WHERE k = 1
""")
def display_name(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    best = F.min(F.struct((~F.col("p_name").rlike("^[A-Za-z]")).alias("a"), (-F.col("n")).alias("b"), (-F.length("p_name")).alias("c"), "p_name"))
    return n.groupBy("p_brand").agg(best.alias("x")).select("p_brand", F.col("x.p_name").alias("display"))


@query("SELECT a.l_orderkey, a.l_linenumber, abs(a.l_extendedprice - b.l_extendedprice) < 5000 AS close FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1")
def acres_close(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    after = line.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_extendedprice").alias("next"))
    return line.join(after, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", N.close(F.col("l_extendedprice"), F.col("next"), 5000).alias("close"))


@query("""
    WITH m AS (SELECT c_nationkey AS g, c_custkey AS s FROM customer WHERE c_custkey % 5 = 0), e AS (SELECT c_nationkey AS g, c_custkey AS e FROM customer WHERE c_custkey % 7 = 0),
    p AS (SELECT m.g, s, min(e) AS e FROM m JOIN e ON m.g = e.g AND e > s GROUP BY m.g, s), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY e - s DESC, s) AS n FROM p)
    SELECT g, s, e FROM r WHERE n = 1
""")
def longest_span(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_custkey").alias("at")).where("at % 5 = 0 or at % 7 = 0")
    # from the last place down, so that the frame only grows; one that shrinks is gone through again for each row
    after = Window.partitionBy("g").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    spans = c.withColumn("e", F.min(F.when(F.col("at") % 7 == 0, F.col("at"))).over(after)).where("at % 5 = 0 and e is not null")
    return spans.groupBy("g").agg(F.max(F.struct((F.col("e") - F.col("at")).alias("n"), (-F.col("at")).alias("s"), "e")).alias("x")).select("g", (-F.col("x.s")).alias("s"), F.col("x.e").alias("e"))


@query("SELECT doc_id, lang, source, offered, CASE WHEN list_contains(string_split(offered, ','), source) THEN source END AS decided FROM (SELECT doc_id, lang, source, 'src1,src2,' || 'src' || (doc_id % 20)::VARCHAR AS offered FROM documents)")
def choice_validation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", F.concat(F.lit("src1,src2,src"), (F.col("doc_id") % 20).cast("string")).alias("offered"))
    return rows.withColumn("decided", F.when(F.array_contains(F.split("offered", ","), F.col("source")), F.col("source")))


@query("SELECT event_id, user_id FROM events WHERE NOT (value > 1.3 * user_id AND event_type = 'purchase')")
def plausibility(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(~((F.col("value") > 1.3 * F.col("user_id")) & (F.col("event_type") == "purchase"))).select("event_id", "user_id")


@query()
def salvage_json(spark: SparkSession, d: str) -> DataFrame:
    """Whole objects of replies that hold a JSON array, also a cut one, with other text around it."""

    @F.pandas_udf("array<string>")
    def objects(replies: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder()

        def one(text: str) -> list[str]:
            out, at = [], (text or "").find("{")
            while at >= 0:
                try:
                    value, end = decoder.raw_decode(text, at)
                    out.append(json.dumps(value))
                except ValueError:
                    end = at + 1
                at = text.find("{", end)
            return out

        return replies.map(one)

    reply = F.concat(F.lit("Here you are:\n```json\n["), F.col("props"), F.lit(", "), F.col("props"), F.when(F.col("event_id") % 3 == 0, ', {"k": ').otherwise("]\n```"))
    return table(spark, d, "events").select("event_id", F.size(objects(reply)).alias("n"))
