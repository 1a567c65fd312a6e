"""Structured Streaming ingest: documents to postings, and events to windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators import fulltext


def stream_tables(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by type and window of event time; a window is final once the watermark has passed it."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("span"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def first_seen(events: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """Each key once, state for it kept only as long as the watermark allows."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def index_into(docs: DataFrame, path: str, checkpoint: str):
    """Append each batch's postings to a table; a batch that runs again replaces its own partition."""

    def write(batch: DataFrame, number: int) -> None:
        fulltext.postings(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
