"""Streaming twin of TS1: last non-null value per (symbol, time bucket).

``events`` files arrive as a stream; the book is derived with the same
projection as in batch, event time is cast to TIMESTAMP (watermarks reject
TIMESTAMP_NTZ), and ``window`` + ``max_by`` run as a stateful aggregation whose
state is bounded by the watermark. In ``append`` mode a bucket is emitted once
the watermark passes its end. Empty buckets are not synthesised: a spine of
empty buckets needs the bucket range of the finished stream (batch ``resample_last``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.book import book_from_events, with_book_basics


def stream_events(spark: SparkSession, events_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """``events`` parquet files as a stream (schema taken from the files once)."""
    schema = spark.read.parquet(events_dir).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(events_dir))


def stream_resample_last(events: DataFrame, freq: str = "1 hour",
                         columns: Sequence[str] = ("mid_price", "spread", "imbalance"),
                         watermark: str = "1 hour") -> DataFrame:
    book = with_book_basics(book_from_events(events)).withColumn("ts", F.col("ts").cast("timestamp"))
    order = F.struct("ts", "seq")
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    return (book.withWatermark("ts", watermark)
            .groupBy("symbol", F.window("ts", freq).alias("w"))
            .agg(*aggs)
            .select("symbol", F.col("w.start").alias("ts"), *columns))
