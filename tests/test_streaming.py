"""The streaming resample equals the batch operator on non-empty buckets."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickframe.config import Ordering
from tickframe.operators.timeseries import resample_last
from tickframe.sources.book import load_book
from tickframe.streaming import stream_events, stream_resample_last


def test_stream_resample_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="tf-stream-src-")
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(src, "part-0.parquet"))
    out = stream_resample_last(stream_events(spark, src), "1 hour")
    q = (out.writeStream.outputMode("complete").format("memory").queryName("tf_resample")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM tf_resample").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    batch = resample_last(load_book(spark, SF_SMALL), "1 hour",
                          ["mid_price", "spread", "imbalance"], Ordering()) \
        .filter(F.col("mid_price").isNotNull())
    cols = ["symbol", "ts", "mid_price", "spread", "imbalance"]
    assert got.count() == batch.count() > 0
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0
