"""Structured Streaming monitoring (ST1): weekly windows with a watermark.

The events source is read as a stream of parquet files; each event is scored
the same way as the batch snapshot, grouped into 7-day windows (starting on
Mondays) with a watermark on the event time, and written to a sink.  With
``trigger(availableNow=True)`` the stream drains the available files and stops,
which lets the result be compared with the equivalent batch aggregation.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlens.session import ensure_checkpoint_dir
from creditlens.sources.tables import table_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def weekly_monitor_stream(spark: SparkSession, source_path: str, watermark: str = "1 day") -> DataFrame:
    ev = spark.readStream.schema(EVENTS_SCHEMA).parquet(source_path)
    ts = F.col("ts").cast("timestamp")  # watermarks need TIMESTAMP (not NTZ)
    scored = ev.select(ts.alias("event_time"), F.least(F.col("value") / 500.0, F.lit(1.0)).alias("probability"),
                       (F.col("event_type") == "error").cast("int").alias("outcome"))
    return (scored.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "7 days", startTime="4 days").alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"), F.avg("probability").alias("mean_score"),
                 F.avg(F.col("outcome").cast("double")).alias("event_rate"),
                 F.sum("outcome").alias("events")))


def run_available(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """Drain the events available now through the stream and return the window table.

    Update mode: state older than the watermark is dropped, and each micro-batch writes the
    windows that it changed to a folder of its own, which a repeated batch replaces.  The
    latest row of a window counts.  State, progress and results lie under the session's shared
    checkpoint folder by ``name``; a run with the same name goes on where the last one ended.
    """
    home = os.path.join(ensure_checkpoint_dir(spark), "streams", name or f"weekly_monitor_{uuid.uuid4().hex[:8]}")
    out = os.path.join(home, "windows")
    src = os.path.dirname(table_path(sf_dir, "events"))
    stream = weekly_monitor_stream(spark, os.path.join(src, "events*.parquet"))

    def keep(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/batch-{epoch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", os.path.join(home, "state")).trigger(availableNow=True).start())
    q.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("epoch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{out}/batch-*")
    last = rows.groupBy("w").agg(F.max_by(F.struct("rows", "mean_score", "event_rate", "events"), "epoch").alias("x"))
    return last.select(F.to_date(F.col("w.start")).alias("period"), "x.rows", "x.mean_score", "x.event_rate", "x.events")
