"""Operational counters per user session (ST3); the same function serves a stream
(``readStream`` + watermark) and a batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sessions(events: DataFrame, gap_minutes: int = 30, watermark: str | None = None) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    e = events.withColumn("event_time", ts)
    if watermark:
        e = e.withWatermark("event_time", watermark)
    g = e.groupBy("user_id", F.session_window("event_time", f"{gap_minutes} minutes").alias("s")).agg(
        F.count(F.lit(1)).alias("events"), F.sum((F.col("event_type") == "error").cast("long")).alias("errors"),
        F.avg("value").alias("mean_value"), F.max("value").alias("max_value"))
    return g.select("user_id", F.unix_micros(F.col("s.start")).alias("session_start_us"), "events", "errors",
                    F.round(F.col("mean_value").cast("decimal(38,9)"), 6).cast("double").alias("mean_value"),
                    "max_value")


class SessionStream:
    """Sessions of an event stream in append mode: each is written once, when the watermark has passed its end.

    ``source`` is a folder that receives Parquet files of events; sessions are written to
    ``out``, and state and progress to ``checkpoint``, all three shared folders.  ``run`` takes what has
    arrived and ends; a later run, or a run after a failure, goes on from the checkpoint.
    Events more than ``delay_minutes`` older than the latest event of earlier batches may be dropped;
    ``late`` counts them.
    """

    def __init__(self, spark: SparkSession, schema, source: str, out: str, checkpoint: str, gap_minutes: int = 30, delay_minutes: int = 10):
        self.spark, self.schema, self.source, self.out, self.checkpoint = spark, schema, source, out, checkpoint
        self.gap, self.delay = gap_minutes, delay_minutes

    def add(self, events: DataFrame) -> None:
        events.write.mode("append").parquet(self.source)

    def run(self, files_per_batch: int | None = None) -> None:
        """Takes all files that have arrived in one batch, or so many a batch in the order of their arrival."""
        reader = self.spark.readStream.schema(self.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        counted = sessions(reader.parquet(self.source), self.gap, f"{self.delay} minutes")
        query = (counted.writeStream.outputMode("append").format("parquet").option("checkpointLocation", self.checkpoint)
                 .option("path", self.out).trigger(availableNow=True).start())
        query.awaitTermination()

    def close(self) -> None:
        """Ends all sessions: one event without a user, late enough to move the watermark beyond them."""
        past = F.expr(f"max(ts) + make_dt_interval(0, 0, {2 * (self.gap + self.delay) + 1}, 0)")
        last = self.spark.read.schema(self.schema).parquet(self.source).agg(past.alias("ts"))
        own = {f.name: F.col("ts") if f.name == "ts" else F.lit(None) for f in self.schema}
        self.add(last.filter("ts is not null").select(*[own[f.name].cast(f.dataType).alias(f.name) for f in self.schema]))
        self.run()

    def found(self) -> DataFrame:
        return self.spark.read.parquet(self.out).filter("user_id is not null")

    def late(self) -> DataFrame:
        """(user_id, late) of users with events that no written session holds; after ``close``."""
        read = self.spark.read.schema(self.schema).parquet(self.source).filter("user_id is not null").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        kept = self.found().groupBy("user_id").agg(F.sum("events").alias("kept"))
        rest = (F.col("n") - F.coalesce("kept", F.lit(0))).cast("bigint")
        return read.join(kept, "user_id", "left").select("user_id", rest.alias("late")).filter("late > 0")
