"""Structured Streaming over sub-hourly feeds.

Event time must be a zoned TIMESTAMP, so NTZ input is read as UTC and hours go back to
NTZ on the way out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourweave.functions.timeutil import HOUR, KEY
from hourweave.plans.bundle import load_bundle
from hourweave.sources.sinks import PARTITIONS, publish_partitions, with_partitions


def utc_session(spark: SparkSession) -> None:
    """Casts between NTZ and TIMESTAMP are exact only in UTC; other zones skip or repeat hours."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def read_feed(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def hourly_mean_stream(
    feed: DataFrame, ts: str, value: str, out: str, key: Sequence[str] = (KEY,), delay: str = "10 minutes"
) -> DataFrame:
    """Mean per hour and key; rows later than `delay` behind the newest one are dropped."""
    utc_session(feed.sparkSession)
    timed = feed.dropna(subset=[ts, *key]).withColumn("_ts", F.col(ts).cast("timestamp"))
    grouped = timed.withWatermark("_ts", delay).groupBy(F.window("_ts", "1 hour").alias("_w"), *key).agg(F.avg(value).alias(out))
    return grouped.select(F.col("_w.start").cast("timestamp_ntz").alias(HOUR), *key, out)


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write closed windows to parquet, all available input, then stop."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def publish_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Publish closed windows per hour. A window closes once, so a replayed batch replaces its own hours only."""

    def write(batch: DataFrame, _: int) -> None:
        publish_partitions(batch, path)

    return (
        df.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(feed: DataFrame, bundle_root: str, path: str, checkpoint: str, version: str | None = None) -> StreamingQuery:
    """Score feature rows as they arrive and publish them, each micro-batch with one bundle.

    The bundle (the newest, or `version`) is read once per batch; its parameter tables are joined as static tables. Rows go to
    the partition of their hour and batch, which a repeated batch replaces, so hours may come in several batches. The
    version a batch was scored with is noted before it is published: a repeated batch uses it again, whatever was
    saved since.
    """
    spark = feed.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        mark = f"{path.rstrip('/')}-versions/batch={number}"
        try:
            noted = spark.read.schema("version string").parquet(mark).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            noted = None
        bundle = load_bundle(spark, bundle_root, noted.version if noted else version)
        if noted is None:
            spark.createDataFrame([(bundle.version,)], "version string").write.mode("overwrite").parquet(mark)
        scored = with_partitions(bundle.score(batch)).withColumn("batch", F.lit(number))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS, "batch").parquet(path)

    return feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """What `score_stream` has published."""
    return spark.read.parquet(path).drop(*PARTITIONS, "batch")
