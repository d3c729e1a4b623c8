"""Votes that keep arriving: running totals by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pollweave.functions.semantics import col, sum0


def vote_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def running_totals(stream: DataFrame, session: str, votes: str) -> DataFrame:
    """Votes per session so far; unreadable votes count 0."""
    return stream.groupBy(col(session)).agg(sum0(col(votes).try_cast("bigint")).alias("total"))


def late_totals(stream: DataFrame, at: str, votes: str, window: str = "1 day", delay: str = "90 days") -> DataFrame:
    """Votes per window of their load time; rows later than ``delay`` are dropped with their state."""
    return stream.withWatermark(at, delay).groupBy(F.window(col(at), window)).agg(sum0(votes).alias("total")).select("window.start", "total")


def run_available(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Takes in what has arrived and ends; the result is the in-memory table ``name``."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
