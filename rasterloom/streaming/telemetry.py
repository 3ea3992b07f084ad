"""Append-only telemetry: JSON lines with an open set of fields, as a stream or as a table.

The transformations are the same for both; a stream adds a watermark and a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "schema INT, time TIMESTAMP, phase STRING, task STRING, status STRING, seconds DOUBLE, extra MAP<STRING,STRING>"


def read_stream(spark: SparkSession, folder: str, delay: str = "10 minutes", files_per_batch: int = 100) -> DataFrame:
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.where(F.col("schema") == 1).withWatermark("time", delay)


def read_batch(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(folder).where(F.col("schema") == 1)


def as_telemetry(events: DataFrame) -> DataFrame:
    """The driver's events in telemetry's form."""
    return events.select(F.lit(1).alias("schema"), F.col("ts").alias("time"), F.col("event_type").alias("phase"), F.col("user_id").alias("task"),
                         F.lit("complete").alias("status"), F.col("value").alias("seconds"), F.from_json("props", "map<string,string>").alias("extra"))


def tumbling(rows: DataFrame, length: str) -> DataFrame:
    """(window_start, phase, n, seconds)."""
    out = rows.groupBy(F.window("time", length), "phase").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))
    return out.select(F.col("window.start").alias("window_start"), "phase", "n", "seconds")


def sessions(rows: DataFrame, gap: str) -> DataFrame:
    """(task, session_start, n, seconds)."""
    out = rows.groupBy(F.session_window("time", gap), "task").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))
    return out.select("task", F.col("session_window.start").alias("session_start"), "n", "seconds")


def append(rows: DataFrame, folder: str) -> None:
    """One more set of JSON lines; sessions never rewrite each other's files."""
    rows.write.mode("append").json(folder)


def run_once(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now, once, into Parquet; closed windows only (append mode)."""
    query = rows.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest_frames(frames: DataFrame, key: str, generation: str, *values: str) -> DataFrame:
    """Of several results for a key, that of the highest generation; stale ones are dropped."""
    return frames.groupBy(key).agg(F.max_by(F.struct(generation, *values), F.col(generation)).alias("v")).select(key, "v.*")
