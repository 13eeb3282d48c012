"""Streaming queries, each run over the table's files until all is read; the result equals its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.operators.cut import cut, shared_dir
from lontar.plans.registry import query
from lontar.sources.tables import table
from lontar.streaming import logs


def _drained(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """The rows that a stream has put out, by batch."""
    base = f"{shared_dir(spark)}/lontar-stream-{uuid.uuid4().hex}"
    logs.drained(stream, f"{base}/checkpoint", lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{base}/out"), mode)
    rows = cut(spark.read.parquet(f"{base}/out"))
    where = spark._jvm.org.apache.hadoop.fs.Path(base)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return rows


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return logs.read(spark, f"{folder}/events.parquet*", table(spark, folder, "events").schema)


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _drained(spark, logs.status_counts(_events(spark, folder), "user_id", "event_type"), "update")
    return rows.groupBy("user_id", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("SELECT epoch(time_bucket(INTERVAL '300 minutes', ts, TIMESTAMP '1970-01-01'))::BIGINT AS window_start, count(*) AS events, round(sum(value), 4) AS used FROM events GROUP BY 1")
def stream_usage_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = _drained(spark, logs.windowed_use(_events(spark, folder), "ts", "value", 300), "update")
    last = rows.groupBy("window").agg(F.max_by(F.struct("events", "used"), "batch").alias("r"))
    return last.select(F.unix_seconds("window.start").alias("window_start"), "r.events", F.round("r.used", 4).alias("used"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def stream_new_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest of documents, idempotent by id and content."""
    path = f"{shared_dir(spark)}/lontar-docs-{uuid.uuid4().hex}"
    schema = table(spark, folder, "documents").schema
    empty = spark.createDataFrame([], "doc_id long, sha string")
    seen = []
    each = logs.new_documents(lambda: spark.read.parquet(path) if seen else empty, lambda rows: (rows.select("doc_id", "sha").write.mode("append").parquet(path), seen.append(1)))
    logs.drained(logs.read(spark, f"{folder}/documents.parquet*", schema), f"{path}-checkpoint", each)
    return spark.read.parquet(path)


@query(
    """WITH r AS (SELECT user_id, event_type, ts, event_id, max(CASE WHEN event_type <> 'error' THEN epoch_us(ts) * 1.0 END) OVER (PARTITION BY user_id) AS last_ok FROM events)
SELECT user_id, count(*) FILTER (WHERE event_type = 'error' AND (last_ok IS NULL OR epoch_us(ts) > last_ok)) AS failures, count(*) FILTER (WHERE event_type = 'error' AND (last_ok IS NULL OR epoch_us(ts) > last_ok)) >= 3 AS cool_down FROM r GROUP BY user_id"""
)
def stream_failure_streak(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type")
    rows = _drained(spark, logs.streak_state(events, "user_id", "at", "event_type", "error", 3), "update")
    last = rows.groupBy("key").agg(F.max_by(F.struct("failures", "cool_down"), "batch").alias("r"))
    return last.select(F.col("key").alias("user_id"), "r.failures", "r.cool_down")


@query("SELECT user_id, max(epoch_us(ts))::BIGINT AS position, count(*) AS events FROM events GROUP BY user_id")
def stream_resume_point(spark: SparkSession, folder: str) -> DataFrame:
    """The newest position of each scope, kept by a streaming aggregate."""
    events = _events(spark, folder).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    rows = _drained(spark, events.groupBy("user_id").agg(F.max("at").alias("position"), F.count("*").alias("events")), "update")
    last = rows.groupBy("user_id").agg(F.max_by(F.struct("position", "events"), "batch").alias("r"))
    return last.select("user_id", "r.position", "r.events")
