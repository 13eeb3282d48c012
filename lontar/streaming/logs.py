"""Streaming forms of the log operators: ingest of new files, counts, resume points, streaks and windowed budgets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder (or a glob) as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def drained(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Runs a stream over all that is there, batch by batch, and stops: the graceful end of an ingest."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()


def new_documents(known: Callable[[], DataFrame], sink: Callable[[DataFrame], None], key: str = "doc_id", text: str = "text") -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps rows whose key and content hash are not known yet, so a replayed or changed file is
    taken once for each content."""

    def each(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("sha", F.sha2(text, 256)).dropDuplicates([key, "sha"])
        sink(rows.join(known().select(key, "sha"), [key, "sha"], "left_anti"))

    return each


def status_counts(events: DataFrame, key: str, status: str) -> DataFrame:
    """Events of each status by key, for update mode."""
    return events.groupBy(key, status).agg(F.count("*").alias("n"))


def windowed_use(events: DataFrame, at: str, value: str, minutes: int, late: str = "1 hour") -> DataFrame:
    """Use by tumbling window; windows close, and late rows are dropped, behind the watermark."""
    stamped = events.withColumn("at", F.col(at).cast("timestamp")).withWatermark("at", late)
    return stamped.groupBy(F.window("at", f"{minutes} minutes")).agg(F.count("*").alias("events"), F.sum(value).alias("used"))


def streak_state(events: DataFrame, key: str, order: str, status: str, failed: str, threshold: int) -> DataFrame:
    """``key, failures, cool_down`` after each batch: the current run of failures of each key, kept in state."""

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        for s in pd.concat(list(batches)).sort_values(order)[status]:
            n = n + 1 if s == failed else 0
        state.update((int(n),))
        yield pd.DataFrame({"key": [int(k[0])], "failures": [int(n)], "cool_down": [bool(n >= threshold)]})

    return events.groupBy(key).applyInPandasWithState(run, "key long, failures long, cool_down boolean", "n long", "update", GroupStateTimeout.NoTimeout)


class Progress(StreamingQueryListener):
    """Calls ``told(name, batch, rows)`` after each batch of a stream: what a dashboard or a log is fed from."""

    def __init__(self, told: Callable[[str | None, int, int], None]):
        self.told = told

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.told(event.progress.name, event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
