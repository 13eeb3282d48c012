"""Work queues, progress and retries over append-only event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def counts_where(events: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """How often ``condition`` holds for each ``key``; keys without an event of the kind are left out."""
    return events.where(condition).groupBy(key).agg(F.count("*").alias(name))


def latest(events: DataFrame, key: str, order: Column, *columns: str) -> DataFrame:
    """The last row of each key by ``order``, as a partial aggregate: no sort, and no key held in one task."""
    return events.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("row")).select(key, *[F.col(f"row.{c}").alias(c) for c in columns])


def pending(sources: DataFrame, done: DataFrame, outputs: DataFrame, by_name: str, by_stem: str) -> DataFrame:
    """Sources without a progress row of their name and without an output of their stem."""
    return sources.join(done, by_name, "left_anti").join(outputs, by_stem, "left_anti")


def work_queue(cleaned: DataFrame, failures: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Documents with text, failed ones last, then the shortest first, then by key; ``place`` from 1."""
    rows = cleaned.where("clean_text <> ''").join(failures, key, "left").withColumn("failed_before", F.coalesce("failures", F.lit(0)) > 0).withColumn("clean_chars", F.length("clean_text"))
    ordered = rows.orderBy("failed_before", "clean_chars", key)
    return ordered.limit(limit) if limit else ordered


def streaks(events: DataFrame, key: str, order: list[str], failed: Column, threshold: int) -> DataFrame:
    """Runs of failures of each key: first and last event, length, and whether the threshold was reached."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = events.withColumn("failed", failed).withColumn("island", F.sum((~F.col("failed")).cast("int")).over(w)).where("failed")
    return rows.groupBy(key, "island").agg(F.min(order[-1]).alias("first_event"), F.max(order[-1]).alias("last_event"), F.count("*").alias("failures")).withColumn("cool_down", F.col("failures") >= threshold)


def durations(events: DataFrame, key: str, at: str, order: list[str]) -> DataFrame:
    """Seconds from each event to the key's next one; null at the last."""
    w = Window.partitionBy(key).orderBy(*order)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return events.withColumn("seconds", (micros(F.lead(at).over(w)) - micros(F.col(at))) / 1e6)


def ring(events: DataFrame, n: int, *order: str) -> DataFrame:
    """The ``n`` newest events."""
    return events.orderBy(*[F.desc(c) for c in order]).limit(n)


def resume(events: DataFrame, key: str, done: Column, target: int) -> DataFrame:
    """For each key: how much is done past the baseline, within the target, and whether the target is met."""
    counted = events.groupBy(key).agg(F.count_if(done).alias("current"), F.count("*").alias("seen"))
    baseline = F.floor(F.col("seen") / 10)
    completed = F.least(F.lit(target).cast("long"), F.greatest(F.lit(0).cast("long"), F.col("current") - baseline))
    return counted.select(key, baseline.alias("baseline"), "current", completed.alias("completed"), (completed >= target).alias("satisfied"))


def rate(part: Column, whole: Column) -> Column:
    """A percentage of one decimal, half to even; 0 of nothing."""
    return F.when(whole == 0, 0.0).otherwise(F.bround(100.0 * part / whole, 1))
