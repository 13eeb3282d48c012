"""Sinks: routed logs, single records, splits, page texts, reports and keyed stores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def routed(rows: DataFrame, success: Column, at: str) -> DataFrame:
    """``rows`` with the log they go to and a timestamp, now if they have none."""
    return rows.withColumn("bucket", F.when(success, "success").otherwise("skipped")).withColumn("stamped", F.date_format(F.coalesce(F.col(at).cast("timestamp"), F.current_timestamp()), STAMP))


def append_log(rows: DataFrame, path: str) -> None:
    """Appends JSON lines, keys in order, to one folder for each bucket; a commit makes them visible at once."""
    rows.select("bucket", *sorted(c for c in rows.columns if c != "bucket")).write.partitionBy("bucket").mode("append").json(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Writes beside ``path``, moves the old table aside, the new one in, and deletes the old one. A failure at any step
    leaves a whole table: ``current_table`` brings back an old one whose successor has not arrived."""
    spark = rows.sparkSession
    made, old = f"{path}.tmp-{uuid.uuid4().hex}", f"{path}.old"
    current_table(spark, path)
    rows.write.parquet(made)
    where, new, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, made, old))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(where) and not files.rename(where, aside):
        raise OSError(f"can't move {path} aside")
    if not files.rename(new, where):
        raise OSError(f"can't move {made} to {path}")
    files.delete(aside, True)


def current_table(spark: SparkSession, path: str) -> str:
    """``path``, after an interrupted ``replace_table`` has been undone or ended."""
    where, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.old"))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(aside):
        if files.exists(where):
            files.delete(aside, True)
        else:
            files.rename(aside, where)
    return path


def write_splits(rows: DataFrame, path: str) -> None:
    """One folder of JSON lines for each value of ``split``."""
    rows.write.partitionBy("split").mode("overwrite").json(path)


def empty_records(docs: DataFrame, sections: tuple[str, ...], key: str = "doc_id") -> DataFrame:
    """The records of documents without text: every section empty, no model, no attempts."""
    none = F.array().cast("array<string>")
    return docs.select(key, F.lit("no_text").alias("status"), F.map_from_arrays(F.array(*[F.lit(s) for s in sections]), F.array_repeat(none, len(sections))).alias("sections"), F.lit(None).cast("string").alias("model"), F.lit(0).alias("request_attempts"))


def joined_pages(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """``key, text`` with the pages in order, form feeds between."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))), lambda x: x["t"])
    return pages.groupBy(key).agg(F.array_join(parts, "\n\f\n").alias("text"))


def ordered_audit(results: DataFrame, errors: DataFrame, source: str) -> DataFrame:
    """Results by folded source, then errors, as one table of JSON lines."""
    line = lambda df, n: df.select(F.lit(n).alias("part"), F.lower(source).alias("name"), F.to_json(F.struct("*")).alias("line"))
    return line(results, 0).unionByName(line(errors, 1)).orderBy("part", "name")


def quarantine(rows: DataFrame, duplicate: Column, invalid: Column, path: str) -> DataFrame:
    """``path, reason`` of files to set aside; nothing is moved from executors."""
    reason = F.when(invalid, "invalid").when(duplicate, "duplicate")
    return rows.select(F.col(path).alias("path"), reason.alias("reason")).where("reason is not null")


def report(title: str, rows: DataFrame, *columns: str) -> str:
    """A short Markdown report of a bounded table (20 rows at most)."""
    some = rows.select(*columns).limit(20).collect()
    return "\n".join([f"# {title}", "", "| " + " | ".join(columns) + " |", "|" + "-|" * len(columns), *["| " + " | ".join(str(v) for v in r) + " |" for r in some], ""])
