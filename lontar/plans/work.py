"""Queries on crawl records, resume points and selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.operators import crawl
from lontar.operators.spans import SECTIONS
from lontar.plans.registry import query
from lontar.sources.tables import table


@query(
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN CASE WHEN starts_with(url, 'https://') THEN 'downloaded' ELSE 'error' END WHEN 1 THEN 'skipped_no_pdf' ELSE 'error' END AS status,
  CASE WHEN page_id % 4 = 0 AND NOT starts_with(url, 'https://') THEN 'refused file address' END AS error, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'doc' END AS title FROM pages"""
)
def fetch_records(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("page_id")
    rows = table(spark, folder, "pages").select("page_id", F.when(i % 4 == 0, "downloaded").when(i % 4 == 1, "skipped_no_pdf").when(i % 4 == 2, " ").alias("status"), F.col("url").alias("pdf_url"), F.when(i % 3 == 0, "  ").otherwise("doc").alias("title"), F.lit("").alias("filename"), F.lit("").alias("error"))
    return crawl.fetch_records(rows, F.col("pdf_url").startswith("https://")).select("page_id", "status", "error", "title")


@query("SELECT arg_max(url, page_id) AS url, max(page_id) AS line_no FROM pages WHERE starts_with(url, 'https://m.')")
def listing_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """The last page address of a log below a start address."""
    lines = table(spark, folder, "pages").select(F.col("page_id").alias("n"), F.concat(F.lit("INFO visiting "), "url").alias("line"))
    return crawl.last_logged(lines, "n", "line", r"visiting (\S+)", F.lit("https://m..html").substr(1, 10))


@query(
    """WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS current FROM events GROUP BY user_id),
s AS (SELECT user_id, 5 + (user_id % 2) AS target, user_id % 4 AS baseline, user_id % 5 = 0 AS done FROM c WHERE user_id % 3 <> 0)
SELECT c.user_id, coalesce(target = 5 AND NOT done, FALSE) AS resumed, CASE WHEN coalesce(target = 5 AND NOT done, FALSE) THEN baseline ELSE current END AS baseline,
  least(5, greatest(0, current - CASE WHEN coalesce(target = 5 AND NOT done, FALSE) THEN baseline ELSE current END)) AS completed FROM c LEFT JOIN s USING (user_id)"""
)
def resume_state(spark: SparkSession, folder: str) -> DataFrame:
    current = table(spark, folder, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("current"))
    i = F.col("user_id")
    saved = current.where(i % 3 != 0).select("user_id", (5 + i % 2).alias("target"), (i % 4).alias("baseline_downloaded"), (i % 5 == 0).alias("is_complete"))
    return crawl.resumed(saved, current, "user_id", 5)


@query("SELECT doc_id, TRUE AS found FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT doc_id + 1000000000, FALSE FROM labels WHERE quality = 0 AND toxic = 1")
def source_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Asked-for sources that are there, and those that are not."""
    labels = table(spark, folder, "labels").where("quality = 0")
    names = labels.select("doc_id").union(labels.where("toxic = 1").select((F.col("doc_id") + 1_000_000_000).alias("doc_id")))
    there, absent = crawl.only_sources(table(spark, folder, "documents").select("doc_id"), names, "doc_id")
    return there.withColumn("found", F.lit(True)).unionByName(absent.withColumn("found", F.lit(False)))


@query("SELECT doc_id, quality FROM labels WHERE toxic = 0 AND doc_id % 5 > 0")
def retry_empty_selection(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "labels").withColumns({"status": F.when(F.col("toxic") == 0, "completed").otherwise("no_text"), "n_empty": F.col("doc_id") % 5})
    return crawl.retry_empty(rows, "status", "n_empty").select("doc_id", "quality")


@query("SELECT doc_id, sha256('Dokumen ' || doc_id || ' (' || lang || '):' || chr(10) || text) AS sha FROM documents WHERE text IS NOT NULL")
def prompt_render(spark: SparkSession, folder: str) -> DataFrame:
    filled = crawl.prompt("Dokumen {id} ({lang}):\n{text}", id=F.col("doc_id"), lang=F.col("lang"), text=F.col("text"))
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.sha2(filled, 256).alias("sha"))


@query(
    """SELECT doc_id, (doc_id % 3)::INT AS n_missing, CASE WHEN doc_id % 2 = 1 THEN 'lain' ELSE '' END AS extra, doc_id % 3 = 0 AND doc_id % 2 = 0 AS equal FROM documents"""
)
def key_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Missing and extra keys of records."""
    keys = F.slice(F.array(*[F.lit(k) for k in SECTIONS]), 1, (31 - F.col("doc_id") % 3).cast("int"))
    rows = table(spark, folder, "documents").select("doc_id", F.concat(keys, F.when(F.col("doc_id") % 2 == 1, F.array(F.lit("lain"))).otherwise(F.array().cast("array<string>"))).alias("keys"))
    return crawl.differences(rows, list(SECTIONS), "keys").select("doc_id", F.size("missing").alias("n_missing"), F.array_join("extra", ",").alias("extra"), "equal")


@query("SELECT user_id FROM events WHERE event_type = 'purchase' UNION SELECT user_id FROM events WHERE event_type = 'error'")
def processed_union(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.where("event_type = 'purchase'").select("user_id").union(events.where("event_type = 'error'").select("user_id")).distinct()


@query("SELECT role, w, least(a, b) AS shared FROM (SELECT role, w, count(*) FILTER (WHERE turn % 2 = 0) AS a, count(*) FILTER (WHERE turn % 2 = 1) AS b FROM (SELECT role, turn, unnest(string_split(text, ' ')) AS w FROM conversations) GROUP BY ALL) WHERE least(a, b) > 0")
def multiset_intersection(spark: SparkSession, folder: str) -> DataFrame:
    """Words that even and odd turns share, as often as both have them."""
    rows = table(spark, folder, "conversations").select("role", "turn", F.explode(F.split("text", " ", -1)).alias("w"))
    counted = rows.groupBy("role", "w").agg(F.count_if(F.col("turn") % 2 == 0).alias("a"), F.count_if(F.col("turn") % 2 == 1).alias("b"))
    return counted.select("role", "w", F.least("a", "b").alias("shared")).where("shared > 0")
