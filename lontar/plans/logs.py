"""Queries over event logs: a user is a source, ``error`` a failure, ``purchase`` a completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import text as T
from lontar.operators import clean, logs
from lontar.plans.registry import query
from lontar.sources.tables import table

FAILED = "error"

#: The clean text of a document by the default cleaner, where none of its furniture occurs: lines stripped on the right,
#: blank runs as one line, edges stripped.
CLEAN_SQL = r"""
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS no FROM documents),
keep AS (SELECT doc_id, no, regexp_replace(line, '\s+$', '') AS line FROM ln WHERE NOT regexp_matches(line, '(?i)^\s*Halaman\s+\d+(\s+dari\s+\d+)?(\s+Putusan\b.*)?\s*$')),
lagged AS (SELECT *, lag(line = '', 1, TRUE) OVER (PARTITION BY doc_id ORDER BY no) AS after_blank FROM keep),
joined AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS t FROM lagged WHERE NOT (line = '' AND after_blank) GROUP BY doc_id),
clean AS (SELECT d.doc_id, regexp_replace(coalesce(j.t, ''), '^\s+|\s+$', '', 'g') AS clean_text FROM documents d LEFT JOIN joined j USING (doc_id))
"""


@query(
    f"""WITH {CLEAN_SQL},
fails AS (SELECT user_id AS doc_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT c.doc_id, coalesce(f.n, 0) > 0 AS failed_before, length(clean_text)::INT AS clean_chars, sha256(clean_text) AS sha
FROM clean c LEFT JOIN fails f USING (doc_id) WHERE clean_text <> ''
ORDER BY failed_before, clean_chars, doc_id LIMIT 200"""
)
def work_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The next 200 documents to work on: those that never failed first, then the shortest."""
    failures = logs.counts_where(table(spark, folder, "events"), "user_id", F.col("event_type") == FAILED, "failures").withColumnRenamed("user_id", "doc_id")
    queue = logs.work_queue(clean.cleaned(table(spark, folder, "documents")), failures, "doc_id", 200)
    return queue.select("doc_id", "failed_before", "clean_chars", F.sha2("clean_text", 256).alias("sha"))


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def pending_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.col("doc_id").alias("stem"))
    return logs.pending(docs, labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select(F.col("doc_id").alias("stem")), "doc_id", "stem").select("doc_id", "lang")


@query("SELECT (SELECT count(*) FROM documents) AS sources, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'purchase') AS completed, (SELECT count(*) FROM labels) AS outputs, (SELECT count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS pending")
def status_panel(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels, events = (table(spark, folder, n) for n in ("documents", "labels", "events"))
    parts = [docs.agg(F.count("*").alias("sources")), events.where("event_type = 'purchase'").agg(F.countDistinct("user_id").alias("completed")), labels.agg(F.count("*").alias("outputs")), docs.join(labels, "doc_id", "left_anti").agg(F.count("*").alias("pending"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p)  # one row each
    return out


@query("SELECT user_id, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY user_id")
def failure_counts(spark: SparkSession, folder: str) -> DataFrame:
    return logs.counts_where(table(spark, folder, "events"), "user_id", F.col("event_type") == FAILED, "failures")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id")
def latest_event_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return logs.latest(table(spark, folder, "events").where("event_type = 'purchase'"), "user_id", F.struct("ts", "event_id"), "event_id", "value")


@query(
    """WITH r AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, island::BIGINT AS island, min(event_id) AS first_event, max(event_id) AS last_event, count(*) AS failures, count(*) >= 3 AS cool_down FROM r WHERE event_type = 'error' GROUP BY ALL"""
)
def failure_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return logs.streaks(table(spark, folder, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == FAILED, 3)


@query("SELECT event_id, user_id, round((epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6, 6) AS seconds FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def stage_durations(spark: SparkSession, folder: str) -> DataFrame:
    return logs.durations(table(spark, folder, "events"), "user_id", "ts", ["ts", "event_id"]).select("event_id", "user_id", F.round("seconds", 6).alias("seconds"))


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 7")
def recent_ring(spark: SparkSession, folder: str) -> DataFrame:
    return logs.ring(table(spark, folder, "events"), 7, "ts", "event_id").select("event_id", "user_id", "event_type")


@query(
    """SELECT epoch(time_bucket(INTERVAL '300 minutes', ts, TIMESTAMP '1970-01-01'))::BIGINT AS window_start, count(*) AS events, round(sum(value), 4) AS used, sum(value) > 600 AS over_budget,
  arg_min(event_type, (abs(value - 300), event_id)) AS nearest FROM events GROUP BY 1"""
)
def usage_window_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Use in windows of 300 minutes against a budget, and the bucket nearest to 300."""
    w = table(spark, folder, "events").groupBy(F.window("ts", "300 minutes"))
    rows = w.agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("used"), (F.sum("value") > 600).alias("over_budget"), F.min_by("event_type", F.struct(F.abs(F.col("value") - 300), "event_id")).alias("nearest"))
    return rows.select(F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start"), "events", "used", "over_budget", "nearest")


@query("SELECT event_id, ts, props FROM events WHERE event_type = 'view' AND contains(props, '\"k\"') AND contains(props, '7') ORDER BY ts DESC, event_id DESC LIMIT 50")
def log_scan_topn(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").where((F.col("event_type") == "view") & F.contains("props", F.lit('"k"')) & F.contains("props", F.lit("7")))
    return rows.orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", "ts", "props")


@query(
    """WITH p AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN substr(props, 2) WHEN event_id % 7 = 0 THEN '  ' ELSE chr(65279) || props END AS line FROM events)
SELECT event_id, json_extract_string(ltrim(line, chr(65279)), '$.k')::INT AS k FROM p WHERE trim(line) <> '' AND json_valid(ltrim(line, chr(65279)))"""
)
def tolerant_json_props(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a byte-order mark, blank and broken ones, read without failing."""
    from lontar.sources.readers import tolerant_json

    line = F.when(F.col("event_id") % 5 == 0, F.substr("props", F.lit(2))).when(F.col("event_id") % 7 == 0, "  ").otherwise(F.concat(F.lit("﻿"), "props"))
    return tolerant_json(table(spark, folder, "events").select("event_id", line.alias("line")), "line", "k int").select("event_id", "k")


@query(
    """SELECT role, count(*) AS turns, sum(length(text) // 4)::BIGINT AS tokens, round(avg(length(text) // 4), 6) AS mean_tokens, round(100 - 100 * avg(length(text) // 4) / 104183, 6) AS less_pct FROM conversations GROUP BY role"""
)
def token_usage_totals(spark: SparkSession, folder: str) -> DataFrame:
    n = T.token_estimate(F.col("text"))
    return table(spark, folder, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.sum(n).alias("tokens"), F.round(F.avg(n), 6).alias("mean_tokens"), F.round(100 - 100 * F.avg(n) / 104183, 6).alias("less_pct"))


_STATUS = "CASE event_id % 6 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 400 WHEN 3 THEN 404 ELSE 200 END"
_ERROR = "CASE event_id % 4 WHEN 0 THEN 'HTTP: Connection Refused by peer' WHEN 1 THEN 'Read timed out.' WHEN 2 THEN 'project limit reached, wait' ELSE '' END"


@query(
    f"""WITH e AS (SELECT event_id, {_STATUS} AS status, {_ERROR} AS error, event_type = 'click' AS json_mode FROM events)
SELECT event_id, regexp_matches(lower(error), 'nameresolutionerror|failed to resolve|getaddrinfo failed|newconnectionerror|connecttimeout|connection refused|connection reset|connection aborted|proxyerror|retryable http 429|rate_limit_exceeded|concurrency limit reached|project limit reached') AS infra,
  status = 429 AND regexp_matches(lower(error), 'concurrency limit reached|rate_limit_exceeded|project limit reached') AS refused,
  CASE WHEN status = 400 AND json_mode THEN 'retry_plain' WHEN status = 429 OR status >= 500 THEN 'retry' WHEN status >= 400 THEN 'fatal' ELSE 'ok' END AS outcome FROM e"""
)
def error_classification(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").selectExpr("event_id", "event_type", f"{_STATUS} AS status", f"{_ERROR} AS error")
    return rows.select("event_id", T.infrastructure_error(F.col("error")).alias("infra"), T.concurrency_refused(F.col("status"), F.col("error")).alias("refused"), T.http_outcome(F.col("status"), F.col("event_type") == "click").alias("outcome"))


@query(
    """WITH e AS (SELECT event_id, event_id % 6 + 1 AS attempt, CASE WHEN event_id % 2 = 0 THEN 429 ELSE 503 END AS status, CASE event_id % 3 WHEN 0 THEN '12.5' WHEN 1 THEN 'soon' ELSE '-3' END AS header FROM events)
SELECT event_id, CASE WHEN status = 429 THEN greatest(coalesce(greatest(0.0, try_cast(header AS DOUBLE)), 0.0), 1.5 * attempt) ELSE least(2.0 * attempt, 10.0) END::DOUBLE AS delay,
  (2.0 * power(2, attempt - 1))::DOUBLE AS backoff_low, (2.0 * power(2, attempt - 1) + least(1.0, 0.2 * 2.0 * power(2, attempt - 1)))::DOUBLE AS backoff_high,
  least(32768, greatest(4096, attempt * 9000 // 3 + 2048))::BIGINT AS budget FROM e"""
)
def backoff_policy(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", (F.col("event_id") % 6 + 1).alias("attempt"), F.when(F.col("event_id") % 2 == 0, 429).otherwise(503).alias("status"), F.when(F.col("event_id") % 3 == 0, "12.5").when(F.col("event_id") % 3 == 1, "soon").otherwise("-3").alias("header"))
    low, high = T.backoff(F.col("attempt"), 2.0)
    return rows.select("event_id", T.retry_delay(F.col("attempt"), F.col("status"), F.col("header"), 1.5).alias("delay"), low.alias("backoff_low"), high.alias("backoff_high"), T.output_budget(F.col("attempt") * 9000, F.lit("off")).cast("long").alias("budget"))


@query(
    """WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS current, count(*) // 10 AS baseline FROM events GROUP BY user_id)
SELECT user_id, baseline::BIGINT AS baseline, current, least(8, greatest(0, current - baseline))::BIGINT AS completed, least(8, greatest(0, current - baseline)) >= 8 AS satisfied FROM c"""
)
def resume_target(spark: SparkSession, folder: str) -> DataFrame:
    return logs.resume(table(spark, folder, "events"), "user_id", F.col("event_type") == "purchase", 8)


@query(
    """SELECT user_id % 10 AS scope, count(*) AS attempted, count(*) FILTER (WHERE event_type = 'purchase') AS downloaded, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view') AS skipped,
  CASE WHEN count(*) = 0 THEN 0 ELSE round_even(100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'purchase') / count(*), 1) END::DOUBLE AS success_rate FROM events GROUP BY 1"""
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    rows = table(spark, folder, "events").groupBy((F.col("user_id") % 10).alias("scope"))
    return rows.agg(F.count("*").alias("attempted"), n("purchase").alias("downloaded"), n("error").alias("failed"), n("view").alias("skipped"), logs.rate(n("purchase"), F.count("*")).alias("success_rate"))


@query("SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'skipped' END AS bucket, strftime(coalesce(ts, TIMESTAMP '1970-01-01'), '%Y-%m-%dT%H:%M:%SZ') AS stamped FROM events")
def route_by_status(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.sources.sinks import routed

    return routed(table(spark, folder, "events"), F.col("event_type") == "purchase", "ts").select("event_id", "bucket", "stamped")
