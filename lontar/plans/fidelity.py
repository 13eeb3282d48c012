"""Queries on the fidelity of text pairs and on distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions.text import words
from lontar.operators import fidelity
from lontar.plans.registry import query
from lontar.sources.tables import table

#: The texts that the queries compare.
_PAIRS = r"""q AS (SELECT doc_id, text AS reference, regexp_replace(text, '^((?:\S+ ){3})\S+ ', '\1') AS "primary" FROM documents)"""


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's whole text, and itself without its fourth word."""
    rows = table(spark, folder, "documents").select("doc_id", F.col("text").alias("reference"))
    return rows.withColumn("primary", F.regexp_replace("reference", r"^((?:\S+ ){3})\S+ ", "$1"))


@query()
def char_levenshtein(spark: SparkSession, folder: str) -> DataFrame:
    return fidelity.compared(_pairs(spark, folder)).select("doc_id", F.col("char_edits").alias("edits"), F.round("cer", 9).alias("cer"))


@query()
def word_error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return fidelity.compared(_pairs(spark, folder)).select("doc_id", "word_edits", "ref_words", F.round("wer", 9).alias("wer"))


@query(rf"""WITH {_PAIRS}, w AS (SELECT doc_id, regexp_extract_all(replace(lower("primary"), 'ß', 'ss'), '[\p{{L}}\p{{N}}_]+') AS a, regexp_extract_all(replace(lower(reference), 'ß', 'ss'), '[\p{{L}}\p{{N}}_]+') AS b FROM q),
ca AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(a) AS w FROM w) GROUP BY ALL), cb AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(b) AS w FROM w) GROUP BY ALL),
s AS (SELECT ca.doc_id, sum(least(ca.n, cb.n)) AS n FROM ca JOIN cb USING (doc_id, w) GROUP BY ALL),
m AS (SELECT w.doc_id, coalesce(s.n, 0)::INT AS shared, CASE WHEN len(a) = 0 THEN (len(b) = 0)::INT::DOUBLE ELSE coalesce(s.n, 0)::DOUBLE / len(a) END AS p, CASE WHEN len(b) = 0 THEN (len(a) = 0)::INT::DOUBLE ELSE coalesce(s.n, 0)::DOUBLE / len(b) END AS r FROM w LEFT JOIN s USING (doc_id))
SELECT doc_id, shared, round(p, 9)::DOUBLE AS "precision", round(r, 9)::DOUBLE AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 9)::DOUBLE AS f1 FROM m""")
def token_overlap_f1(spark: SparkSession, folder: str) -> DataFrame:
    rows = fidelity.compared(_pairs(spark, folder))
    return rows.select("doc_id", "shared", F.round("token_precision", 9).alias("precision"), F.round("token_recall", 9).alias("recall"), F.round("token_f1", 9).alias("f1"))


@query()
def indel_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select("doc_id", F.round(fidelity.indel_similarity("primary", "reference"), 9).alias("similarity"))


@query(
    """WITH ln AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS no FROM documents),
pg AS (SELECT doc_id, no // 3 + 1 AS page, round(avg(CASE WHEN length(line) > 80 THEN 1.0 ELSE length(line) / 80.0 END), 6)::DOUBLE AS score FROM ln GROUP BY ALL)
SELECT doc_id, count(*) AS pages, min(score) AS lowest, max(score) AS highest, coalesce(string_agg(CASE WHEN score < 0.5 THEN page::VARCHAR END, ',' ORDER BY page), '') AS below, CASE WHEN min(score) >= 0.5 THEN 'passed' ELSE 'review' END AS status FROM pg GROUP BY doc_id"""
)
def page_quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages of three lines, scored by their fill, with the gate at 0.5."""
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    fill = F.when(F.length("line") > 80, 1.0).otherwise(F.length("line") / 80.0)
    pages = lines.groupBy("doc_id", (F.floor(F.col("no") / 3) + 1).alias("page")).agg(F.round(F.avg(fill), 6).alias("score"))
    return fidelity.gate(pages, "doc_id", "page", "score", 0.5).withColumn("below", F.array_join(F.col("below").cast("array<string>"), ","))


@query()
def corpus_micro_macro(spark: SparkSession, folder: str) -> DataFrame:
    rows = fidelity.compared(_pairs(spark, folder))
    micro = F.coalesce(F.sum("char_edits") / F.nullif(F.sum("chars"), F.lit(0)), F.lit(0.0)).alias("micro")
    out = rows.agg(F.count("*").alias("documents"), micro, *fidelity.distribution(rows, "cer"))
    return out.select("documents", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query(
    """WITH t AS (SELECT lang, length(text) // 4 AS n FROM documents), g AS (SELECT lang, count(*) AS documents, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.95) AS p95, max(n) AS most FROM t GROUP BY lang)
SELECT lang, documents, round(p50, 6)::DOUBLE AS p50, round(p90, 6)::DOUBLE AS p90, round(p95, 6)::DOUBLE AS p95, most::BIGINT AS most, least(ceil(p90 / 256) * 256, 4096)::BIGINT AS max_length, (SELECT count(*) FROM t WHERE t.lang = g.lang AND t.n <= g.p90) AS kept FROM g"""
)
def percentile_report(spark: SparkSession, folder: str) -> DataFrame:
    """Token lengths by language, the length limit that follows from them, and how many rows stay below p90."""
    rows = table(spark, folder, "documents").select("lang", F.floor(F.length("text") / 4).alias("n"))
    stats = rows.groupBy("lang").agg(F.count("*").alias("documents"), F.percentile("n", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.95))).alias("p"), F.max("n").alias("most"))
    stats = stats.select("lang", "documents", *[F.get("p", F.lit(i)).alias(k) for i, k in enumerate(("p50", "p90", "p95"))], "most")
    kept = rows.join(stats.select("lang", "p90"), "lang").where("n <= p90").groupBy("lang").agg(F.count("*").alias("kept"))
    length = F.least(F.ceil(F.col("p90") / 256) * 256, F.lit(4096)).cast("long")
    return stats.join(kept, "lang").select("lang", "documents", *[F.round(c, 6).alias(c) for c in ("p50", "p90", "p95")], "most", length.alias("max_length"), "kept")


@query(
    """WITH e AS (SELECT doc_id, length(text)::DOUBLE AS v, b FROM documents, range(0, 2000) r(b)), u AS (SELECT b, v, ('0x' || substr(sha256('lontar:' || b // 8 || ':' || doc_id), (1 + 8 * (b % 8))::INT, 8))::UBIGINT::DOUBLE / 4294967296 AS u FROM e),
n AS (SELECT b, v, (u >= 0.36787944117144233)::INT + (u >= 0.7357588823428847)::INT + (u >= 0.9196986029286058)::INT + (u >= 0.9810118431238462)::INT + (u >= 0.9963401531726563)::INT + (u >= 0.9994058151824183)::INT AS n FROM u),
m AS (SELECT b, sum(n * v) / sum(n) AS mean FROM n GROUP BY b) SELECT round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.975), 6) AS high, count(*) AS resamples FROM m"""
)
def bootstrap_ci(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds of the mean length from 2000 resamples."""
    rows = table(spark, folder, "documents").select("doc_id", F.length("text").cast("double").alias("v"))
    out = fidelity.hashed_bootstrap(rows, "doc_id", "v", 2000, "lontar")
    return out.select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "resamples")


@query("WITH t AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT lang, n, round(100.0::DOUBLE * n / sum(n) OVER (), 6) AS pct FROM t")
def language_share(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return rows.join(rows.agg(F.sum("n").alias("total"))).select("lang", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("pct"))


@query("WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS ws FROM documents WHERE lang = 'en'), x AS (SELECT unnest(ws) AS word FROM w) SELECT word, count(*) AS docs FROM x GROUP BY word ORDER BY docs DESC, word LIMIT 100")
def top_words(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 words of most English documents (a top-k report)."""
    rows = table(spark, folder, "documents").where("lang = 'en'").select(F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    return rows.groupBy("word").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "word").limit(100)
