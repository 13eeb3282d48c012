"""Queries over document texts: cleaning, lines, normal forms, excerpts and anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import text as T
from lontar.operators import clean, dedup
from lontar.plans.logs import CLEAN_SQL
from lontar.plans.registry import query
from lontar.sources.readers import csv_profile as profile
from lontar.sources.tables import table

_LINES = "ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS no FROM documents)"


@query(f"WITH {CLEAN_SQL} SELECT doc_id, length(clean_text)::INT AS chars, sha256(clean_text) AS sha FROM clean")
def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    return clean.cleaned(table(spark, folder, "documents")).select("doc_id", F.length("clean_text").alias("chars"), F.sha2("clean_text", 256).alias("sha"))


@query(
    f"""WITH {_LINES},
keep AS (SELECT doc_id, no, regexp_replace(line, '\\r+$', '') AS line, trim(line, chr(32) || chr(9)) = '' AS is_blank FROM ln WHERE NOT regexp_matches(trim(line), '(?i)^Halaman\\s+\\d+\\s*$|^Halaman\\s+\\d+\\s+dari\\s+\\d+\\s+Putusan\\s+Nomor')),
lagged AS (SELECT *, lag(is_blank, 1, TRUE) OVER (PARTITION BY doc_id ORDER BY no) AS after_blank FROM keep),
joined AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS t FROM lagged WHERE NOT (is_blank AND after_blank) GROUP BY doc_id)
SELECT d.doc_id, length(trim(coalesce(t, ''), chr(10)))::INT AS chars, sha256(trim(coalesce(t, ''), chr(10))) AS sha FROM documents d LEFT JOIN joined USING (doc_id)"""
)
def clean_lines_b(spark: SparkSession, folder: str) -> DataFrame:
    return clean.cleaned(table(spark, folder, "documents"), clean.SPANS).select("doc_id", F.length("clean_text").alias("chars"), F.sha2("clean_text", 256).alias("sha"))


@query(
    f"""WITH {_LINES} SELECT doc_id, sha256(string_agg(lpad(no::VARCHAR, greatest(4, length(no::VARCHAR))::INT, ' ') || '| ' || line, chr(10) ORDER BY no)) AS numbered_sha,
  coalesce(string_agg(CASE WHEN no BETWEEN 2 AND 4 THEN line END, chr(10) ORDER BY no), '') AS middle FROM ln GROUP BY doc_id"""
)
def numbered_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.split("text", "\n", -1)
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.numbered(F.col("text")), 256).alias("numbered_sha"), T.sliced(rows, F.lit(2), F.lit(4)).alias("middle"))


@query("SELECT doc_id, sha256(trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '\\s+', ' ', 'g'))) AS squeezed, sha256(regexp_replace(replace(lower(text), 'ß', 'ss'), '\\s+', '', 'g')) AS compact FROM documents")
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.squeezed(F.col("text")), 256).alias("squeezed"), F.sha2(T.compact(F.col("text")), 256).alias("compact"))


@query("WITH w AS (SELECT doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}_]+') AS ws FROM documents) SELECT doc_id, len(ws)::INT AS n_words, len(list_distinct(ws))::INT AS n_distinct, coalesce(ws[1], '') AS first_word FROM w")
def word_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", T.words(F.col("text")).alias("ws"))
    return rows.select("doc_id", F.size("ws").alias("n_words"), F.size(F.array_distinct("ws")).alias("n_distinct"), F.coalesce(F.get("ws", F.lit(0)), F.lit("")).alias("first_word"))


@query("SELECT doc_id, sha256(text) AS sha, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS kept FROM documents WHERE text IS NOT NULL")
def exact_dedup_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The first document of each text. The first is a partial aggregate, so a text of many copies stays spread."""
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha"))
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "sha").select("doc_id", "sha", (F.col("doc_id") == F.col("first")).alias("kept"))


@query(
    f"""WITH {_LINES}, hit AS (SELECT doc_id, min(no) FILTER (WHERE regexp_matches(line, '(?i)(^| )(the|der|les|los)( |$)')) AS a, max(no) AS n FROM ln GROUP BY doc_id),
stop AS (SELECT l.doc_id, min(no) AS b FROM ln l JOIN hit USING (doc_id) WHERE no > a AND (regexp_matches(line, '^[EI]') OR regexp_matches(line, '^The ')) GROUP BY l.doc_id)
SELECT h.doc_id, nullif(trim(coalesce((SELECT string_agg(line, chr(10) ORDER BY no) FROM ln l WHERE l.doc_id = h.doc_id AND no >= a AND no < coalesce(b, n + 1)), ''), chr(10) || chr(32) || chr(9)), '') AS block FROM hit h LEFT JOIN stop USING (doc_id)"""
)
def find_block(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.split("text", "\n", -1)
    return table(spark, folder, "documents").select("doc_id", clean.line_block(rows, r"(?i)(^| )(the|der|les|los)( |$)", (r"^[EI]", r"^The ")).alias("block"))


_CLOSED = "'Demikianlah diputuskan dalam rapat, pada hari ' || (CASE doc_id % 3 WHEN 0 THEN 'Senin' WHEN 1 THEN 'Rabu' ELSE 'Jumat' END) || ', tanggal ' || (doc_id % 28 + 1) || ' Mei 20' || lpad((doc_id % 25)::VARCHAR, 2, '0') || ' oleh Hakim'"


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Senin' WHEN 1 THEN 'Rabu' ELSE 'Jumat' END AS hari, (doc_id % 28 + 1) || ' Mei 20' || lpad((doc_id % 25)::VARCHAR, 2, '0') AS tanggal, '20' || lpad((doc_id % 25)::VARCHAR, 2, '0') AS tahun FROM documents")
def closing_formula(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.operators.spans import closing

    day = F.when(F.col("doc_id") % 3 == 0, "Senin").when(F.col("doc_id") % 3 == 1, "Rabu").otherwise("Jumat")
    end = F.concat(F.lit("\nDemikianlah diputuskan dalam rapat, pada hari "), day, F.lit(", tanggal "), (F.col("doc_id") % 28 + 1).cast("string"), F.lit(" Mei 20"), F.lpad((F.col("doc_id") % 25).cast("string"), 2, "0"), F.lit(" oleh Hakim"))
    rows = table(spark, folder, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), end).alias("text"))
    return rows.select("doc_id", *[c.alias(k) for k, c in closing(F.col("text")).items()])


@query(
    """WITH e AS (SELECT doc_id, text, regexp_extract(text, '[A-Za-z]{2,12} [a-z]{2,12} [a-z]{2,12}') AS x FROM documents)
SELECT doc_id, x AS excerpt, CASE WHEN x = '' THEN NULL ELSE x END AS plain, CASE WHEN x = '' THEN NULL ELSE x END AS spaced, CAST(NULL AS VARCHAR) AS foreign_text FROM e"""
)
def align_excerpt(spark: SparkSession, folder: str) -> DataFrame:
    """Three words of each document, found as they are, found with other white space, and a text that is not there."""
    rows = table(spark, folder, "documents").select("doc_id", "text", F.regexp_extract("text", "[A-Za-z]{2,12} [a-z]{2,12} [a-z]{2,12}", 0).alias("excerpt"))
    loose = F.replace("excerpt", F.lit(" "), F.lit(" \n  "))
    some = F.col("excerpt") != ""
    return rows.select("doc_id", "excerpt", F.when(some, T.aligned(F.col("text"), F.col("excerpt"))).alias("plain"), F.when(some, T.aligned(F.col("text"), loose)).alias("spaced"), T.aligned(F.col("text"), F.lit("qqq zzz 0xq")).alias("foreign_text"))


@query("WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS rs FROM documents) SELECT doc_id, greatest(len(rs) - 1, 0)::INT AS row_count, array_to_string(list_filter(list_transform(string_split(coalesce(rs[1], ''), '|'), lambda x: trim(x)), lambda x: x <> ''), ';') AS columns FROM p")
def csv_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile(table(spark, folder, "documents"), "doc_id", sep=r"\|").select("doc_id", "row_count", F.array_join("columns", ";").alias("columns"))


@query(
    f"""WITH {_LINES}, h AS (SELECT *, sum(CASE WHEN starts_with(line, 'The') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS section_no FROM ln)
SELECT doc_id, section_no::BIGINT AS section_no, trim(substr(max(CASE WHEN starts_with(line, 'The') THEN line END), 4)) AS title, coalesce(string_agg(CASE WHEN NOT starts_with(line, 'The') THEN line END, chr(10) ORDER BY no), '') AS body FROM h WHERE section_no > 0 GROUP BY ALL"""
)
def markdown_sections(spark: SparkSession, folder: str) -> DataFrame:
    return clean.heading_sections(table(spark, folder, "documents"), "The").withColumn("section_no", F.col("section_no").cast("long"))


@query("SELECT doc_id, sha256(regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (contains(lower(x), 'license') OR contains(lower(x), 'copyright'))), chr(10)), '\\bthe\\b', 'THE', 'g')) AS sha FROM documents")
def redact_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.sha2(clean.redacted(F.col("text"), ("license", "copyright"), (("the", "THE"),)), 256).alias("sha"))


@query()
def greedy_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by three keys: text, first line, and source with length; checked against the sequential rule."""
    docs = table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("k1"), F.when(F.length(F.substring_index("text", "\n", 1)) > 20, F.sha2(F.substring_index("text", "\n", 1), 256)).alias("k2"), F.concat_ws(":", "source", F.length("text")).alias("k3"))
    return dedup.greedy(docs, "doc_id", ["k1", "k2", "k3"]).select("doc_id", "duplicate")
