"""Queries over section records, synthesised from documents: section k is line k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import rewards
from lontar.functions.text import blank, without_fence
from lontar.operators import curate, dedup, spans
from lontar.plans.registry import query
from lontar.sources.tables import table

#: Sections of the synthetic records, with the rule for their entries by doc_id.
KEYS = ("judul", "saksi", "tanggal")
_NL = "chr(10)"


def _rows() -> Column:
    return F.split("text", "\n", -1)


def _content() -> Column:
    """An answer in a fence whose range forms rotate with the doc_id; every seventh is broken."""
    i = F.col("doc_id")
    n = lambda k: (i % k + 1).cast("string")
    form = (
        F.when(i % 6 == 0, F.concat(F.lit("[["), n(3), F.lit(","), (i % 3 + 2).cast("string"), F.lit("]]")))
        .when(i % 6 == 1, F.concat(F.lit("["), n(3), F.lit(","), (i % 3 + 2).cast("string"), F.lit("]")))
        .when(i % 6 == 2, F.concat(F.lit('["'), n(3), F.lit("-"), (i % 3 + 2).cast("string"), F.lit('"]')))
        .when(i % 6 == 3, F.concat(F.lit("[["), n(2), F.lit("]]")))
        .when(i % 6 == 4, F.lit("[]"))
        .otherwise(F.lit('[["a","b"]]'))
    )
    body = F.concat(F.lit('{"judul":{"lines":'), form, F.lit('},"saksi":{"empty":true},"tanggal":{"lines":[[9000,9001]]}}'))
    return F.when(i % 7 == 0, "nonsense").otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```")))


_RANGES = """r AS (SELECT doc_id, string_split(text, chr(10)) AS rs, doc_id % 7 = 0 AS broken, doc_id % 6 AS f, doc_id % 3 + 1 AS a, doc_id % 3 + 2 AS b, doc_id % 2 + 1 AS c FROM documents),
s AS (SELECT *, CASE WHEN f IN (0, 1, 2) THEN a WHEN f = 3 THEN c END AS lo, CASE WHEN f IN (0, 1, 2) THEN b WHEN f = 3 THEN c END AS hi FROM r)"""


@query(
    f"""WITH {_RANGES} SELECT doc_id, CASE WHEN broken THEN 'not a JSON object' END AS error, CASE WHEN broken OR f = 5 THEN NULL WHEN f = 4 THEN '' ELSE lo || '-' || hi END AS ranges,
  CASE WHEN broken OR f >= 4 OR lo > len(rs) THEN NULL ELSE nullif(trim(array_to_string(rs[lo:least(hi, len(rs))], chr(10)), chr(10)), '') END AS span FROM s"""
)
def expand_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Pointers of many forms expanded to the lines that they name."""
    rows = table(spark, folder, "documents").select("doc_id", _rows().alias("rs"), _content().alias("content"))
    body = spans.parsed(F.col("content"))
    ranges = spans.strict_ranges(F.get_json_object(body, "$.judul.lines"))
    text = F.array_join(F.transform(ranges, lambda r: F.concat(r["a"].cast("string"), F.lit("-"), r["b"].cast("string"))), ",")
    one = F.get(spans.expanded(F.col("rs"), ranges), F.lit(0))
    return rows.select("doc_id", spans.answer_error(F.col("content")).alias("error"), text.alias("ranges"), one.alias("span"))


@query(
    f"""WITH {_RANGES}, p AS (SELECT *, CASE WHEN broken THEN 'missing' WHEN f = 5 THEN 'unknown range form' WHEN f = 4 THEN NULL WHEN hi > len(rs) OR hi < lo THEN 'range out of bounds'
  WHEN NOT regexp_matches(trim(array_to_string(rs[lo:hi], chr(10)), chr(10)), '\\S') THEN 'blank slice' END AS judul FROM s)
SELECT doc_id, judul, CASE WHEN broken THEN 'missing' END AS saksi, CASE WHEN broken THEN 'missing' WHEN len(rs) >= 9001 THEN NULL ELSE 'range out of bounds' END AS tanggal FROM p"""
)
def validate_records(spark: SparkSession, folder: str) -> DataFrame:
    """The first fault of each section's entry."""
    rows = table(spark, folder, "documents").select("doc_id", _rows().alias("rs"), spans.parsed(_content()).alias("body"))
    entry = lambda k: F.get_json_object("body", f"$.{k}")
    return rows.select("doc_id", *[spans.entry_problem(entry(k), F.col("rs")).alias(k) for k in KEYS])


@query(
    r"""WITH c AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '4' WHEN 1 THEN '["7","3"]' WHEN 2 THEN '[[5,2],["6"],"x"]' ELSE '[4]' END AS v FROM documents)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '4-4' WHEN 1 THEN '3-7' WHEN 2 THEN '2-5,6-6' ELSE '4-4' END AS ranges FROM c"""
)
def lenient_spans(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id") % 4
    value = F.when(i == 0, "4").when(i == 1, '["7","3"]').when(i == 2, '[[5,2],["6"],"x"]').otherwise("[4]")
    ranges = spans.lenient_ranges(value)
    return table(spark, folder, "documents").select("doc_id", F.array_join(F.transform(ranges, lambda r: F.concat(r["a"].cast("string"), F.lit("-"), r["b"].cast("string"))), ",").alias("ranges"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'PUTUSAN' END AS judul, 'Nomor ' || doc_id || '/Pid.Sus' AS nomor_putusan, CASE WHEN doc_id % 3 = 0 THEN 'MENGADILI' || chr(10) || '1. Menyatakan ' || doc_id WHEN doc_id % 3 = 1 THEN 'MENETAPKAN:' || chr(10) || 'Menetapkan ' || doc_id END AS amar_putusan,
  'Senin' AS hari, CAST(NULL AS VARCHAR) AS penangkapan FROM documents"""
)
def repair_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Sections found by the anchor rules in a decision built around each doc_id."""
    i = F.col("doc_id").cast("string")
    head = F.when(F.col("doc_id") % 2 == 0, "\n  PUTUSAN \n").otherwise("\nsurat\n")
    ruling = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\nMENGADILI\n1. Menyatakan "), i)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("\nMENETAPKAN:\nMenetapkan "), i)).otherwise("\nselesai")
    text = F.concat(head, F.lit("Nomor "), i, F.lit("/Pid.Sus\nisi"), ruling, F.lit("\nDemikianlah diputuskan pada hari Senin, tanggal 1 Mei 2024 oleh kami"))
    found = spans.repaired(F.col("text"))
    rows = table(spark, folder, "documents").select("doc_id", text.alias("text"))
    return rows.select("doc_id", *[found[k].alias(k) for k in ("judul", "nomor_putusan", "amar_putusan", "hari", "penangkapan")])


@query(
    """WITH a AS (SELECT conv_id, turn, (length(text) % 7)::INT AS n_empty FROM conversations),
g AS (SELECT conv_id, arg_min(n_empty, turn) AS first_empty, min(n_empty) AS best_empty, count(*) AS n FROM a GROUP BY conv_id)
SELECT g.conv_id, first_empty, best_empty, (SELECT min(turn) FROM a WHERE a.conv_id = g.conv_id AND a.n_empty = g.best_empty)::BIGINT AS best_attempt,
  CASE WHEN n = 1 THEN 'single' WHEN best_empty < first_empty THEN 'retry_improved' ELSE 'retry_no_improvement' END AS status FROM g"""
)
def retry_keep_best(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", (F.length("text") % 7).alias("n_empty"))
    return spans.better_retry(rows, "conv_id", "n_empty", "turn")


@query(
    """WITH ln AS (SELECT doc_id, unnest(string_split(text, chr(10))[1:31]) AS line, unnest(generate_series(1, least(31, len(string_split(text, chr(10)))))) AS no FROM documents)
SELECT no::INT AS section_no, count(*) AS documents, count(*) FILTER (WHERE line = '') AS strictly_empty, count(*) FILTER (WHERE NOT regexp_matches(line, '\\S')) AS blank FROM ln GROUP BY no"""
)
def section_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Emptiness of each section under its two meanings."""
    rows = table(spark, folder, "documents").select(F.posexplode(F.slice(_rows(), 1, 31)).alias("pos", "line"))
    return rows.groupBy((F.col("pos") + 1).alias("section_no")).agg(F.count("*").alias("documents"), F.count_if(F.col("line") == "").alias("strictly_empty"), F.count_if(blank(F.col("line"))).alias("blank"))


@query("SELECT conv_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS sha, count(*)::INT AS n_filled FROM conversations WHERE regexp_matches(text, '\\S') GROUP BY conv_id")
def reconstruct_input(spark: SparkSession, folder: str) -> DataFrame:
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.array(x["text"]))
    rows = table(spark, folder, "conversations").groupBy("conv_id").agg(turns.alias("spans"))
    return rows.select("conv_id", F.sha2(curate.reconstructed(F.col("spans")), 256).alias("sha"), curate.filled(F.col("spans")).alias("n_filled")).where("n_filled > 0")


_RECORDS = "rec AS (SELECT doc_id, sha256(text) AS sha, lang AS model, source AS corpus, (doc_id % 5)::INT AS n FROM documents)"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", curate.record_hash(F.sha2("text", 256), F.col("doc_id").cast("string")).alias("sha"), F.col("source").alias("model"), (F.col("doc_id") % 5).cast("int").alias("n"))


@query(
    """WITH rec AS (SELECT doc_id, sha256(text) AS sha, source AS model, (doc_id % 5)::INT AS n FROM documents),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS r FROM rec) WHERE r = 1),
b AS (SELECT w.sha, list_sort(list_distinct(list(rec.model))) AS l FROM w JOIN rec ON rec.sha = w.sha AND rec.doc_id < w.doc_id GROUP BY w.sha),
a0 AS (SELECT w.sha, rec.model, min(rec.doc_id) AS d FROM w JOIN rec ON rec.sha = w.sha AND rec.doc_id > w.doc_id GROUP BY ALL),
a AS (SELECT sha, list(model ORDER BY d) AS l FROM a0 GROUP BY sha)
SELECT w.sha, w.doc_id, w.n, array_to_string(coalesce(b.l, []) || list_filter(coalesce(a.l, []), lambda x: NOT list_contains(coalesce(b.l, []), x)), ',') AS also_by FROM w LEFT JOIN b USING (sha) LEFT JOIN a USING (sha)"""
)
def most_complete_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.provenance(_records(spark, folder), "sha", "n", "doc_id", "model").select("sha", "doc_id", "n", F.array_join("also_by", ",").alias("also_by"))


@query(
    """WITH d AS (SELECT DISTINCT lang, sha256(text) AS sha FROM documents), u AS (SELECT sha, min(lang) AS lang FROM d GROUP BY sha),
o AS (SELECT *, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY sha256('3407|' || sha), sha) AS r FROM u)
SELECT sha, lang, CASE WHEN r <= round_even(n * 0.7::DOUBLE, 0) THEN 'sft' WHEN r <= round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.15::DOUBLE, 0) THEN 'grpo' ELSE 'benchmark' END AS split FROM o"""
)
def split_hash_70_15_15(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("lang", F.sha2("text", 256).alias("sha")).groupBy("sha").agg(F.min("lang").alias("lang"))
    return curate.hash_split(rows, "lang", "sha").select("sha", "lang", "split")


@query()
def split_exact_mt(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("lang", F.sha2("text", 256).alias("sha")).groupBy("sha").agg(F.min("lang").alias("lang"))
    return curate.exact_split(rows, "lang", "sha")


@query("SELECT conv_id, count(*)::INT AS turns, string_agg(role, ',' ORDER BY turn) AS roles, sha256(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS sha FROM conversations GROUP BY conv_id")
def chat_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = curate.chat(table(spark, folder, "conversations"), "conv_id", "turn")
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return rows.select("conv_id", F.size("messages").alias("turns"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.sha2(F.array_join(line, "\n"), 256).alias("sha"))


@query("SELECT DISTINCT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def contamination(spark: SparkSession, folder: str) -> DataFrame:
    return curate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("SELECT split_a, split_b, count(*) AS shared FROM (SELECT a.lang AS split_a, b.lang AS split_b FROM (SELECT DISTINCT lang, sha256(text) AS sha FROM documents) a JOIN (SELECT DISTINCT lang, sha256(text) AS sha FROM documents) b ON a.sha = b.sha AND a.lang < b.lang) GROUP BY ALL")
def split_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that two groups share: what a leak-free split must not show."""
    rows = table(spark, folder, "documents").select("lang", F.sha2("text", 256).alias("sha")).distinct()
    sets = rows.groupBy("sha").agg(F.array_sort(F.collect_set("lang")).alias("langs")).where(F.size("langs") > 1)
    pairs = sets.select(F.explode(F.flatten(F.transform("langs", lambda a: F.transform(F.filter("langs", lambda b: a < b), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))).alias("p"))
    return pairs.groupBy("p.split_a", "p.split_b").agg(F.count("*").alias("shared"))


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("conv_id") * 10 + F.col("turn")
    guess = F.when(i % 5 == 0, "1,000").when(i % 5 == 1, "998.5 total").when(i % 5 == 2, "850").when(i % 5 == 3, " 1000 ").otherwise("none")
    done = F.when(i % 2 == 0, F.concat(F.lit("x</think> <SOLUTION>"), guess, F.lit("</SOLUTION>"))).otherwise(guess)
    return table(spark, folder, "conversations").select("conv_id", "turn", guess.alias("guess"), done.alias("text"), F.lit("1000").alias("truth"))


_ANSWERS = """a AS (SELECT conv_id, turn, conv_id * 10 + turn AS i, CASE (conv_id * 10 + turn) % 5 WHEN 0 THEN '1,000' WHEN 1 THEN '998.5 total' WHEN 2 THEN '850' WHEN 3 THEN ' 1000 ' ELSE 'none' END AS guess FROM conversations)"""


@query(f"WITH {_ANSWERS} SELECT conv_id, turn, CASE WHEN i % 2 = 0 THEN 3.0 ELSE 0.0 END::DOUBLE AS exact, CASE WHEN i % 2 = 0 THEN 1.0 ELSE -2.0 END::DOUBLE AS tags FROM a")
def rewards_format(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _answers(spark, folder).select("conv_id", "turn", rewards.exact_format(text, "</think>", "<SOLUTION>").alias("exact"), rewards.tag_counts(text, "</think>", "<SOLUTION>").alias("tags"))


@query(f"WITH {_ANSWERS} SELECT conv_id, turn, CASE i % 5 WHEN 0 THEN 2.0 WHEN 1 THEN 2.0 WHEN 2 THEN 1.5 WHEN 3 THEN 3.5 ELSE -4.5 END::DOUBLE AS answer, CASE i % 5 WHEN 0 THEN 3.5 WHEN 1 THEN -1.5 WHEN 2 THEN -1.5 WHEN 3 THEN 3.5 ELSE -2.5 END::DOUBLE AS number FROM a")
def rewards_answer(spark: SparkSession, folder: str) -> DataFrame:
    g, t = F.col("guess"), F.col("truth")
    return _answers(spark, folder).select("conv_id", "turn", rewards.answer(g, t).alias("answer"), rewards.number(g, t).alias("number"))


@query(
    """WITH r AS (SELECT doc_id, doc_id % 4 <> 0 AS ok, (doc_id % 3)::INT AS missing, (doc_id % 2)::INT AS extra, (doc_id % 5) / 4.0 AS faith, (doc_id % 6) / 5.0 AS f1, doc_id % 2 = 0 AS e FROM documents)
SELECT doc_id, round(CASE WHEN ok THEN 3.0 ELSE -4.0 END + CASE WHEN missing = 0 AND extra = 0 THEN 3.0 ELSE greatest(-4.0, 2.0 - 0.5 * (missing + extra)) END + 4.0 * faith - 3.0 * (1.0 - faith) + 5.0 * f1 + CASE WHEN e THEN 2.0 ELSE -1.0 END - 2.0 * 0.25, 6)::DOUBLE AS reward,
  CASE WHEN lang = 'de' THEN 5.0 ELSE -3.0 END::DOUBLE AS language FROM r JOIN documents USING (doc_id)"""
)
def rewards_extractive(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id")
    total = rewards.extractive(i % 4 != 0, i % 3, i % 2, (i % 5) / 4.0, (i % 6) / 5.0, i % 2 == 0, F.lit(0.25))
    return table(spark, folder, "documents").select("doc_id", F.round(total, 6).alias("reward"), rewards.language(F.col("lang"), "de").alias("language"))


@query("WITH r AS (SELECT conv_id, turn, length(text)::DOUBLE AS r FROM conversations), s AS (SELECT conv_id, avg(r) AS m, stddev_pop(r) AS sd FROM r GROUP BY conv_id) SELECT conv_id, turn, round(CASE WHEN sd = 0 THEN 0 ELSE (r - m) / sd END, 6)::DOUBLE AS advantage FROM r JOIN s USING (conv_id)")
def group_advantage(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", F.length("text").cast("double").alias("r"))
    return curate.advantage(rows, "conv_id", "r").select("conv_id", "turn", F.round("advantage", 6).alias("advantage"))


@query("SELECT conv_id, turn, sha256(text) AS sha FROM conversations")
def fence_strip(spark: SparkSession, folder: str) -> DataFrame:
    """Answers wrapped in a code fence and unwrapped again."""
    rows = table(spark, folder, "conversations").where("text is not null")
    return rows.select("conv_id", "turn", F.sha2(without_fence(F.concat(F.lit("```json\n"), "text", F.lit("\n```"))), 256).alias("sha"))


@query("WITH s AS (SELECT split_part(text, chr(10), 1) AS line, source AS model FROM documents WHERE length(split_part(text, chr(10), 1)) > 5) SELECT sha256(line) AS line_sha, count(DISTINCT model) AS models FROM s GROUP BY 1 HAVING count(DISTINCT model) >= 2")
def cross_model_agreement(spark: SparkSession, folder: str) -> DataFrame:
    line = F.substring_index("text", "\n", 1)
    rows = table(spark, folder, "documents").where(F.length(line) > 5).select(F.sha2(line, 256).alias("line_sha"), F.col("source").alias("model"))
    return rows.groupBy("line_sha").agg(F.countDistinct("model").alias("models")).where("models >= 2")
