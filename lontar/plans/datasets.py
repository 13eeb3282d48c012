"""Queries on whole answers, repairs, saved outputs, training rows, audits and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import text as T
from lontar.functions import urls
from lontar.operators import crawl, datasets, html, review, spans
from lontar.plans.registry import query
from lontar.sources import readers, sinks
from lontar.sources.tables import table

# ---- Decisions: marks of a court's template between the lines of each document

MARKS = (
    "P U T U S A N", "Nomor 12/Pid.Sus/2024", "DEMI KEADILAN BERDASARKAN KETUHANAN YANG MAHA ESA", "Pengadilan Negeri yang mengadili perkara", "1. Nama lengkap : X",
    "Anak ditangkap oleh penyidik", "Anak ditahan di rutan", "Setelah membaca berkas", "Setelah mendengar pembacaan tuntutan", "Setelah mendengar tanggapan", "Menimbang, sebagai berikut",
    "didakwa berdasarkan surat dakwaan", "Menimbang, bahwa terhadap dakwaan", "Penuntut Umum mengajukan saksi", "Menimbang, bahwa Penuntut Umum tidak mengajukan Ahli",
    "keterangan ahli forensik", "Menimbang, bahwa Terdakwa di persidangan telah memberikan keterangan", "Menimbang, bahwa Anak tidak mengajukan apa pun", "Surat Keterangan dokter",
    "Menimbang, bahwa Penuntut Umum mengajukan barang bukti berupa", "Menimbang, bahwa berdasarkan keterangan", "diperoleh fakta hukum sebagai berikut", "Menimbang, bahwa selanjutnya Hakim akan mempertimbangkan",
    "Kesepakatan Diversi", "M E N G A D I L I :", "Demikianlah diputuskan pada hari Senin, tanggal 3 Mei 2024 oleh", "Hakim Ketua,", "Disclaimer",
)


def _decision() -> Column:
    """Two lines of the document after each mark; which marks are there goes by its length."""
    line = lambda x, k: F.get(x["rows"], (x["i"] + k) % F.size(x["rows"]))
    parts = lambda x: [c for k, m in enumerate(MARKS) for c in (F.when((x["i"] + k) % 3 != 0, m), line(x, k), line(x, k + 5))]
    return T.bound(F.struct(F.split("text", "\n", -1).alias("rows"), F.length("text").alias("i")), lambda x: F.concat_ws("\n", *parts(x)))


_DECISION = " || chr(10) || ".join(f"CASE WHEN (length(text) + {k}) % 3 <> 0 THEN '{m}' || chr(10) ELSE '' END || rs[(length(text) + {k}) % len(rs) + 1] || chr(10) || rs[(length(text) + {k + 5}) % len(rs) + 1]" for k, m in enumerate(MARKS))


def _matches(patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"regexp_matches(line, '{p}')" for p in patterns) + ")"


def _repair_sql() -> str:
    blocks = dict(spans.BLOCKS)
    at = ", ".join(f"min(no) FILTER (WHERE {_matches((start,))}) AS {k}" for k, (start, _) in blocks.items())
    moved = "coalesce((SELECT max(no) FROM ln WHERE ln.doc_id = a.doc_id AND no BETWEEN a.dakwaan - 2 AND a.dakwaan AND " + _matches((spans.CONSIDERING,)) + "), dakwaan) AS dakwaan"
    fallback = "coalesce(pertimbangan_hukum, CASE WHEN diversion THEN considering END) AS pertimbangan_hukum"
    stops = ", ".join(f"coalesce(min(no) FILTER (WHERE no > {k} AND {_matches(stop)}), max(no) + 1) AS {k}_stop" for k, (_, stop) in blocks.items())
    rows = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS section, {k} AS a, {k}_stop AS b FROM e WHERE {k} IS NOT NULL" for k in blocks)
    return rf"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS rs FROM documents WHERE text IS NOT NULL), t AS (SELECT doc_id, {_DECISION} AS t FROM d),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(generate_series(1, len(string_split(t, chr(10))))) AS no FROM t),
a AS (SELECT doc_id, {at}, bool_or({_matches((spans.DIVERSION,))}) AS diversion, min(no) FILTER (WHERE {_matches((spans.CONSIDERING,))}) AS considering FROM ln GROUP BY doc_id),
s AS (SELECT * EXCLUDE (dakwaan, pertimbangan_hukum), {moved}, {fallback} FROM a),
e AS (SELECT s.doc_id, {", ".join(f"any_value({k}) AS {k}" for k in blocks)}, {stops} FROM s JOIN ln USING (doc_id) GROUP BY s.doc_id),
p AS ({rows}), b AS (SELECT p.doc_id, section, regexp_replace(string_agg(line, chr(10) ORDER BY no), '^\s+|\s+$', '', 'g') AS block FROM p JOIN ln ON ln.doc_id = p.doc_id AND no >= a AND no < b GROUP BY ALL)
SELECT doc_id, section, block FROM b WHERE block <> ''"""


@query(_repair_sql())
def repair_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The sections that anchor rules cut out of decisions, by start and stop lines."""
    rows = table(spark, folder, "documents").where("text is not null")
    each = lambda found: F.array(*[F.struct(F.lit(k).alias("section"), found[k].alias("block")) for k in spans.BLOCKS])
    found = T.bound(_decision(), lambda t: T.bound(spans.blocks_of(t), each))
    return rows.select("doc_id", F.inline(F.filter(found, lambda x: x["block"].isNotNull())))


# ---- Answers over all sections

_FORM = """j AS (SELECT doc_id, rs, text, unnest(range(0, 31)) AS j FROM (SELECT doc_id, text, string_split(text, chr(10)) AS rs FROM documents WHERE text IS NOT NULL)),
f AS (SELECT *, (length(text) + j) % 6 AS f, (length(text) + j) % 3 + 1 AS a, (length(text) + j) % 3 + 1 + j % 2 AS b, rs[(length(text) + j) % len(rs) + 1] AS literal FROM j WHERE NOT (length(text) % 11 = 0 AND j = 5))"""


def _answer() -> Column:
    """An answer whose entries take all forms, by the length of the document; some leave a section out."""

    def entry(j: int, rows: Column, i: Column) -> Column:
        a = (i + j) % 3 + 1
        literal = F.get(rows, (i + j) % F.size(rows))
        ranges = F.concat(F.lit('{"lines":[['), a.cast("string"), F.lit(","), (a + j % 2).cast("string"), F.lit("]]}"))
        body = F.when((i + j) % 6 == 1, ranges).when((i + j) % 6 == 2, '{"lines":[]}').when((i + j) % 6 == 3, F.to_json(F.struct(F.array(literal).alias("text")))).when((i + j) % 6 == 4, F.lit('{"text":[]}')).otherwise('{"empty":true}')
        whole = F.concat(F.lit(f'"{spans.SECTIONS[j]}":'), body)
        return F.when(i % 11 != 0, whole) if j == 5 else whole

    text = F.struct(F.split("text", "\n", -1).alias("rows"), F.length("text").alias("i"))
    body = T.bound(text, lambda x: F.concat_ws(",", *[entry(j, x["rows"], x["i"]) for j in range(31)]))
    return F.concat(F.lit('```json\n{"sections":{'), body, F.lit("}}\n```"))


@query(
    rf"""WITH {_FORM}, p AS (SELECT *, CASE WHEN f = 1 AND b > len(rs) THEN 'range out of bounds' WHEN f = 1 AND NOT regexp_matches(array_to_string(rs[a:b], chr(10)), '\S') THEN 'blank slice' WHEN f = 3 AND NOT regexp_matches(literal, '\S') THEN 'blank literal' END AS problem FROM f),
k AS (SELECT *, ['{"','".join(spans.SECTIONS)}'][j + 1] AS section FROM p),
g AS (SELECT doc_id, count(*) AS n, arg_min(section || ': ' || problem, j) FILTER (WHERE problem IS NOT NULL) AS bad, count(*) FILTER (WHERE f IN (1, 3)) AS filled FROM k GROUP BY doc_id)
SELECT doc_id, CASE WHEN n < 31 THEN 'wrong section keys' ELSE bad END AS error, CASE WHEN n = 31 AND bad IS NULL THEN filled END::INT AS filled FROM g"""
)
def whole_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answers read over all 31 sections: the first fault, or how many sections have excerpts."""
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", F.inline(F.array(spans.whole_answer(_answer(), F.col("text")))))
    filled = F.size(F.filter(F.map_values("sections"), lambda x: F.size(x) > 0))
    return rows.select("doc_id", "error", F.when(F.col("error").isNull(), filled).alias("filled"))


@query(
    """WITH r AS (SELECT conv_id, list(text ORDER BY turn) AS ts, list(role ORDER BY turn) AS rs, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, n % 3 <> 0 AND regexp_matches(array_to_string(ts, chr(10)), '\\S') AS usable, ts[1] AS judul, array_to_string(ts, '|') AS saksi, 0 AS ahli FROM r"""
)
def normalized_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records in JSON with a string, a list, a null and absent sections, brought to one form."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    rows = table(spark, folder, "conversations").groupBy("conv_id").agg(turns.alias("ts"))
    status = F.when(F.size("ts") % 3 == 0, "failed").otherwise("completed")
    body = F.to_json(F.struct(status.alias("status"), F.struct(F.get("ts", F.lit(0)).alias("judul"), F.col("ts").alias("saksi"), F.lit(None).cast("string").alias("ahli")).alias("sections")), {"ignoreNullFields": "false"})
    rows = rows.select("conv_id", body.alias("body"))
    some = spans.normalized(F.col("body"))
    return rows.select("conv_id", spans.usable(F.col("body")).alias("usable"), F.get(some["judul"], F.lit(0)).alias("judul"), F.array_join(some["saksi"], "|").alias("saksi"), F.size(some["ahli"]).alias("ahli"))


@query(
    """WITH s AS (SELECT d.doc_id, text, trim(split_part(text, chr(10), 1)) AS head, quality, toxic FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) WHERE text IS NOT NULL),
v AS (SELECT *, CASE WHEN quality IS NULL THEN 'absent' WHEN toxic = 1 OR head = '' THEN 'invalid' WHEN sha256(text) <> sha256(CASE WHEN quality = 1 THEN text ELSE text || '!' END) THEN 'other source' ELSE 'kept' END AS state FROM s)
SELECT doc_id, state, state = 'kept' AND length(text) % 2 = 1 AS changed, CASE WHEN state = 'kept' THEN 30 END AS n_empty FROM v"""
)
def saved_output_validity(spark: SparkSession, folder: str) -> DataFrame:
    """Outputs saved for documents: hashes of another text, excerpts that are not in the source, and old forms."""
    docs = table(spark, folder, "documents").where("text is not null")
    sources = docs.select(F.col("doc_id").cast("string").alias("stem"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), F.sha2("text", 256).alias("source_sha256"), "text")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    stored = docs.join(labels, "doc_id")
    head = F.trim(F.substring_index("text", "\n", 1))
    judul = F.when(F.col("toxic") == 1, F.lit("\u0001 tidak ada di sumber")).otherwise(head)
    keys = [F.lit(k) for k in spans.SECTIONS]
    sections = F.map_from_arrays(F.array(*keys), F.array(F.array(judul), *[F.array().cast("array<string>")] * 30))
    sha = F.sha2(F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat("text", F.lit("!"))), 256)
    empties = F.when(F.length("text") % 2 == 0, F.array(*keys[1:])).otherwise(F.array().cast("array<string>"))
    saved = stored.select(F.col("doc_id").cast("string").alias("stem"), F.lit("completed").alias("status"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), sha.alias("source_sha256"), sections.alias("sections"), empties.alias("empty_sections"), F.lit(False).alias("legacy"))
    rows = spans.loaded(sources, saved)
    return rows.select(F.col("stem").cast("long").alias("doc_id"), "state", "changed", F.size("empty_sections").alias("n_empty"))


# ---- Listings, addresses and names

_HOSTED = r"""regexp_replace(html, 'href="/([A-Za-z]+)"', 'href="https://putusan3.mahkamahagung.go.id/direktori/putusan/\1.html"', 'g')"""


def _listings(spark: SparkSession, folder: str) -> DataFrame:
    """The pages with their own links as case links."""
    link = 'href="https://putusan3.mahkamahagung.go.id/direktori/putusan/$1.html"'
    return table(spark, folder, "pages").withColumn("html", F.regexp_replace("html", 'href="/([A-Za-z]+)"', link))


@query(
    rf"""WITH raw AS (SELECT page_id, unnest(regexp_extract_all({_HOSTED}, '(?is)<a\b([^>]*)>(.*?)</a>')) AS tag, unnest(generate_series(0, len(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>')) - 1)) AS pos FROM pages),
a AS (SELECT page_id, pos::INT AS pos, trim(regexp_extract(tag, '(?is)\shref\s*=\s*"([^"]*)"', 1)) AS href, lower(trim(regexp_replace(regexp_replace(regexp_extract(tag, '(?is)<a\b([^>]*)>(.*?)</a>', 2), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS label FROM raw),
c AS (SELECT *, regexp_matches(href, '^https://putusan3\.mahkamahagung\.go\.id/direktori/putusan/[A-Za-z]+\.html$') AS is_case FROM a),
f AS (SELECT *, is_case AND label >= 'a' AND label < 'n' AND left(label, 1) = 'd' AS fine, NOT is_case AND href <> '' AND (regexp_matches(label, '^\d+$') OR label IN ('next', 'previous', 'prev', 'last', 'selanjutnya', 'berikutnya', 'terakhir')) AS paging FROM c),
g AS (SELECT *, min(pos) FILTER (WHERE fine) OVER (PARTITION BY page_id) AS first FROM f), h AS (SELECT *, min(pos) FILTER (WHERE paging AND pos > first) OVER (PARTITION BY page_id) AS stop FROM g)
SELECT page_id, min(pos) AS pos, href AS case_url FROM h WHERE fine AND (stop IS NULL OR pos < stop) GROUP BY ALL"""
)
def listing_cases(spark: SparkSession, folder: str) -> DataFrame:
    """The case links of listing pages whose names begin with a d."""
    return html.listing(_listings(spark, folder), prefix="D")


@query(r"""SELECT page_id, coalesce(max(CASE WHEN regexp_matches(url, '/page/\d+\.html') THEN regexp_extract(url, '/page/(\d+)\.html', 1)::INT END), 1) AS last_page FROM pages WHERE regexp_matches(html, '(?is)<a\b[^>]*\shref') GROUP BY page_id""")
def last_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The largest page number that each listing page names."""
    return html.last_page(html.anchors(table(spark, folder, "pages")), F.lit(True))


@query(r"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_extract(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '([^/]*)/*$', 1), '(.)\.[^.]*$', '\1'), ''), 'putusan') AS stem FROM pages""")
def url_stems(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", urls.stem(F.col("url")).alias("stem"))


@query(r"SELECT page_id, split_part(url, '/', 3) = 'm.example.com' AND starts_with(url, 'https://') AND regexp_matches(url, '^https://[^/]*/direktori/putusan/[^?#]*\.(?i:html)([?#]|$)') AS detail FROM pages")
def allowed_details(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses by the crawl's own rule, with another host in its place."""
    return table(spark, folder, "pages").select("page_id", urls.allowed(F.col("url"), "detail", "m.example.com").alias("detail"))


@query(
    """WITH q AS (SELECT url, 0 AS part, page_id AS pos FROM pages WHERE page_id % 4 = 0 UNION ALL SELECT url, 1, page_id FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)),
f AS (SELECT url, min(part) AS part, arg_min(pos, part * 1000000000 + pos) AS pos FROM q GROUP BY url) SELECT url, row_number() OVER (ORDER BY part, pos, url) AS place FROM f ORDER BY part, pos, url LIMIT 300"""
)
def crawl_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The first 300 addresses to visit: asked-for ones, then collected ones that are not done (the queue's bound)."""
    from pyspark.sql.window import Window

    pages = table(spark, folder, "pages").select("page_id", "url")
    queue = datasets.crawl_queue(pages.where("page_id % 4 = 0"), pages, pages.where("page_id % 3 = 0").select("url").distinct(), "url", "page_id", 300)
    return queue.select("url", F.row_number().over(Window.orderBy("place.part", "place.at", "url")).alias("place"))  # 300 rows


@query(
    """WITH r AS (SELECT page_id, contains(html, 'script') AS invalid, row_number() OVER (PARTITION BY url ORDER BY page_id) > 1 AS dup, url FROM pages)
SELECT count(*) FILTER (WHERE NOT invalid AND NOT dup) AS kept_records, count(*) FILTER (WHERE dup AND NOT invalid) AS duplicate_records, count(*) FILTER (WHERE invalid) AS invalid_records, count(*) FILTER (WHERE (invalid OR dup) AND url <> '') AS moved_files FROM r"""
)
def dedup_summary(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", F.contains("html", F.lit("script")).alias("invalid"))
    first = pages.groupBy("url").agg(F.min("page_id").alias("first"))
    return datasets.dedup_summary(pages.join(first, "url"), F.col("page_id") != F.col("first"), F.col("invalid"), F.col("url"))


@query("SELECT url AS path, CASE WHEN contains(html, 'script') THEN 'invalid' ELSE 'duplicate' END AS reason FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS r FROM pages) WHERE contains(html, 'script') OR r > 1")
def quarantine_plan(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    first = pages.groupBy("url").agg(F.min("page_id").alias("first"))
    return sinks.quarantine(pages.join(first, "url"), F.col("page_id") != F.col("first"), F.contains("html", F.lit("script")), "url")


# ---- Pages, files and audits

@query("SELECT a.conv_id, a.turn, a.text AS first, b.text AS second FROM (SELECT * FROM conversations WHERE role = 'user') a JOIN (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant') b USING (conv_id, turn)")
def page_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Two sequences side by side: what was asked, and what came next."""
    turns = table(spark, folder, "conversations")
    second = turns.where("role = 'assistant'").withColumn("turn", F.col("turn") - 1)
    return datasets.page_pairs(turns.where("role = 'user'"), second, "conv_id", "turn", "text")


@query("SELECT d.doc_id, min(p.url) AS path FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id GROUP BY d.doc_id")
def paired_files(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("path"))
    return datasets.paired_files(table(spark, folder, "documents").select("doc_id"), files, "doc_id", "path")


@query(
    """WITH l AS (SELECT lower(event_type) || user_id AS source, event_id AS line, value, user_id AS output, user_id % 2 AS age FROM events WHERE event_type <> 'error')
SELECT source, arg_max(line, (age, line)) AS line, arg_max(value, (age, line)) AS value, arg_max(output, (age, line)) AS output FROM l GROUP BY source HAVING arg_max(output, (age, line)) IN (SELECT c_custkey FROM customer)"""
)
def merged_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The last result of each source in two audits, errors left out, whose output is there."""
    lines = table(spark, folder, "events").select(F.concat("event_type", F.col("user_id").cast("string")).alias("source"), F.col("event_id").alias("line"), "value", F.col("user_id").alias("output"), F.when(F.col("event_type") == "error", "x").alias("error"))
    results = datasets.audit_results(lines).drop("error")
    outputs = table(spark, folder, "customer").select(F.col("c_custkey").alias("output"))
    return datasets.merged_audit(results.where("output % 2 = 0"), results.where("output % 2 = 1"), outputs, "source", "output").select("source", "line", "value", "output")


@query("SELECT event_id % 97 AS name, count(*) AS n, min(part) AS part FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS part FROM events) GROUP BY 1")
def audit_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Results, then errors, as JSON lines in the order of their sources, counted by source."""
    events = table(spark, folder, "events").select((F.col("event_id") % 97).cast("string").alias("source"), "event_type")
    lines = sinks.ordered_audit(events.where("event_type <> 'error'"), events.where("event_type = 'error'"), "source")
    return lines.groupBy(F.get_json_object("line", "$.source").cast("long").alias("name")).agg(F.count("*").alias("n"), F.min("part").alias("part"))


# ---- Training rows and figures

@query(
    """WITH g AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user') AS i, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant') AS t FROM conversations GROUP BY conv_id HAVING i IS NOT NULL AND t IS NOT NULL),
s AS (SELECT *, CASE conv_id % 3 WHEN 0 THEN 'sft' WHEN 1 THEN 'grpo' ELSE 'benchmark' END AS split FROM g)
SELECT split, conv_id AS sha, CASE WHEN split = 'grpo' THEN sha256('system|user' || i || t) ELSE sha256('system|user|assistant' || i || t) END AS row_sha FROM s"""
)
def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the three splits in their own forms, read back from their JSON."""
    said = lambda role: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda x: x["text"]), "\n")
    rows = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("sha")).agg(said("user").alias("input"), said("assistant").alias("target"), F.count_if(F.col("role") == "user").alias("a"), F.count_if(F.col("role") == "assistant").alias("b")).where("a > 0 and b > 0")
    splits = rows.select("sha", F.when(F.col("sha") % 3 == 0, "sft").when(F.col("sha") % 3 == 1, "grpo").otherwise("benchmark").alias("split"))
    made = datasets.training_rows(datasets.with_split(rows.withColumn("meta", F.struct("sha")), splits, "sha"), "Jawab.")
    kind = "messages array<struct<role:string,content:string>>, prompt array<struct<role:string,content:string>>, answer string"
    back = made.withColumn("r", F.from_json("row", kind))
    turns = F.coalesce("r.messages", "r.prompt")
    answer = F.coalesce("r.answer", F.get(turns, F.lit(2))["content"])
    return back.select("split", "sha", F.sha2(F.concat(F.array_join(F.transform(turns, lambda x: x["role"]), "|"), F.get(turns, F.lit(1))["content"], answer), 256).alias("row_sha"))


@query("SELECT source || '.json' AS file_name, min(sha256(text)) AS body FROM documents WHERE source IS NOT NULL GROUP BY source")
def one_output_each(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("source is not null").select("source", F.sha2("text", 256).alias("body"))
    return datasets.one_each(rows, "source", "body")


@query("""SELECT '{"documents":' || count(*) || ',"sources":' || count(DISTINCT source) || '}' AS summary FROM documents""")
def summary_object(spark: SparkSession, folder: str) -> DataFrame:
    return datasets.summary_json(table(spark, folder, "documents"), documents=F.count("*"), sources=F.count_distinct("source"))


@query(
    r"""WITH d AS (SELECT doc_id, lang AS section, text, string_split(text, chr(10)) AS rs FROM documents WHERE text IS NOT NULL), n AS (SELECT *, regexp_replace(replace(lower(rs[1]), 'ß', 'ss'), '[!-/:-@\[-`{-~]+', ' ', 'g') AS a, CASE WHEN len(rs) > 1 THEN regexp_replace(replace(lower(rs[1] || ' ' || rs[2]), 'ß', 'ss'), '[!-/:-@\[-`{-~]+', ' ', 'g') ELSE '' END AS b FROM d),
w AS (SELECT doc_id, section, list_filter(regexp_split_to_array(a, '\s+'), lambda x: x <> '') AS p, list_filter(regexp_split_to_array(b, '\s+'), lambda x: x <> '') AS t, len(rs) AS n FROM n),
x AS (SELECT doc_id, w, sum(a) AS a, sum(b) AS b FROM (SELECT doc_id, unnest(p) AS w, 1 AS a, 0 AS b FROM w UNION ALL SELECT doc_id, unnest(t), 0, 1 FROM w) GROUP BY ALL), y AS (SELECT doc_id, sum(least(a, b)) AS shared FROM x GROUP BY doc_id),
z AS (SELECT section, avg((array_to_string(p, ' ') = array_to_string(t, ' '))::INT) AS em, avg(CASE WHEN len(p) + len(t) = 0 THEN 1.0 ELSE 2.0 * coalesce(shared, 0) / (len(p) + len(t)) END::DOUBLE) AS f1, avg(CASE WHEN len(t) = 0 THEN (len(p) = 0)::INT END) AS e FROM w LEFT JOIN y USING (doc_id) GROUP BY section)
SELECT round(avg(em), 6) AS exact_match, round(avg(f1), 6) AS f1, round(avg(e), 6) AS empty_accuracy, (SELECT round(avg((n % 5 <> 0)::INT), 6) FROM w) AS valid_rate, 0.0::DOUBLE AS hallucination_rate FROM z"""
)
def bench_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """First lines as predictions of the first two lines, by language."""
    rows = F.split("text", "\n", -1)
    truth = F.when(F.size(rows) > 1, F.slice(rows, 1, 2)).otherwise(F.array().cast("array<string>"))
    answers = table(spark, folder, "documents").where("text is not null").select("doc_id", F.col("lang").alias("section"), (F.size(rows) % 5 != 0).alias("valid"), F.slice(rows, 1, 1).alias("predicted"), truth.alias("truth"), F.lit(1).alias("in_source"))
    out = datasets.bench_metrics(answers)
    return out.select(*[F.round(c, 6).alias(c) for c in ("exact_match", "f1", "empty_accuracy", "valid_rate", "hallucination_rate")])


def _language_sql() -> str:
    cases = ", ".join("{'n': len(list_filter(ws, lambda w: list_contains([" + ", ".join(f"'{w}'" for w in words) + f"], w))), 'i': {-i}, 'code': '{code}'}}" for i, (code, words) in enumerate(datasets.STOP_WORDS.items()))
    return rf"WITH w AS (SELECT doc_id, regexp_extract_all(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[\p{{L}}]+') AS ws FROM documents), s AS (SELECT doc_id, list_max([{cases}]) AS b FROM w) SELECT doc_id, CASE WHEN b.n > 0 THEN b.code ELSE 'und' END AS language FROM s"


@query(_language_sql())
def language_by_words(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", datasets.language(F.col("text")).alias("language"))


@query("WITH r AS (SELECT conv_id, text, length(text) % 5 AS r FROM conversations), g AS (SELECT conv_id, max((r, text)) AS hi, min((r, text)) AS lo FROM r GROUP BY conv_id) SELECT conv_id, sha256(hi[2]) AS chosen, sha256(lo[2]) AS rejected FROM g WHERE hi[1] > lo[1]")
def feedback_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Preference pairs of rated answers."""
    log = table(spark, folder, "conversations").select("conv_id", "text", (F.length("text") % 5).alias("rating"), F.lit(None).cast("string").alias("correction"))
    pairs = datasets.feedback_sets(log, "text", "rating", "correction", "conv_id")["preference"]
    return pairs.select("conv_id", F.sha2("chosen", 256).alias("chosen"), F.sha2("rejected", 256).alias("rejected"))


@query(r"""SELECT doc_id, CASE WHEN length(t) > 60 THEN '...' || right(t, 60) ELSE t END AS tail FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL)""")
def tail_previews(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text is not null").select("doc_id", T.tail_preview(F.col("text"), 60).alias("tail"))


@query("SELECT conv_id, turn, text AS content FROM conversations WHERE text IS NOT NULL")
def message_contents(spark: SparkSession, folder: str) -> DataFrame:
    """Answers read out of response bodies."""
    rows = table(spark, folder, "conversations").where("text is not null")
    body = F.to_json(F.struct(F.array(F.struct(F.struct("role", F.col("text").alias("content")).alias("message"))).alias("choices")))
    return rows.select("conv_id", "turn", readers.message_content(body).alias("content"))


@query("WITH r AS (SELECT arg_max(url, (page_id % 50, url)) AS path FROM pages WHERE length(html) % 3 <> 0 AND page_id % 7 <> 0) SELECT path FROM r")
def newest_file(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "pages").select(F.col("url").alias("path"), (F.length("html") % 3).alias("length"), (F.col("page_id") % 50).alias("modified"), "page_id")
    return crawl.newest_file(files.where("page_id % 7 <> 0"), files.where("false").select("path"))


@query("SELECT d.doc_id, title, body FROM (SELECT 0::BIGINT AS doc_id, '' AS title, '' AS body) d WHERE FALSE")
def reference_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Sections of a reference text by their titles; documents have no such headings."""
    from lontar.operators.clean import heading_sections

    rows = heading_sections(table(spark, folder, "documents"), "## ")
    return rows.where(F.col("title").isin("Sections", "Schema")).select("doc_id", "title", "body")


@query(
    """WITH m AS (SELECT conv_id, coalesce(max(CASE WHEN turn = 0 AND conv_id % 3 = 0 THEN nullif(text, '') END), max(CASE WHEN turn = 1 THEN nullif(text, '') END), '') AS judge, max(CASE WHEN turn = 0 THEN nullif(text, '') END) AS a, max(CASE WHEN turn = 2 THEN nullif(text, '') END) AS b FROM conversations GROUP BY conv_id)
SELECT conv_id, judge, concat_ws(chr(10), 'nama lengkap: ' || a, 'agama: ' || b) AS identity FROM m"""
)
def section_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Sections under the names of older forms, and an identity put together from its parts."""
    turn = lambda n: F.max(F.when(F.col("turn") == n, F.col("text")))
    rows = table(spark, folder, "conversations").groupBy("conv_id").agg(*[turn(n).alias(f"t{n}") for n in range(3)])
    one = lambda c: F.array(F.coalesce(c, F.lit("")))
    sections = F.map_from_arrays(F.array(*[F.lit(k) for k in ("siapa_yang_memutus", "majelis_hakim", "nama_lengkap", "agama")]), F.array(one(F.when(F.col("conv_id") % 3 == 0, F.col("t0"))), one(F.col("t1")), one(F.col("t0")), one(F.col("t2"))))
    rows = rows.select("conv_id", sections.alias("s"))
    return rows.select("conv_id", review.section_text(F.col("s"), "siapa_yang_memutus").alias("judge"), review.section_text(F.col("s"), "identitas_terdakwa").alias("identity"))
