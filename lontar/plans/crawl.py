"""Queries over fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions import urls
from lontar.operators import crawl, dedup, html
from lontar.plans.registry import query
from lontar.sources.tables import table

_ANCHORS = r"""
raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>')) AS tag, unnest(generate_series(0, len(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>')) - 1)) AS pos FROM pages),
a AS (SELECT page_id, url, pos::INT AS pos, trim(regexp_extract(tag, '(?is)\shref\s*=\s*"([^"]*)"', 1)) AS href, regexp_extract(tag, '(?is)<a\b([^>]*)>(.*?)</a>', 2) AS inner_html FROM raw)
"""
_CASE = "regexp_matches(href, '^/[A-Za-z]{4,}$')"
_PAGING = "regexp_matches(href, '^/[a-z]{1,3}$')"


def _case() -> F.Column:
    return F.col("href").rlike("^/[A-Za-z]{4,}$")


def _paging() -> F.Column:
    return F.col("href").rlike("^/[a-z]{1,3}$")


@query(rf"WITH {_ANCHORS} SELECT page_id, pos, href, lower(trim(regexp_replace(regexp_replace(inner_html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS label FROM a")
def anchor_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html.anchors(table(spark, folder, "pages")).select("page_id", "pos", "href", "label")


@query(f"WITH {_ANCHORS} SELECT page_id, pos, href FROM (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS r FROM a WHERE {_CASE}) WHERE r = 1 ORDER BY page_id, pos, href LIMIT 500")
def listing_links_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """The first 500 links of the walk over all pages, each once (the walk's target count)."""
    return html.walk(html.anchors(table(spark, folder, "pages")).where(_case()), 500).select("page_id", "pos", "href")


@query(
    f"""WITH {_ANCHORS}, f AS (SELECT *, min(CASE WHEN {_CASE} THEN pos END) OVER (PARTITION BY page_id) AS fc FROM a),
s AS (SELECT *, min(CASE WHEN {_PAGING} AND pos > fc THEN pos END) OVER (PARTITION BY page_id) AS stop FROM f)
SELECT page_id, href, min(pos) AS pos FROM s WHERE {_CASE} AND (stop IS NULL OR pos < stop) GROUP BY page_id, href"""
)
def take_while_pagination(spark: SparkSession, folder: str) -> DataFrame:
    return html.case_links(html.anchors(table(spark, folder, "pages")), _case(), _paging())


@query(r"SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\s+', ' ', 'g')), '') AS title FROM pages")
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@query(r"SELECT page_id, regexp_matches(lower(html), 'just a moment|checking if the site connection is secure|verify you are human|needs to review the security of your connection|performing security verification|cf-challenge|cf-turnstile') AS by_page, regexp_matches(lower(regexp_replace(html, '<[^>]+>', ' ', 'g')), 'checking if the site connection is secure|verify you are human|needs to review the security of your connection') OR contains(lower(regexp_extract(html, '(?i)<title[^>]*>\s*([^<]+)', 1)), 'just a moment') AS by_text FROM pages")
def challenge_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", html.challenge(F.col("html"), F.lit("")).alias("by_page"), html.text_challenge(F.col("html")).alias("by_text"))


@query(
    r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '/+$', '') || '/page/' || (page_id % 5 + 2) || '.html' || regexp_extract(url, '(\?[^#]*)', 1) END AS page_url,
  starts_with(url, 'https://') AND regexp_matches(url, '^https://[a-z.-]*example\.com/en/[^?#]*\.html') AS accepted, (page_id % 7 + 1)::INT AS page_index FROM pages WHERE NOT regexp_matches(url, '^[^?#]*\.html')
UNION ALL SELECT page_id, url, starts_with(url, 'https://') AND regexp_matches(url, '^https://[a-z.-]*example\.com/en/[^?#]*\.html'), (page_id % 7 + 1)::INT FROM pages WHERE regexp_matches(url, '^[^?#]*\.html')"""
)
def url_parts_allowlist(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses of a listing, the acceptance of an address by its parts, and the page number read back."""
    rows = table(spark, folder, "pages")
    url, page = F.col("url"), F.col("page_id")
    is_html = url.rlike(r"^[^?#]*\.html")
    accepted = (urls.part(url, "PROTOCOL") == "https") & urls.part(url, "HOST").rlike(r"^[a-z.-]*example\.com$") & urls.part(url, "PATH").rlike(r"^/en/.*\.html$")
    index = urls.listing_index(F.concat(F.lit("https://x/a/page/"), (page % 7 + 1).cast("string"), F.lit(".html?q=1")))
    return rows.select("page_id", F.when(is_html | (page % 3 == 0), url).otherwise(urls.listing_page(url, (page % 5 + 2).cast("int"))).alias("page_url"), accepted.alias("accepted"), index.alias("page_index"))


@query(
    r"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*>')) AS tag, unnest(generate_series(0, len(regexp_extract_all(html, '(?is)<a\b[^>]*>')) - 1)) AS pos FROM pages),
h AS (SELECT page_id, pos, regexp_extract(tag, '(?is)\shref\s*=\s*"([^"]*)"', 1) AS link FROM t)
SELECT page_id, arg_min(link, pos) AS link FROM h WHERE link <> '' AND length(link) > 4 GROUP BY page_id"""
)
def pdf_link_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return html.pdf_link(table(spark, folder, "pages"), lambda link, _: F.length(link) > 4).select("page_id", "link")


@query(
    f"""WITH {_ANCHORS}, u AS (SELECT href, min(page_id) AS page_id FROM a WHERE {_CASE} GROUP BY href)
SELECT CASE WHEN GROUPING(page_id) = 1 THEN -1 ELSE page_id END AS page_id, count(*) AS downloadable, count(*) FILTER (WHERE length(href) % 2 = 0) AS already, count(*) FILTER (WHERE length(href) % 2 = 1) AS remaining FROM u GROUP BY GROUPING SETS ((page_id), ())"""
)
def inventory_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """New links of each page, and of all, split by what is there already."""
    links = html.anchors(table(spark, folder, "pages")).where(_case()).groupBy("href").agg(F.min("page_id").alias("page_id"))
    rows = links.groupingSets([["page_id"], []], "page_id").agg(F.count("*").alias("downloadable"), F.count_if(F.length("href") % 2 == 0).alias("already"), F.count_if(F.length("href") % 2 == 1).alias("remaining"), F.grouping_id().alias("g"))
    return rows.select(F.when(F.col("g") > 0, -1).otherwise(F.col("page_id")).alias("page_id"), "downloadable", "already", "remaining")


@query(
    r"""WITH n AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(replace(trim(split_part(url, '//', 2)), '/', '_'), '[\x00-\x1f<>:"|?*]+', '_', 'g'), '\s+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS s FROM (SELECT page_id, url_decode(replace(url, '+', '%2B')) AS url FROM pages))
SELECT page_id, CASE WHEN lower(s) LIKE '%.pdf' THEN s ELSE s || '.pdf' END AS name, CASE WHEN r = 1 THEN stem || '.pdf' ELSE stem || '-' || r || '.pdf' END AS unique_name
FROM (SELECT *, left(s, 4) AS stem, row_number() OVER (PARTITION BY left(s, 4) ORDER BY page_id) AS r FROM n)"""
)
def sanitize_filenames(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pages").select("page_id", urls.sanitized(F.substring_index("url", "//", -1)).alias("name"))
    named = crawl.unique_names(rows.withColumn("short", F.concat(F.left("name", F.lit(4)), F.lit(".pdf"))), "short", "page_id")
    return named.select("page_id", "name", "unique_name")


@query()
def resolved_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links resolved against their page (standard library rules), each once."""
    rows = html.anchors(table(spark, folder, "pages"))
    return dedup.first_of(rows.withColumn("target", urls.resolved("url", "href")), ["target"], ["page_id", "pos"]).select("page_id", "pos", "target")


@query(f"WITH {_ANCHORS} SELECT page_id, arg_min(href, pos) AS next_url FROM a WHERE href NOT IN ('', '#') AND lower(trim(inner_html)) IN ('next', 'selanjutnya', 'berikutnya', '>', 'the', 'la', 'der') GROUP BY page_id")
def next_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = html.anchors(table(spark, folder, "pages"))
    return rows.where(html.is_next() | (F.col("label").isin("the", "la", "der") & ~F.col("href").isin("", "#"))).groupBy("page_id").agg(F.min_by("href", "pos").alias("next_url"))
