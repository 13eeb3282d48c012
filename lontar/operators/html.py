"""Links, titles and pagination of fetched pages, by one tokenizer of anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions import urls
from lontar.functions.text import fold, has_any

ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"

# Words of links between pages, and marks of challenge pages.
NEXT = ("next", "selanjutnya", "berikutnya", ">")
NEXT_LABELS = ("next", "selanjutnya", "berikutnya")
PAGING = ("next", "previous", "prev", "last", "selanjutnya", "berikutnya", "terakhir")
LAST = ("last", "terakhir")
CHALLENGE = (
    "just a moment", "checking if the site connection is secure", "verify you are human", "needs to review the security of your connection",
    "performing security verification", "cf-challenge", "cf-turnstile",
)
TEXT_CHALLENGE = CHALLENGE[1:4]
PDF_ATTRIBUTES = ("href", "data-href", "data-url", "data-download", "data-file")


def unescaped(text: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def visible(html: Column) -> Column:
    """The text of a piece of HTML: nodes stripped, blank ones dropped, one space between."""
    nodes = F.split(F.regexp_replace(html, r"<[^>]*>", "\x00"), "\x00")
    return F.array_join(F.filter(F.transform(nodes, lambda x: F.trim(F.regexp_replace(unescaped(x), r"\s+", " "))), lambda x: x != ""), " ")


def attribute(attrs: Column, name: str) -> Column:
    """An attribute's value, or null. Values stand in double quotes, single quotes or none."""
    at = rf"(?is)(?:^|\s){name}\s*=\s*"
    return F.when(attrs.rlike(at), F.coalesce(F.nullif(F.regexp_extract(attrs, at + r'"([^"]*)"', 1), F.lit("")), F.nullif(F.regexp_extract(attrs, at + r"'([^']*)'", 1), F.lit("")), F.regexp_extract(attrs, at + r"""([^\s"'>]+)""", 1)))


def anchors(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, url, pos, attrs, inner, href, label`` for each anchor with an href, in document order."""
    tags = pages.select(key, "url", F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))).alias("pos", "tag"))
    parts = tags.select(key, "url", "pos", F.regexp_extract("tag", ANCHOR, 1).alias("attrs"), F.regexp_extract("tag", ANCHOR, 2).alias("inner"))
    return parts.withColumn("href", F.trim(attribute(F.col("attrs"), "href"))).where("href is not null").withColumn("label", F.lower(visible(F.col("inner"))))


def is_next() -> Column:
    cls, rel, aria = (F.lower(F.coalesce(attribute(F.col("attrs"), a), F.lit(""))) for a in ("class", "rel", "aria-label"))
    return ~F.col("href").isin("", "#") & (F.array_contains(F.split(rel, r"\s+"), "next") | F.col("label").isin(*NEXT) | F.contains(cls, F.lit("next")) | aria.isin(*NEXT_LABELS))


def is_paging(case: Column) -> Column:
    cls, rel, aria = (F.lower(F.coalesce(attribute(F.col("attrs"), a), F.lit(""))) for a in ("class", "rel", "aria-label"))
    mark = F.contains(cls, F.lit("page-link")) | F.array_contains(F.split(rel, r"\s+"), "next") | F.col("label").isin(*PAGING) | F.col("label").rlike(r"^\d+$") | aria.isin(*PAGING)
    return ~case & mark


def case_links(anchor_rows: DataFrame, case: Column, paging: Column, key: str = "page_id") -> DataFrame:
    """Case links of each page in order, each once: links after the first pagination link that follows a case link are
    left out."""
    page = Window.partitionBy(key)
    rows = anchor_rows.withColumn("is_case", case).withColumn("is_paging", paging)
    rows = rows.withColumn("first_case", F.min(F.when(F.col("is_case"), F.col("pos"))).over(page))
    rows = rows.withColumn("stop", F.min(F.when(F.col("is_paging") & (F.col("pos") > F.col("first_case")), F.col("pos"))).over(page))
    rows = rows.where(F.col("is_case") & (F.col("stop").isNull() | (F.col("pos") < F.col("stop"))))
    return rows.groupBy(key, "href").agg(F.min("pos").alias("pos"))


def published(anchor_rows: DataFrame, html: str, key: str = "page_id") -> DataFrame:
    """Anchors without "unpublish" in the text between them and the next boundary anchor."""
    order = Window.partitionBy(key).orderBy("pos")
    rows = anchor_rows.withColumn("segment", F.sum(F.col("is_boundary").cast("int")).over(order))
    bad = F.bool_or(F.contains(F.lower(F.col(html)), F.lit("unpublish"))).over(Window.partitionBy(key, "segment"))
    return rows.withColumn("unpublished", bad).where("is_boundary and not unpublished")


def listing(pages: DataFrame, prefix: str | None = None, skip_unpublished: bool = True, key: str = "page_id") -> DataFrame:
    """``key, pos, case_url`` of the case links of listing pages in order, each once for its page: of the accepted host
    and path, with a label that begins with ``prefix`` in any case, without "unpublish" in the text up to the next case
    or pagination link, and before the first pagination link that follows an accepted one."""
    gaps = F.transform(F.split("html", ANCHOR, -1), visible)
    tags = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    rows = pages.select(key, "url", F.posexplode(F.arrays_zip(tags.alias("tag"), F.slice(gaps, F.lit(2), F.size(tags)).alias("gap"))).alias("pos", "x"))
    rows = rows.select(key, "url", "pos", F.regexp_extract("x.tag", ANCHOR, 1).alias("attrs"), visible(F.regexp_extract("x.tag", ANCHOR, 2)).alias("name"), F.col("x.gap").alias("gap"))
    rows = rows.withColumns({"href": F.trim(attribute(F.col("attrs"), "href")), "label": F.lower("name")}).withColumn("target", F.when(F.col("href").isNotNull(), urls.resolved("url", "href")))
    case = F.coalesce(urls.is_case(F.col("target")), F.lit(False))
    boundary = F.col("href").isNotNull() & (case | is_paging(case))
    in_page = Window.partitionBy(key).orderBy("pos")  # the anchors of one page
    rows = rows.withColumn("paging", F.col("href").isNotNull() & is_paging(case)).withColumn("segment", F.sum(boundary.cast("int")).over(in_page))
    words = F.lower(F.concat_ws(" ", "name", "gap"))
    rows = rows.withColumn("bad", F.bool_or(F.contains(words, F.lit("unpublish"))).over(Window.partitionBy(key, "segment")))
    named = F.startswith(fold(F.col("name")), fold(F.lit(prefix))) if prefix else F.lit(True)
    on_host = (urls.part(F.col("target"), "PROTOCOL") == "https") & (F.lower(urls.part(F.col("target"), "AUTHORITY")) == urls.HOST)
    fine = case & on_host & named & (~F.col("bad") if skip_unpublished else F.lit(True))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("first", F.min(F.when(F.col("fine"), F.col("pos"))).over(Window.partitionBy(key)))
    rows = rows.withColumn("stop", F.min(F.when(F.col("paging") & (F.col("pos") > F.col("first")), F.col("pos"))).over(Window.partitionBy(key)))
    rows = rows.where(F.col("fine") & (F.col("stop").isNull() | (F.col("pos") < F.col("stop"))))
    return rows.groupBy(key, F.col("target").alias("case_url")).agg(F.min("pos").alias("pos")).select(key, "pos", "case_url")


def title(html: Column) -> Column:
    """The first non-blank of h1, h2, h3, .entry-title, .post-title and <title>."""
    tag = lambda n: F.nullif(visible(F.regexp_extract(html, rf"(?is)<{n}\b[^>]*>(.*?)</{n}>", 1)), F.lit(""))
    by_class = lambda c: F.nullif(visible(F.regexp_extract(html, rf"""(?is)<(\w+)\b[^>]*class\s*=\s*["'][^"']*\b{c}\b[^"']*["'][^>]*>(.*?)</\1>""", 2)), F.lit(""))
    return F.coalesce(tag("h1"), tag("h2"), tag("h3"), by_class("entry-title"), by_class("post-title"), tag("title"))


def challenge(html: Column, page_title: Column) -> Column:
    return has_any(F.lower(F.concat(F.coalesce(page_title, F.lit("")), F.lit("\n"), html)), CHALLENGE)


def text_challenge(html: Column) -> Column:
    named = F.lower(F.trim(F.regexp_extract(html, r"(?i)<title[^>]*>\s*([^<]+)", 1)))
    return F.contains(named, F.lit(CHALLENGE[0])) | has_any(F.lower(F.regexp_replace(html, r"<[^>]+>", " ")), TEXT_CHALLENGE)


def last_page(anchor_rows: DataFrame, listing: Column, key: str = "page_id") -> DataFrame:
    """The largest page number that a listing page names: its own, or that of a "last" link."""
    number = attribute(F.col("attrs"), "data-ci-pagination-page").try_cast("int")
    index = F.when(F.col("label").isin(*LAST), F.greatest(F.when(listing, urls.listing_index(F.col("href"))), number))
    return anchor_rows.groupBy(key).agg(F.greatest(F.max(urls.listing_index(F.col("url"))), F.coalesce(F.max(index), F.lit(1))).alias("last_page"))


def pdf_link(pages: DataFrame, accepted, key: str = "page_id") -> DataFrame:
    """``key, link, filename``: the first accepted file link of each page: anchors with an href before other elements,
    then document order, then the attributes' fixed order, ``onclick`` last. The file name is the element's own text up
    to its end tag, else that of the element right before it or after it; null without any."""
    element = r"(?is)<[a-z][^>]*>"
    tags = F.regexp_extract_all("html", F.lit(element), F.lit(0))
    rows = pages.select(key, "url", "html", F.posexplode(tags).alias("pos", "tag"))
    inside = F.regexp_extract("tag", r"(?is)^<[a-z][a-z0-9]*([^>]*)>$", 1)
    clicks = F.regexp_extract_all(F.coalesce(attribute(inside, "onclick"), F.lit("")), F.lit(r"""(?i)(https?://[^\s"'<>]+|/direktori/download_file/[^\s"'<>]+)"""), F.lit(1))
    found = F.concat(F.array(*[attribute(inside, a) for a in PDF_ATTRIBUTES]), clicks)
    second_pass = ~(F.col("tag").rlike(r"(?i)^<a\b") & attribute(inside, "href").isNotNull())
    rows = rows.select(key, "url", "pos", second_pass.cast("int").alias("pass"), F.posexplode(found).alias("k", "link")).where("link is not null and link <> ''")
    rows = rows.where(accepted(F.col("link"), F.col("url")))
    best = rows.groupBy(key).agg(F.min_by(F.struct("link", "pos", "pass"), F.struct("pass", "pos", "k")).alias("x")).select(key, "x.*")
    # What stands around the one tag: the text before it, and from it on.
    after = F.array_join(F.slice(F.split("html", element, -1), F.col("pos") + 2, F.lit(1)), "")
    whole = best.join(pages.select(key, "html"), key)
    tag = F.get(F.regexp_extract_all("html", F.lit(element), F.lit(0)), F.col("pos"))
    name = F.lower(F.regexp_extract(tag, r"(?is)^<([a-z][a-z0-9]*)", 1))
    offset = F.aggregate(F.slice(F.split("html", element, -1), F.lit(1), F.col("pos") + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(tags, F.lit(1), F.col("pos")), F.lit(0), lambda a, x: a + F.length(x))
    before, rest = F.substr("html", F.lit(1), offset), F.substr("html", offset + F.length(tag) + 1)
    close = F.instr(F.lower(rest), F.concat(F.lit("</"), name, F.lit(">")))
    own = F.when(close > 0, F.substr(rest, F.lit(1), close - 1)).otherwise(after)
    tail = F.when(close > 0, F.substr(rest, close + F.length(name) + 3)).otherwise(F.lit(""))
    previous = F.regexp_extract(before, r"(?is)<([a-z][a-z0-9]*)\b[^>]*>([^<]*)</\1>$", 2)
    following = F.regexp_extract(tail, r"(?is)^<([a-z][a-z0-9]*)\b[^>]*>(.*?)</\1>", 2)
    text = lambda x: F.nullif(visible(x), F.lit(""))
    return whole.select(key, "link", F.when(F.col("pass") == 0, text(own)).otherwise(F.coalesce(text(own), text(previous), text(following))).alias("filename"))


def walked_pages(most: int) -> int:
    """How many pages of a listing a walk for ``most`` links visits at most: 20 links a page, and two pages to spare."""
    return max(1, most // 20 + 2)


def walk(links: DataFrame, most: int | None = None, page_no: str | None = None) -> DataFrame:
    """Links over all pages, each once, in the order of page and place; the first ``most`` of them, from as many pages by
    ``page_no`` as ``walked_pages`` allows."""
    if most and page_no:
        links = links.where(F.col(page_no) <= walked_pages(most))
    once = links.groupBy("href").agg(F.min(F.struct("page_id", "pos")).alias("at")).select("href", "at.page_id", "at.pos")
    ordered = once.orderBy("page_id", "pos", "href")
    return ordered.limit(most) if most else ordered
