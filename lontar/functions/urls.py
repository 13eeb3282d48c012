"""URL and file-name functions as Column builders."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the host whose pages the crawl accepts.
HOST = "putusan3.mahkamahagung.go.id"
CASE_PATH = r"""(?i)/direktori/putusan/[^"'#?]+\.html(?:$|[?#])"""


def part(url: Column, what: str) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit(what)), F.lit(""))


def allowed(url: Column, kind: str, host: str = HOST) -> Column:
    """Whether a URL is an accepted ``detail``, ``listing`` or ``pdf`` address."""
    path = part(url, "PATH")
    base = (part(url, "PROTOCOL") == "https") & (F.lower(part(url, "AUTHORITY")) == host)
    if kind == "pdf":
        return base & path.startswith("/direktori/download_file/") & F.contains(path, F.lit("/pdf/"))
    prefix = {"detail": "/direktori/putusan/", "listing": "/direktori/index/"}[kind]
    return base & path.startswith(prefix) & F.lower(path).endswith(".html")


def is_case(url: Column, pattern: str = CASE_PATH) -> Column:
    query = part(url, "QUERY")
    return F.concat(part(url, "PATH"), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))).rlike(pattern)


def listing_page(start: Column, index: Column) -> Column:
    """The address of page ``index`` of a listing; page 1 is the start itself."""
    bare = F.regexp_replace(F.regexp_extract(start, r"^([^?#]*)", 1), r"(?i)/page/\d+\.html$", "")
    query = F.regexp_extract(start, r"(\?[^#]*)", 1)
    stem = F.when(F.lower(bare).endswith(".html"), F.regexp_replace(bare, r"(?i)\.html$", "")).otherwise(F.regexp_replace(bare, "/+$", ""))
    return F.when(index <= 1, start).otherwise(F.concat(stem, F.lit("/page/"), index.cast("string"), F.lit(".html"), query))


def listing_index(url: Column) -> Column:
    """The page number in a listing address, 1 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(F.regexp_extract(url, r"^([^?#]*)", 1), r"(?i)/page/(\d+)\.html", 1), F.lit("")).try_cast("int"), F.lit(1))


def stem(url: Column, fallback: str = "putusan") -> Column:
    """The last path segment without its suffix."""
    last = F.regexp_extract(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), r"([^/]*)/*$", 1)
    bare = F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(fallback))


def sanitized(name: Column, fallback: str = "putusan", suffix: str = ".pdf") -> Column:
    """A safe file name: escapes decoded, separators and control characters replaced, blank names given a fallback."""
    plain = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    safe = F.regexp_replace(F.regexp_replace(F.trim(plain), r"[\\/]", "_"), r'[\x00-\x1F<>:"|?*]+', "_")
    safe = F.regexp_replace(F.regexp_replace(safe, r"\s+", " "), r"^[ .]+|[ .]+$", "")
    safe = F.when(safe == "", fallback).otherwise(safe)
    return F.when(F.lower(safe).endswith(suffix), safe).otherwise(F.concat(safe, F.lit(suffix)))


@F.pandas_udf(T.StringType())
def resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    """A link resolved against its page, by the rules of RFC 3986 as the standard library has them."""
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href, strict=True)])
