"""Text functions as Column builders: folding, words, lines, excerpts, previews and policy arithmetic."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's ``str.split`` and ``\s`` see it, for Java's regular expressions.
SPACE = r"(?U)[\s\x1C-\x1F]"
#: Line ends as Python's ``str.splitlines`` sees them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
WORD = r"([\p{L}\p{N}_]+)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often and in whatever lambda ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_max(values: Column) -> Column:
    """The largest of the first 1, 2, ... numbers of an array, by doubling: each step looks 1, 2, 4, ... places back."""
    steps = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(values))) - 1), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(steps, values, lambda acc, k: F.transform(acc, lambda x, i: F.greatest(x, F.when(i >= k, F.get(acc, i - k)).otherwise(x))))


def quoted(text: Column) -> Column:
    """``text`` as a literal inside a Java pattern."""
    return F.regexp_replace(text, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def fold(text: Column) -> Column:
    """Case folding; beyond lower case only the sharp s differs in the languages served."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def compatible(text: Column) -> Column:
    """The NFKC form of a text. Spark has no function for it; only texts with characters beyond Latin-1 letters, or with
    compatibility characters among those, are handed over."""
    odd = F.when(text.rlike(r"[^\x00-\x7F\u00C0-\u00FF]"), text)
    return F.when(odd.isNotNull(), _nfkc(odd)).otherwise(text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)[^\s\x1C-\x1F]")


def squeezed(text: Column) -> Column:
    """In NFKC, folded, white-space runs as one space, stripped: what is compared in order."""
    return F.trim(F.regexp_replace(fold(compatible(text)), f"{SPACE}+", " "))


def compact(text: Column) -> Column:
    """In NFKC, folded, without any white space: what is compared for content."""
    return F.regexp_replace(fold(compatible(text)), f"{SPACE}+", "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(WORD), F.lit(1))


def lines(text: Column) -> Column:
    """The lines of a text by the rule of ``splitlines``: a final line end makes no empty line."""
    last = lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(bound(F.split(text, LINE_END, -1), last))


def error_rate(edits: Column, reference: Column, primary: Column) -> Column:
    """Edits for each unit of the reference; without a reference, 0 for an empty primary and 1 otherwise."""
    return F.when(reference == 0, F.when(primary == 0, 0.0).otherwise(1.0)).otherwise(edits / reference)


def accuracy(rate: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - rate)


def numbered(text: Column, width: int | None = 4) -> Column:
    """Lines with right-aligned numbers. A fixed ``width`` never cuts a number; None takes the width of the last one."""
    rows = F.split(text, "\n", -1)
    digits = F.length(F.size(rows).cast("string")) if width is None else F.lit(width)
    number = lambda i: F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), digits - F.length((i + 1).cast("string")))), (i + 1).cast("string"))
    return F.array_join(F.transform(rows, lambda x, i: F.concat(number(i), F.lit("| "), x)), "\n")


def sliced(rows: Column, first: Column, last: Column) -> Column:
    """Lines ``first`` to ``last`` (from 1, both in), clamped to what there is, without line ends at the edges."""
    a = F.greatest(first, F.lit(1))
    b = F.least(last, F.size(rows))
    return F.when(b < a, "").otherwise(F.regexp_replace(F.array_join(F.slice(rows, a, F.greatest(b - a + 1, F.lit(0))), "\n"), r"^\n+|\n+$", ""))


def head_preview(text: Column, n: int) -> Column:
    one = F.trim(F.regexp_replace(text, f"{SPACE}+", " "))
    return F.when(F.coalesce(one, F.lit("")) == "", "-").when(F.length(one) > n, F.concat(F.substring(one, 1, n), F.lit("..."))).otherwise(one)


def tail_preview(text: Column, n: int = 180) -> Column:
    one = F.trim(F.regexp_replace(text, f"{SPACE}+", " "))
    return F.when(F.length(one) > n, F.concat(F.lit("..."), F.right(one, F.lit(n)))).otherwise(one)


def without_fence(text: Column) -> Column:
    """A text without a Markdown code fence around it."""
    return F.regexp_replace(F.regexp_replace(text, r"(?i)^\s*```(?:json)?\s*", ""), r"\s*```\s*$", "")


def flexible_pattern(literal: Column) -> Column:
    """A pattern that finds ``literal`` with any white space between its words."""
    return F.array_join(F.transform(F.filter(F.split(literal, f"{SPACE}+"), lambda w: w != ""), quoted), r"\s+")


def spaced_pattern(literal: Column) -> Column:
    """A pattern that finds ``literal`` with any white space between its letters."""
    return F.array_join(F.transform(F.split(F.regexp_replace(literal, f"{SPACE}+", ""), ""), quoted), r"\s*")


def found(text: Column, pattern: Column) -> Column:
    """The first match of a pattern that is itself a column, or null."""
    return F.nullif(F.call_function("regexp_extract", text, pattern, F.lit(0)), F.lit(""))


def aligned(text: Column, excerpt: Column, letters: int = 40) -> Column:
    """The place of an excerpt in a source: itself, else its first match with other white space, else (for at most
    ``letters`` visible characters) with spaced letters; null if there is none."""
    visible = F.length(F.regexp_replace(excerpt, f"{SPACE}+", ""))
    return (
        F.when(F.contains(text, excerpt), excerpt)
        .when(visible == 0, None)
        .otherwise(F.coalesce(found(text, flexible_pattern(excerpt)), F.when(visible <= letters, found(text, spaced_pattern(excerpt)))))
    )


def snapped(text: Column, literal: Column) -> Column:
    """A literal as the source spells it, if its words are found there exactly once; else as it is."""
    hits = F.regexp_extract_all(text, flexible_pattern(literal), F.lit(0))
    return F.when(F.contains(text, literal) | blank(literal), literal).when(F.size(hits) == 1, F.get(hits, 0)).otherwise(literal)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def output_budget(length: Column, effort: Column, most: int = 32768) -> Column:
    """Tokens that an answer may have: by the text's length, or the most there is with reasoning."""
    return F.when(effort != "off", F.lit(most)).otherwise(F.least(F.lit(most), F.greatest(F.lit(4096), F.floor(length / 3) + 2048)))


def retry_after(header: Column) -> Column:
    """Seconds of a Retry-After header, 0 at least; null if it is no number."""
    return F.greatest(F.lit(0.0), header.try_cast("double"))


def retry_delay(attempt: Column, status: Column, header: Column, base: float) -> Column:
    """Seconds to wait: by server and attempt after a 429, else growing to 10."""
    return F.when(status == 429, F.greatest(F.coalesce(retry_after(header), F.lit(0.0)), F.lit(base) * attempt)).otherwise(F.least(F.lit(2.0) * attempt, F.lit(10.0)))


def backoff(attempt: Column, base: float) -> tuple[Column, Column]:
    """Bounds of an exponential delay with jitter of up to a fifth of it, one second at most."""
    delay = F.lit(base) * F.pow(F.lit(2.0), attempt - 1)
    return delay, delay + F.least(F.lit(1.0), F.lit(0.2) * delay)


# Marks of failures that are not the document's fault, and of refused concurrency.
INFRASTRUCTURE = (
    "NameResolutionError", "Failed to resolve", "getaddrinfo failed", "NewConnectionError", "ConnectTimeout", "Connection refused", "Connection reset",
    "Connection aborted", "ProxyError", "retryable HTTP 429", "rate_limit_exceeded", "concurrency limit reached", "project limit reached",
)
CONCURRENCY = ("concurrency limit reached", "rate_limit_exceeded", "project limit reached")


def has_any(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for mark in marks:
        out = out | F.contains(text, F.lit(mark))
    return out


def infrastructure_error(error: Column, marks: tuple[str, ...] = INFRASTRUCTURE) -> Column:
    """Whether an error is one of infrastructure; a read timeout is not."""
    return has_any(fold(F.coalesce(error, F.lit(""))), tuple(m.lower() for m in marks))


def concurrency_refused(status: Column, body: Column, marks: tuple[str, ...] = CONCURRENCY) -> Column:
    return (status == 429) & has_any(F.lower(F.coalesce(body, F.lit(""))), marks)


def http_outcome(status: Column, asked_for_json: Column) -> Column:
    """What a response's status asks for."""
    return F.when((status == 400) & asked_for_json, "retry_plain").when((status == 429) | (status >= 500), "retry").when(status >= 400, "fatal").otherwise("ok")


def number_in(text: Column) -> Column:
    """The first number of a text, thousands separators dropped; null without one."""
    return F.replace(F.regexp_extract(text, r"-?[\d.,]+", 0), F.lit(","), F.lit("")).try_cast("double")
