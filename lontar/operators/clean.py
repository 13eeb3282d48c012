"""Removal of page furniture from texts, by rule tables, and lines as rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import LINE_END, SPACE, bound, running_max, strip


@dataclass(frozen=True)
class Rules:
    """What a cleaner drops. ``exact`` and ``prefixes`` are compared after stripping, in lower case if ``lowered``;
    ``patterns`` are Java patterns; ``block`` is a line that opens a block and the beginning of the line that ends it."""

    exact: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    lowered: bool = False
    block: tuple[str, str] | None = None
    keep_tails: bool = False
    line_end: str = LINE_END


# The furniture of the two cleaners, which differ on purpose.
SOURCE = Rules(
    exact=("Mahkamah Agung Republik Indonesia", "Direktori Putusan Mahkamah Agung Republik Indonesia", "putusan.mahkamahagung.go.id", "putusan3.mahkamahagung.go.id"),
    patterns=(r"(?i)^\s*Halaman\s+\d+(?:\s+dari\s+\d+)?(?:\s+Putusan\b.*)?\s*$",),
    block=("disclaimer", "email :"),
)
SPANS = Rules(
    exact=("mahkamah agung republik indonesia", "direktori putusan mahkamah agung republik indonesia", "putusan.mahkamahagung.go.id", "disclaimer"),
    prefixes=("kepaniteraan mahkamah agung republik indonesia berusaha", "pelaksanaan fungsi peradilan. namun dalam hal-hal tertentu", "dalam hal anda menemukan inakurasi", "email : kepaniteraan@mahkamahagung.go.id"),
    patterns=(r"(?i)^Halaman\s+\d+\s+dari\s+\d+\s+Putusan\s+Nomor", r"(?i)^Halaman\s+\d+\s*$"),
    lowered=True,
    keep_tails=True,
    line_end="\n",
)


def as_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", line_end: str = LINE_END) -> DataFrame:
    """``key, line_no (from 1), line`` for each line; a final line end makes no line of its own."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "^﻿+", ""), "\r\n?", "\n")
    rows = docs.select(key, F.posexplode(F.split(body, line_end, -1)).alias("pos", "line"), F.size(F.split(body, line_end, -1)).alias("n"))
    return rows.where(~((F.col("pos") == F.col("n") - 1) & (F.col("line") == "") & (F.col("n") > 1))).select(key, (F.col("pos") + 1).alias("line_no"), "line")


def furniture(line: Column, bare: Column, rules: Rules) -> Column:
    """Whether a line, ``bare`` being the same without white space at its edges, is page furniture."""
    named = F.lower(bare) if rules.lowered else bare
    out = named.isin(*rules.exact) if rules.exact else F.lit(False)
    for p in rules.prefixes:
        out = out | named.startswith(p)
    for p in rules.patterns:
        out = out | (bare if rules.lowered else line).rlike(p)
    return out


def line_array(text: Column, line_end: str = LINE_END) -> Column:
    """The lines of a text; a final line end makes no line of its own."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "^\ufeff+", ""), "\r\n?", "\n")
    return bound(F.split(body, line_end, -1), lambda x: F.when((F.size(x) > 1) & (F.element_at(x, -1) == ""), F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))


def clean_lines(lines: Column, rules: Rules) -> Column:
    """The lines that stay: blocks and furniture gone, blank runs shrunk to one line, none at the start. A line is in a
    block if the last line before it that opens or closes one has opened it."""
    end = "\r+$" if rules.keep_tails else f"{SPACE}+$"

    def event(bare: Column) -> Column:
        if not rules.block:
            return F.lit(0)
        return F.when(F.lower(bare) == rules.block[0], 1).when(F.lower(bare).startswith(rules.block[1]), -1).otherwise(0)

    pairs = F.transform(lines, lambda x: F.struct(x.alias("raw"), strip(x).alias("bare")))
    marked = F.transform(pairs, lambda x: F.struct(F.regexp_replace(x["raw"], end, "").alias("line"), (x["bare"] == "").alias("blank"), furniture(x["raw"], x["bare"], rules).alias("gone"), event(x["bare"]).alias("event")))

    def outside(m: Column) -> Column:
        opened = running_max(F.transform(m, lambda x, i: F.when(x["event"] == 0, 0).otherwise(2 * i + 2 + (x["event"] == 1).cast("int"))))
        return bound(opened, lambda last: F.filter(m, lambda x, i: (x["event"] != 1) & ((i == 0) | (F.get(last, i - 1) % 2 == 0))))

    if rules.block:
        marked = bound(marked, lambda m: F.when(F.exists(m, lambda x: x["event"] == 1), outside(m)).otherwise(m))
    stay = F.filter(marked, lambda x: ~x["gone"])
    return F.transform(bound(stay, lambda m: F.filter(m, lambda x, i: ~x["blank"] | ((i > 0) & ~F.get(m, i - 1)["blank"]))), lambda x: x["line"])


def clean_text(text: Column, rules: Rules = SOURCE) -> Column:
    """A text cleaned by ``rules`` in its row: nothing is exploded or moved."""
    ends = r"^\n+|\n+$" if rules.keep_tails else f"^{SPACE}+|{SPACE}+$"
    return F.regexp_replace(F.array_join(clean_lines(line_array(text, rules.line_end), rules), "\n"), ends, "")


def cleaned(docs: DataFrame, rules: Rules = SOURCE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, clean_text`` for each document."""
    return docs.select(key, clean_text(F.col(text), rules).alias("clean_text"))


# Lines that hold one of these are dropped by ``redacted``.
REDACTED = (
    "codex exec", "run-codex", "codex usage", "codex session", "codex-specific", "checkpoint", "progress.jsonl", "one-click launcher", "usage guard",
    "before final response", "do not use another llm", "external service", "this is codex", "codex_manual_extractive", '"method": "codex_manual_extractive"',
)


def redacted(text: Column, marks: tuple[str, ...] = REDACTED, renames: tuple[tuple[str, str], ...] = ()) -> Column:
    """A text without the lines that hold a mark, and with whole words renamed."""
    keep = lambda x: ~_any_of(F.lower(x), marks)
    out = F.array_join(F.filter(F.split(text, "\n", -1), keep), "\n")
    for old, new in renames:
        out = F.regexp_replace(out, rf"\b{old}\b", new)
    return out


def _any_of(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | F.contains(text, F.lit(m))
    return out


def heading_sections(docs: DataFrame, mark: str = "## ", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, section_no, title, body``: what follows each heading line, up to the next one."""
    order = Window.partitionBy(key).orderBy("line_no")
    rows = as_lines(docs, key, text, "\n").withColumn("is_head", F.col("line").startswith(mark))
    rows = rows.withColumn("section_no", F.sum(F.col("is_head").cast("int")).over(order)).where("section_no > 0")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_head"), F.struct("line_no", "line")))), lambda x: x["line"]), "\n")
    title = F.trim(F.substr(F.max(F.when(F.col("is_head"), F.col("line"))), F.lit(len(mark) + 1)))
    return rows.groupBy(key, "section_no").agg(title.alias("title"), body.alias("body"))


def first_line(rows: Column, pattern: str) -> Column:
    """The index of the first line that matches; null if none does."""
    return F.array_min(F.filter(F.transform(rows, lambda x, i: F.when(x.rlike(pattern), i)), lambda i: i.isNotNull()))


def block_from(rows: Column, at: Column, stops: tuple[str, ...]) -> Column:
    """The lines from index ``at`` to the earliest later one that matches a stop, as one stripped text; null without a
    start or if nothing is left."""

    def cut(at: Column) -> Column:
        stop = F.size(rows)
        if stops:
            stop = F.coalesce(F.array_min(F.filter(F.transform(rows, lambda x, i: F.when((i > at) & _matches(x, stops), i)), lambda i: i.isNotNull())), F.size(rows))
        return F.when(at.isNotNull(), F.nullif(strip(F.array_join(F.slice(rows, at + 1, F.greatest(stop - at, F.lit(0))), "\n")), F.lit("")))

    return bound(at, cut)


def line_block(rows: Column, start: str, stops: tuple[str, ...]) -> Column:
    """The block from the first line that matches ``start``."""
    return block_from(rows, first_line(rows, start), stops)


def _matches(x: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | x.rlike(p)
    return out
