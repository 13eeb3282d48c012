"""Verifiable rewards of answers, as Column builders; ``REGISTRY`` names them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lontar.functions.text import number_in


def exact_format(text: Column, closing: str, opening: str) -> Column:
    """3.0 for a text that ends its reasoning and holds one solution block, else 0."""
    return F.when(text.rlike(rf"(?s){closing}.*?{opening}(.+?)</SOLUTION>\s*$"), 3.0).otherwise(0.0)


def tag_counts(text: Column, *tags: str) -> Column:
    """Half a point for each tag that stands exactly once, minus one for each other."""
    out = F.lit(0.0)
    for tag in tags:
        n = (F.length(text) - F.length(F.replace(text, F.lit(tag), F.lit("")))) / len(tag)
        out = out + F.when(n == 1, 0.5).otherwise(-1.0)
    return out


def answer(guess: Column, truth: Column) -> Column:
    """5.0 exact, 3.5 but for white space, 2.0 or 1.5 near in ratio, else a penalty."""
    g, t = number_in(guess), number_in(truth)
    ratio = g / F.nullif(t, F.lit(0.0))
    return (
        F.when(guess.isNull(), -2.0)
        .when(guess == truth, 5.0)
        .when(F.trim(guess) == F.trim(truth), 3.5)
        .when(g.isNull() | t.isNull() | ratio.isNull(), -4.5)
        .when((ratio >= 0.9) & (ratio <= 1.1), 2.0)
        .when((ratio >= 0.8) & (ratio <= 1.2), 1.5)
        .otherwise(-2.5)
    )


def number(guess: Column, truth: Column) -> Column:
    """3.5 for an equal number, -1.5 for another, -2.5 for none, 0 if the truth has none."""
    g, t = number_in(guess), number_in(truth)
    return F.when(guess.isNull() | g.isNull(), -2.5).when(t.isNull(), 0.0).when(g == t, 3.5).otherwise(-1.5)


def language(found: Column, wanted: str, fallback: str = "en") -> Column:
    """5 for the wanted language, -3 for the fallback and for others, -5 without any."""
    return F.when(found == wanted, 5.0).when(F.coalesce(found, F.lit("und")).isin("und", ""), -5.0).when(found == fallback, -3.0).otherwise(-3.0)


def extractive(valid: Column, missing: Column, extra: Column, faithful: Column, f1: Column, empty_ok: Column, padding: Column, strict: bool = False) -> Column:
    """The composite reward of an extracted record: format, keys, faithfulness, span F1, empty sections, padding."""
    keys = F.when((missing == 0) & (extra == 0), 3.0).otherwise(F.greatest(F.lit(-4.0), 2.0 - 0.5 * (missing + extra)))
    total = F.when(valid, 3.0).otherwise(-4.0) + keys + 4.0 * faithful - 3.0 * (1.0 - faithful) + 5.0 * f1 + F.when(empty_ok, 2.0).otherwise(-1.0) - 2.0 * padding
    return F.least(total, F.lit(0.0)) if strict else total


REGISTRY = {"exact_format": exact_format, "tag_counts": tag_counts, "answer": answer, "number": number, "language": language, "extractive": extractive}
