"""Fidelity of one text against another: edit rates, token overlap, gates and corpus reports."""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lontar.functions.text import accuracy, compact, error_rate, squeezed, words


def _common(x: Sequence, y: Sequence) -> int:
    """The length of the common beginning, by halves of slices."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
    return low


def _trimmed(x: Sequence, y: Sequence) -> tuple[Sequence, Sequence]:
    """Both without their common beginning and end, which change neither edits nor what is left out of a common
    subsequence."""
    low = _common(x, y)
    x, y = x[low:], y[low:]
    end = _common(x[::-1], y[::-1])
    return x[: len(x) - end], y[: len(y) - end]


def _places(x: Sequence) -> dict:
    """The positions of each item as bits."""
    at: dict = {}
    for i, c in enumerate(x):
        at.setdefault(c, []).append(i)
    out = {}
    for c, found in at.items():
        bits = bytearray(found[-1] // 8 + 1)
        for i in found:
            bits[i >> 3] |= 1 << (i & 7)
        out[c] = int.from_bytes(bits, "little")
    return out


def edits(x: Sequence, y: Sequence) -> int:
    """The Levenshtein distance of two sequences. Bit-parallel (Myers, Hyyro), a whole column of the table in one
    integer."""
    x, y = _trimmed(x, y)
    if not x or not y:
        return len(x) + len(y)
    places, full, top, out = _places(x), (1 << len(x)) - 1, len(x) - 1, len(x)
    up, down = full, 0
    for c in y:
        same = places.get(c, 0)
        zero = ((((same & up) + up) ^ up) | same | down) & full
        more, less = (down | ~(zero | up)) & full, up & zero
        out += (more >> top) - (less >> top)
        more, less = (more << 1 | 1) & full, (less << 1) & full
        up, down = (less | ~(zero | more)) & full, more & zero
    return out


@F.pandas_udf(T.IntegerType())
def levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edits between two texts by character, in time that long texts allow."""
    return pd.Series([edits(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


@F.pandas_udf(T.StructType([T.StructField("edits", T.IntegerType()), T.StructField("shared", T.IntegerType())]))
def _by_words(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Edits between two word arrays, and the size of their multiset intersection."""
    pairs = [(list(x), list(y)) for x, y in zip(a, b, strict=True)]
    shared = [(Counter(x) & Counter(y)).total() for x, y in pairs]
    return pd.DataFrame({"edits": [edits(x, y) for x, y in pairs], "shared": shared}, dtype="int32")


@F.pandas_udf(T.DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 - (insertions and deletions) / (both lengths); 1 for two empty texts. Bit-parallel longest common subsequence,
    a whole row of the table in one integer."""

    def one(x: str, y: str) -> float:
        if not x and not y:
            return 1.0
        total = len(x) + len(y)
        x, y = _trimmed(x, y)
        places = _places(x)
        full = (1 << len(x)) - 1
        row = full
        for c in y:
            hit = row & places.get(c, 0)
            row = ((row + hit) | (row - hit)) & full
        common = len(x) - row.bit_count()
        return 1.0 - (len(x) + len(y) - 2 * common) / total

    return pd.Series([None if x is None or y is None else one(x, y) for x, y in zip(a, b, strict=True)])


def compared(pairs: DataFrame, primary: str = "primary", reference: str = "reference") -> DataFrame:
    """``pairs`` with edit counts and rates, and token precision, recall and F1."""
    p, r = F.coalesce(primary, F.lit("")), F.coalesce(reference, F.lit(""))
    rows = pairs.withColumns({"_ps": squeezed(p), "_rs": squeezed(r), "_pc": compact(p), "_rc": compact(r), "_pw": words(p), "_rw": words(r)})
    rows = rows.withColumns({
        "char_edits": levenshtein("_ps", "_rs"), "content_edits": levenshtein("_pc", "_rc"), "_w": _by_words("_pw", "_rw"),
        "chars": F.length("_rs"), "content_chars": F.length("_rc"), "ref_words": F.size("_rw"), "pri_words": F.size("_pw"), "_pn": F.length("_ps"), "_pcn": F.length("_pc"),
    })
    rows = rows.withColumns({"word_edits": F.col("_w.edits"), "shared": F.col("_w.shared")})
    precision = F.when(F.col("pri_words") == 0, (F.col("ref_words") == 0).cast("double")).otherwise(F.col("shared") / F.col("pri_words"))
    recall = F.when(F.col("ref_words") == 0, (F.col("pri_words") == 0).cast("double")).otherwise(F.col("shared") / F.col("ref_words"))
    rows = rows.withColumns({"cer": error_rate(F.col("char_edits"), F.col("chars"), F.col("_pn")), "content_cer": error_rate(F.col("content_edits"), F.col("content_chars"), F.col("_pcn")), "wer": error_rate(F.col("word_edits"), F.col("ref_words"), F.col("pri_words")), "token_precision": precision, "token_recall": recall})
    both = F.col("token_precision") + F.col("token_recall")
    rows = rows.withColumn("token_f1", F.when(both == 0, 0.0).otherwise(2 * F.col("token_precision") * F.col("token_recall") / both))
    rows = rows.withColumn("minimum_score", F.least(accuracy(F.col("content_cer")), F.col("token_recall")))
    return rows.drop("_ps", "_rs", "_pc", "_rc", "_pw", "_rw", "_w", "_pn", "_pcn")


def gate(pages: DataFrame, key: str, page: str, score: str, threshold: float) -> DataFrame:
    """For each document: lowest and highest page score (0 without pages), pages below the threshold, and the verdict."""
    low = F.coalesce(F.min(score), F.lit(0.0))
    below = F.array_sort(F.collect_list(F.when(F.col(score) < threshold, F.col(page))))
    rows = pages.groupBy(key).agg(F.count("*").alias("pages"), low.alias("lowest"), F.coalesce(F.max(score), F.lit(0.0)).alias("highest"), below.alias("below"))
    return rows.withColumn("status", F.when((F.col("lowest") >= threshold) & (F.size("below") == 0), "passed").otherwise("review"))


def distribution(rows: DataFrame, value: str) -> list[Column]:
    """Mean, median, 5th and 95th percentile, least and most of a column, 0 for no rows."""
    zero = lambda c, n: F.coalesce(c, F.lit(0.0)).alias(n)
    return [zero(F.mean(value), "mean"), zero(F.percentile(value, 0.5), "median"), zero(F.percentile(value, 0.05), "p05"), zero(F.percentile(value, 0.95), "p95"), zero(F.min(value), "least"), zero(F.max(value), "most")]


def hashed_bootstrap(rows: DataFrame, key: str, value: str, resamples: int, seed: str) -> DataFrame:
    """Bounds of the mean by a bootstrap without collecting rows: in each resample a row counts as often as a Poisson
    draw of mean 1 says, so resamples are partial sums. A hash of seed, number and key has eight draws of 32 bits, which
    serve eight resamples; hash by hash a row gives 16 sums, which are added up before anything is shuffled."""
    steps = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)
    v = F.col(value)

    def draws(j: int) -> Column:
        u = F.conv(F.substring("hash", 8 * j + 1, 8), 16, 10).cast("double") / float(1 << 32)
        return sum((F.when(u >= s, 1).otherwise(0) for s in steps[1:]), F.when(u >= steps[0], 1).otherwise(0))

    groups = -(-resamples // 8)
    each = rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    each = each.select("g", v, F.sha2(F.concat_ws(":", F.lit(seed), F.col("g").cast("string"), F.col(key).cast("string")), 256).alias("hash"))
    drawn = each.select("g", v, *[draws(j).alias(f"n{j}") for j in range(8)])
    sums = drawn.groupBy("g").agg(*[F.sum(F.col(f"n{j}") * v).alias(f"s{j}") for j in range(8)], *[F.sum(f"n{j}").alias(f"n{j}") for j in range(8)])
    means = sums.select("g", F.posexplode(F.array(*[F.col(f"s{j}") / F.nullif(F.col(f"n{j}"), F.lit(0)) for j in range(8)])).alias("j", "mean")).where(F.col("g") * 8 + F.col("j") < resamples)
    return means.agg(F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"), F.count("*").alias("resamples"))


def exact_bootstrap(values: list[float], resamples: int = 2000, seed: int = 20260611) -> tuple[float, float]:
    """The same bounds by the standard library's generator, for the short vector of one figure for each document."""
    if not values:
        return 0.0, 0.0
    rng = random.Random(seed)
    means = sorted(sum(rng.choices(values, k=len(values))) / len(values) for _ in range(resamples))

    def at(p: float) -> float:
        x = (len(means) - 1) * p
        i = int(x)
        return means[i] + (means[min(i + 1, len(means) - 1)] - means[i]) * (x - i)

    return at(0.025), at(0.975)
