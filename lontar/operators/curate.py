"""Training rows from records: normal forms, splits without leaks, chat rows and reports."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import blank, bound

SEED = 3407
SHARES = (0.70, 0.15)


def reconstructed(spans: Column) -> Column:
    """The non-blank excerpts of each section by lines, sections apart by a blank line, in order."""
    section = lambda x: F.array_join(F.filter(x, lambda s: ~blank(s)), "\n")
    return F.array_join(F.filter(F.transform(spans, section), lambda s: s != ""), "\n\n")


def filled(spans: Column) -> Column:
    """How many sections have a non-blank excerpt."""
    return F.size(F.filter(spans, lambda x: F.exists(x, lambda s: ~blank(s))))


def record_hash(sha: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(sha, F.lit("")), F.concat(F.lit("fallback:"), F.sha2(name, 256)))


def hash_split(rows: DataFrame, group: str, key: str, seed: int = SEED) -> DataFrame:
    """``rows`` with ``split``: in each group 70 % sft and 15 % grpo (rounded half to even), the rest benchmark, in the
    order of a seeded hash. A row's rank is its rank among the rows of its hash range plus what the ranges before hold,
    so no task holds a group."""
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)
    rows = rows.withColumn("_h", order).withColumn("_range", F.substring("_h", 1, 3))
    sizes = rows.groupBy(group, "_range").agg(F.count("*").alias("_in"))
    ranges = Window.partitionBy(group).orderBy("_range")  # 4096 rows of a group at most
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_in").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_n": F.sum("_in").over(Window.partitionBy(group))})
    r, s = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_range").orderBy("_h", key))).alias("r"), sizes.alias("s")
    both = r.join(s, F.col(f"r.{group}").eqNullSafe(F.col(f"s.{group}")) & (F.col("r._range") == F.col("s._range")))
    place = F.col("r._r") + F.col("s._before")
    sft, grpo = (F.bround(F.col("s._n") * x).cast("int") for x in SHARES)
    kept = [F.col(f"r.`{c}`") for c in rows.columns if c not in ("_h", "_range")]
    return both.select(*kept, F.when(place <= sft, "sft").when(place <= sft + grpo, "grpo").otherwise("benchmark").alias("split"))


def exact_split(rows: DataFrame, group: str, key: str, seed: int = SEED) -> DataFrame:
    """The same split in the order of the standard library's seeded shuffle of the sorted keys. The shuffle is a single
    stream of numbers, so a group is shuffled in one task: for groups that fit one, as those of the original do."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        keys = sorted(table["key"])
        random.Random(seed).shuffle(keys)
        n = len(keys)
        a, b = int(round(n * SHARES[0])), int(round(n * SHARES[1]))
        names = ["sft"] * a + ["grpo"] * b + ["benchmark"] * (n - a - b)
        return pd.DataFrame({"grp": table["grp"].iloc[0], "key": keys, "split": names[:n]})

    kind = {c: rows.schema[c].dataType.simpleString() for c in (group, key)}
    return rows.select(F.col(group).alias("grp"), F.col(key).alias("key")).groupBy("grp").applyInPandas(run, f"grp {kind[group]}, key {kind[key]}, split string").toDF(group, key, "split")


def chat(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``key, messages`` with the turns of each conversation in order."""
    turns = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "role", F.col("text").alias("content"))))
    return rows.groupBy(key).agg(F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def advantage(rows: DataFrame, group: str, reward: str) -> DataFrame:
    """Rewards of each group less its mean, over its standard deviation; 0 without spread. Mean and deviation are
    partial aggregates joined back, so a large group stays in many tasks."""
    stats = rows.groupBy(group).agg(F.avg(reward).alias("mean"), F.stddev_pop(reward).alias("sd"))
    return rows.join(stats, group).withColumn("advantage", F.when(F.col("sd") == 0, 0.0).otherwise((F.col(reward) - F.col("mean")) / F.col("sd")))


def contaminated(docs: DataFrame, items: DataFrame, words: int = 13) -> DataFrame:
    """``doc_id, item_id`` where a document holds a benchmark item's text: only pairs that share one word n-gram of the
    item, that of the least hash, are compared, by containment of the whole text. The n-gram leaves out the item's first
    and last word, which the document may have glued to other characters; a short item's n-gram is all its inner words,
    and items of one or two words are tested against every document. A text is split and its words are hashed once; an
    n-gram's hash is that of its words' hashes."""
    split = lambda c: F.filter(F.split(c, r"[ \t\n\x0B\f\r]+"), lambda x: x != "")
    hashes = lambda c: F.transform(split(c), lambda w: F.xxhash64(w))
    gram = lambda ws, i, n: F.xxhash64(F.slice(ws, i + 1, n))
    i = items.where("text is not null").select("item_id", F.col("text").alias("item_text"), hashes(F.col("text")).alias("ws")).withColumn("n", F.least(F.size("ws") - 2, F.lit(words)))
    inner = bound(F.struct("ws", "n"), lambda x: F.array_min(F.transform(F.sequence(F.lit(1), F.size(x["ws"]) - x["n"] - 1), lambda k: gram(x["ws"], k, x["n"]))))
    g = i.where("n > 0").select("item_id", "item_text", "n", inner.alias("gram"))
    lengths = F.broadcast(g.select("n").distinct())  # at most ``words`` rows

    def grams(x: Column) -> Column:
        at = F.when(F.size(x["ws"]) >= x["n"], F.sequence(F.lit(0), F.size(x["ws"]) - x["n"])).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda k: gram(x["ws"], k, x["n"])))

    d = docs.crossJoin(lengths).select("doc_id", "n", F.explode(bound(F.struct(hashes(F.col("text")).alias("ws"), F.col("n").alias("n")), grams)).alias("gram"))
    hits = d.join(g, ["n", "gram"]).select("doc_id", "item_id", "item_text")
    hits = hits.join(docs.select("doc_id", "text"), "doc_id").where(F.contains("text", F.col("item_text"))).select("doc_id", "item_id")
    short = i.where("n <= 0").select("item_id", "item_text")
    held = docs.select("doc_id", "text").join(short.hint("shuffle_replicate_nl"), F.contains("text", F.col("item_text"))).select("doc_id", "item_id")
    return hits.union(held).distinct()
