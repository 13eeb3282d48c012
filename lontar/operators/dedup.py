"""Deduplication in order: by one key, by the fullest record, and greedily by several keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.operators.cut import cut


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The rank filter becomes a group limit, which drops most rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def fullest_of(rows: DataFrame, key: str, fullness: str, order: str) -> DataFrame:
    """The fullest row of each key, the first of equally full ones."""
    best = F.min_by(F.struct(*rows.columns), F.struct((-F.col(fullness)).alias("less"), F.col(order).alias("o")))
    return rows.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def provenance(rows: DataFrame, key: str, fullness: str, order: str, model: str) -> DataFrame:
    """The fullest row of each key with ``also_by``: the sorted distinct models of the rows before it, then the models
    of later rows that are not there yet, in order of appearance."""
    winner = fullest_of(rows, key, fullness, order)
    marks = rows.join(winner.select(key, F.col(order).alias("_won")), key).where(F.col(order) != F.col("_won"))
    before = F.array_sort(F.collect_set(F.when(F.col(order) < F.col("_won"), F.col(model))))
    after = F.transform(F.array_sort(F.collect_list(F.when(F.col(order) > F.col("_won"), F.struct(F.col(order).alias("o"), F.col(model).alias("m"))))), lambda x: x["m"])
    also = marks.groupBy(key).agg(before.alias("b"), after.alias("a"))
    return winner.join(also, key, "left").withColumn("also_by", F.coalesce(F.array_distinct(F.concat("b", "a")), F.array().cast("array<string>"))).drop("a", "b")


def greedy(rows: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``duplicate``: in order, a row is one iff one of its keys equals that of an earlier row that was
    kept. Empty and null keys match nothing; keys of dropped rows do not count; ``order`` is unique.

    Rounds decide all rows whose earlier neighbours are decided: a row whose key belongs to a kept earlier row is
    dropped, and one without an undecided earlier row of any of its keys is kept. The first undecided row is decided in
    every round, so they end; how many there are is the length of the longest chain of rows. Each round compares a row with its
    key's least kept and least undecided row, so nothing pairs up a key's rows.
    """
    long = reduce(DataFrame.unionByName, [rows.where(F.coalesce(F.col(k).cast("string"), F.lit("")) != "").select(F.col(order).alias("o"), F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys])
    long = cut(long.groupBy("kind", "value", "o").agg(F.lit(1).alias("_")).drop("_"))
    state = cut(rows.select(F.col(order).alias("o"), F.lit("?").alias("state")))
    while not state.where("state = '?'").isEmpty():
        known = long.join(state, "o")
        least = known.groupBy("kind", "value").agg(F.min(F.when(F.col("state") == "kept", F.col("o"))).alias("kept"), F.min(F.when(F.col("state") == "?", F.col("o"))).alias("open"))
        seen = known.where("state = '?'").join(least, ["kind", "value"]).groupBy("o").agg(F.bool_or(F.col("kept") < F.col("o")).alias("hit"), F.bool_or(F.col("open") < F.col("o")).alias("waits"))
        verdict = F.when(F.col("state") != "?", F.col("state")).when(F.coalesce("hit", F.lit(False)), "dropped").when(F.coalesce("waits", F.lit(False)), "?").otherwise("kept")
        state = cut(state.join(seen, "o", "left").select("o", verdict.alias("state")))
    return rows.join(state.select(F.col("o").alias(order), (F.col("state") == "dropped").alias("duplicate")), order)
