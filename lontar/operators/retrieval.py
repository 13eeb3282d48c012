"""Relations between entities, walks over them, and similarity search fused with structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def edges(*parts: tuple[DataFrame, str, str, str]) -> DataFrame:
    """``src, relation, dst`` from tables with a key column and a foreign key column."""
    out = None
    for table, relation, src, dst in parts:
        some = table.select(F.col(src).cast("string").alias("src"), F.lit(relation).alias("relation"), F.col(dst).cast("string").alias("dst"))
        out = some if out is None else out.unionByName(some)
    return out


def two_hop(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many ways lead from ``first.src`` over a shared middle to ``second.dst``. Both sides are counted by their
    middle before they meet."""
    a = first.groupBy("src", F.col("dst").alias("mid")).agg(F.count("*").alias("n"))
    b = second.groupBy(F.col("src").alias("mid"), "dst").agg(F.count("*").alias("m"))
    return a.join(b, "mid").groupBy("src", "dst").agg(F.sum(F.col("n") * F.col("m")).alias("ways"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_similar(vectors: DataFrame, query: list[float], k: int) -> DataFrame:
    """The ``k`` rows most like one vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.withColumn("score", cosine(F.col("embedding"), q)).orderBy(F.desc("score"), "vec_id").limit(k)


def fused(structure: DataFrame, meaning: DataFrame, key: str, weight: float, k: int | None = None) -> DataFrame:
    """Candidates of both sides ranked by the weighted sum of their scores, a missing score being 0; the first ``k`` of
    them, which are picked before the ranks are counted."""
    both = structure.select(key, F.col("score").alias("s"), F.lit(0.0).alias("m")).unionByName(meaning.select(key, F.lit(0.0).alias("s"), F.col("score").alias("m")))
    ranked = both.groupBy(key).agg(F.max("s").alias("s"), F.max("m").alias("m")).withColumn("score", weight * F.col("s") + (1 - weight) * F.col("m"))
    ranked = ranked.orderBy(F.desc("score"), key).limit(k) if k else ranked
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))
