"""Queries of the review table, of relations and of similarity search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.functions.text import head_preview
from lontar.operators import retrieval, review
from lontar.plans.registry import query
from lontar.sources.tables import table


@query(
    r"""SELECT doc_id, source || '::' || doc_id AS row_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10) || chr(10)) AS display,
  concat_ws(chr(10), CASE WHEN lang <> '' THEN 'bahasa asli: ' || lang END, CASE WHEN source <> '' THEN 'sumber: ' || source END) AS identity,
  CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g')) = '' THEN '-' WHEN length(trim(regexp_replace(text, '\s+', ' ', 'g'))) > 40 THEN left(trim(regexp_replace(text, '\s+', ' ', 'g')), 40) || '...' ELSE trim(regexp_replace(text, '\s+', ' ', 'g')) END AS preview FROM documents"""
)
def review_table(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat_ws("::", "source", "doc_id").alias("row_id"),
        review.display(F.split("text", "\n", -1)).alias("display"),
        review.labelled({"bahasa_asli": F.col("lang"), "sumber": F.col("source")}).alias("identity"),
        head_preview(F.col("text"), 40).alias("preview"),
    )


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND contains(lower(concat_ws(' ', doc_id::VARCHAR, source, text)), 'there')")
def review_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return review.search(rows, " There ", ["doc_id", "source", "text"], lang="en", source=None).select("doc_id", "lang", "source")


@query("SELECT 0 AS ord, 'all' AS value UNION ALL SELECT DISTINCT 1, lang FROM documents")
def review_facets(spark: SparkSession, folder: str) -> DataFrame:
    return review.facets(table(spark, folder, "documents"), "lang").select("ord", "value")


@query("WITH l AS (SELECT DISTINCT lang FROM documents UNION ALL SELECT 'xx'), s AS (SELECT DISTINCT source FROM documents), n AS (SELECT lang, source, count(*) AS files, sum(strlen(text)) AS bytes FROM documents GROUP BY ALL) SELECT lang, source, coalesce(files, 0) AS files, coalesce(bytes, 0)::BIGINT AS bytes FROM l CROSS JOIN s LEFT JOIN n USING (lang, source)")
def model_summary_zero_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    langs = rows.select("lang").distinct().union(spark.range(1).select(F.lit("xx").alias("lang")))
    names = rows.select("source").distinct().agg(F.collect_set("source").alias("s"))  # the producers, a handful by contract
    dims = langs.join(names).select("lang", F.explode("s").alias("source"))
    return review.sizes(rows, dims, ["lang", "source"], "text")


@query("SELECT source, count(*) AS rows, count(*) FILTER (WHERE l.quality = 1) AS verified, count(*) FILTER (WHERE l.quality = 1) = count(*) AS done FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source")
def verified_progress(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").withColumn("on", F.col("quality") == 1)
    saved = review.toggled(labels, "doc_id", "on", "doc_id")
    rows = review.flags(table(spark, folder, "documents").select("doc_id", "source"), saved, "doc_id")
    return rows.groupBy("source").agg(F.count("*").alias("rows"), F.count_if("verified").alias("verified"), F.bool_and("verified").alias("done"))


@query("SELECT source, regexp_extract(source, '\\d+')::INT AS n FROM (SELECT DISTINCT source FROM documents)")
def locale_order(spark: SparkSession, folder: str) -> DataFrame:
    """Sources in the order of a locale's collation."""
    rows = table(spark, folder, "documents").select("source").distinct()
    return rows.orderBy(F.collate("source", "id")).select("source", F.regexp_extract("source", r"\d+", 0).cast("int").alias("n"))


@query("SELECT c_custkey::VARCHAR AS src, 'lives_in' AS relation, c_nationkey::VARCHAR AS dst FROM customer UNION ALL SELECT o_orderkey::VARCHAR, 'ordered_by', o_custkey::VARCHAR FROM orders UNION ALL SELECT n_nationkey::VARCHAR, 'part_of', n_regionkey::VARCHAR FROM nation")
def kg_edges(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.edges((table(spark, folder, "customer"), "lives_in", "c_custkey", "c_nationkey"), (table(spark, folder, "orders"), "ordered_by", "o_orderkey", "o_custkey"), (table(spark, folder, "nation"), "part_of", "n_nationkey", "n_regionkey"))


@query("SELECT c.c_mktsegment AS src, n.n_name AS dst, count(*) AS ways FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL")
def kg_two_hop(spark: SparkSession, folder: str) -> DataFrame:
    lives = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("src"), F.col("c_nationkey").alias("dst"))
    names = table(spark, folder, "nation").select(F.col("n_nationkey").alias("src"), F.col("n_name").alias("dst"))
    return retrieval.two_hop(lives, names)


@query("SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total, round(max(o_totalprice), 2) AS largest FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 1000 GROUP BY n_name")
def court_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of each nation over a threshold: the shape of decisions by court."""
    big = table(spark, folder, "orders").where("o_totalprice > 1000")
    rows = big.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("largest"))
    named = rows.join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", "orders", F.round("total", 2).alias("total"), F.round("largest", 2).alias("largest"))


@query("SELECT l_suppkey, count(*) AS charges, count(DISTINCT l_partkey) AS articles, round(sum(l_extendedprice * (1 - l_discount)), 2) AS restitution FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY l_suppkey HAVING sum(l_extendedprice * (1 - l_discount)) > 10000")
def restitution_by_judge(spark: SparkSession, folder: str) -> DataFrame:
    paid = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    rows = table(spark, folder, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    out = rows.groupBy("l_suppkey").agg(F.count("*").alias("charges"), F.countDistinct("l_partkey").alias("articles"), paid.alias("restitution")).where("restitution > 10000")
    return out.withColumn("restitution", F.round("restitution", 2))


_QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = 7)"
_COS = f"list_sum(list_transform(list_zip(embedding, {_QUERY}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform({_QUERY}, lambda x: x::DOUBLE * x::DOUBLE))))"


def _similar(spark: SparkSession, folder: str, k: int) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    one = rows.where("vec_id = 7").select("embedding").limit(1).collect()  # the query vector
    return retrieval.top_similar(rows, one[0]["embedding"] if one else [], k)


@query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings ORDER BY {_COS} DESC, vec_id LIMIT 20")
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _similar(spark, folder, 20).select("vec_id", "label", F.round("score", 6).alias("score"))


@query(
    f"""WITH m AS (SELECT vec_id, round({_COS}, 6) AS score FROM embeddings ORDER BY {_COS} DESC, vec_id LIMIT 20), s AS (SELECT vec_id, 0.5 AS score FROM embeddings WHERE label = 3),
u AS (SELECT vec_id, max(s) AS s, max(m) AS m FROM (SELECT vec_id, score AS s, 0.0 AS m FROM s UNION ALL SELECT vec_id, 0.0, score FROM m) GROUP BY vec_id)
SELECT vec_id, round(0.4 * s + 0.6 * m, 6)::DOUBLE AS score, row_number() OVER (ORDER BY 0.4 * s + 0.6 * m DESC, vec_id)::INT AS rank FROM u"""
)
def hybrid_fusion(spark: SparkSession, folder: str) -> DataFrame:
    meaning = _similar(spark, folder, 20).select("vec_id", F.round("score", 6).alias("score"))
    structure = table(spark, folder, "embeddings").where("label = 3").select("vec_id", F.lit(0.5).alias("score"))
    return retrieval.fused(structure, meaning, "vec_id", 0.4).select("vec_id", F.round("score", 6).alias("score"), "rank")
