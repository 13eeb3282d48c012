"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

Every stage takes ``(spark, docs, folder)`` and works on all documents that the one before it kept. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm import lines, minhash, mixing, sentencepieces, toxicity
from lontar.llm.queries import vocabulary
from lontar.llm.common import scratch
from lontar.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model does not reject. Labels of documents outside ``docs`` are not used. Null and
    empty texts are scored by their (zero) features; repeated rows go or stay together; a score of 0.5 rejects. All columns
    pass through, also those named like the model's."""
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scored = toxicity.score(docs.select(row, "text"), model)
    return scored.where("predicted = 0").select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows; no document goes. Null and empty texts stay as they
    are, repeated rows get one result, and all columns pass through, also those named like the operator's."""
    own = [c for c in docs.columns if c.lower() in ("n_lines", "n_removed")]
    kept = lines.dedup_lines(docs.withColumnsRenamed({c: f"_{k}_{c}" for k, c in enumerate(own)})).drop("n_lines", "n_removed")
    return kept.withColumnsRenamed({f"_{k}_{c}": c for k, c in enumerate(own)}).select(*[f"`{c}`" for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id; documents without words or doc_id all
    stay. Rows that share a doc_id are one document and stay or go together."""
    gone = minhash.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix takes them, all of their columns with them. Documents without words go, as the
    mix takes none of them; a null source is a source; rows that share a doc_id share the mean of their shares."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, with the end id, and whether they decode to its text. Null texts count as empty."""
    coded = sentencepieces.encode(docs.select("doc_id", "source", "text"), vocabulary("piece_bpe_32k.model"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing_to_weights", mix_sources),
    ("sentencepiece", tokenize),
]

#: Trees, hash minima and merges are beyond SQL; tests/llm compares each stage and ``run`` with plain models.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The result of the last stage."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
