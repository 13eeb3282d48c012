"""The queries of this subpackage, one for each operator, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lontar.sources.tables import table


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import lines

    return lines.op1(table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import sentencepieces

    return sentencepieces.op2(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import vectors

    return vectors.op3(table(spark, folder, "embeddings"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import toxicity

    return toxicity.op4(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import substrings

    return substrings.op5(table(spark, folder, "documents"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import minhash

    return minhash.op6(table(spark, folder, "documents"))


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import vectors

    return vectors.op7(table(spark, folder, "embeddings"))


def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import secrets

    return secrets.op8(table(spark, folder, "documents"))


def op9_mixing_to_weights(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import mixing

    return mixing.op9(table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from lontar.llm import tokenfiles

    return tokenfiles.op10(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), 2)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0]))) | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    from lontar.llm import lines

    return {"op1_line_dedup": lines.ORACLE}
