"""Readers for the named parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
