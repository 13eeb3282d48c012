"""Lineage cuts for driver loops."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder of ``spark.checkpoint.dir``. Where it is unset: a temporary one in local mode, as in tests; on
    a cluster an error, as executors don't share such a folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lontar-"))
    return context.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
