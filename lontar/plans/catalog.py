"""The catalogue of queries over the reference tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lontar.plans import crawl, datasets, fidelity, logs, records, review, streams, texts, work  # noqa: F401
from lontar.plans.registry import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
