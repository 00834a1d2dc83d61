"""All queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmill.plans import documents, extras, feeds, lists, postings, publication, rules, scalars, serving, stateful, storage  # noqa: F401  (they register)
from feedmill.plans.registry import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["base_match_latest"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
