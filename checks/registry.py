"""Where the query modules put their queries."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a query under `name` with the SQL that must give the same rows."""

    def register(build):
        QUERIES[name] = build
        ORACLES[name] = textwrap.dedent(sql).strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
