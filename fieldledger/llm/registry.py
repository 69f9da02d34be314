"""Queries of this subpackage and the SQL that they are compared with."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Bytes of an Arrow batch for Python workers, where the session sets none. A batch is held
#: several times, in the executor and in the worker, and 10,000 whole texts are many bytes.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query `(spark, folder) -> DataFrame`, and its SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def reach(spark: SparkSession) -> None:
    """Lets Python workers that start with the driver's files find this package, and bounds
    the batches of text that they are given."""
    root = str(Path(__file__).resolve().parent.parent.parent)
    told = spark.sparkContext.environment
    paths = told.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        told["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
