"""Written tables between stages, in the folder that the cluster shares.

A stage that several jobs read is written once and read back. Unlike cached
blocks, written files outlive the executors that made them, and their row
counts are not doubled by a recomputed task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from fieldledger.folders import folder_names, remove_folder

_SETTING = "spark.checkpoint.dir"
_own_folder: dict[str, str] = {}
#: The folder of the block that a thread is in; threads do not see each other's.
_run: ContextVar[str | None] = ContextVar("run", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for an unset local session."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if "local" not in _own_folder:
        _own_folder["local"] = tempfile.mkdtemp(prefix="fieldledger-")
    return _own_folder["local"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the scratch root, or under that of the current run."""
    return f"{_run.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def kept_run(spark: SparkSession) -> Iterator[str]:
    """Staged tables of the block lie in one folder, which whoever opens it removes."""
    folder = scratch_path(spark, "run")
    before = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(before)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Staged tables of the block lie in one folder, which is removed at its end."""
    with kept_run(spark) as folder:
        try:
            yield
        finally:
            remove_folder(spark, folder)


def drop_unread(spark: SparkSession, folder: str, df: DataFrame) -> None:
    """Removes the staged tables of a run that `df` does not read.

    Their names are unlike any other, so they are told by the paths that `df` reads.
    """
    read = df.inputFiles()
    for name in folder_names(spark, folder):
        if not any(f"/{name}/" in path for path in read):
            remove_folder(spark, f"{folder}/{name}")


def staged(
    df: DataFrame, name: str, partition_by: str | None = None, options: Mapping[str, str | int] | None = None
) -> DataFrame:
    """The rows of `df`, written once as parquet, with the writer's `options`, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists").options(**options or {})
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
