"""Folders in whatever file system Spark reads: listed and removed as a whole."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below `path`; none where there is no such path."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(folder) if entry.isDirectory()]


def mounted(spark: SparkSession, path: str) -> str | None:
    """The name under which machines see `path` as a folder of their own; None in a store that
    only Spark reads."""
    system, folder = _folder(spark, path)
    return folder.toUri().getPath() if system.getUri().getScheme() == "file" else None


def copy_in(spark: SparkSession, local: str, path: str) -> None:
    """Moves a folder of this machine to `path`."""
    system, folder = _folder(spark, path)
    system.copyFromLocalFile(True, spark._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), folder)
