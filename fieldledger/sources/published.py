"""Versions of a set of splits, and the manifest that tells readers which one counts.

A version is a folder of its own, written in one pass. It is published by one small file
that is written after all its data and that Spark's committer puts in place at once, so
readers see the version before or the new one, each whole, whenever a writer stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import is_remote

from fieldledger.folders import folder_names, remove_folder

_MANIFEST = "_manifest"
_SCHEMA = "number bigint, folder string, splits array<string>"


@dataclass(frozen=True, order=True)
class Version:
    """`number` grows by one with each published version; `folder` is its name."""

    number: int
    folder: str
    splits: tuple[str, ...] = ()


def _read(reader, kind: str, path: str) -> DataFrame | None:
    """What lies at `path`; None where there is no such path."""
    try:
        return getattr(reader, kind)(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def published_version(spark: SparkSession, path: str) -> Version | None:
    """The version that readers see: of the manifests, the one with the highest number.

    Two writers that publish the same number at once are told apart by the folder's name.
    """
    found = _read(spark.read.schema(_SCHEMA), "json", f"{path}/{_MANIFEST}/*")
    last = found.orderBy("number", "folder", ascending=False).first() if found is not None else None
    return Version(last.number, last.folder, tuple(last.splits)) if last else None


def next_version(spark: SparkSession, path: str, splits: Sequence[str]) -> Version:
    """A version that no one has published, with a folder name of its own."""
    last = published_version(spark, path)
    number = last.number + 1 if last else 1
    return Version(number, f"v{number:06d}-{uuid.uuid4().hex[:12]}", tuple(splits))


def publish(spark: SparkSession, path: str, version: Version, keep: int = 1) -> None:
    """Makes `version`, whose data are written, the one that readers see.

    Versions that are more than `keep` numbers older are removed, with what a writer that
    stopped left of them. A remote session has no way to remove folders and leaves them.
    """
    row = [(version.number, version.folder, list(version.splits))]
    manifest = spark.createDataFrame(row, _SCHEMA).coalesce(1)
    manifest.write.mode("append").json(f"{path}/{_MANIFEST}/{version.number}")
    if is_remote():
        return
    for name in folder_names(spark, path):
        if name[:1] == "v" and name[1:7].isdigit() and int(name[1:7]) < version.number - keep:
            remove_folder(spark, f"{path}/{name}")
    for name in folder_names(spark, f"{path}/{_MANIFEST}"):
        if int(name) < version.number - keep:
            remove_folder(spark, f"{path}/{_MANIFEST}/{name}")


def split_folder(spark: SparkSession, path: str, split: str, version: Version | None = None) -> str:
    """Where the lines of a split lie: in the published version, or in `<path>/<split>.jsonl`."""
    version = version or published_version(spark, path)
    return f"{path}/{version.folder}/split={split}" if version else f"{path}/{split}.jsonl"


def split_lines(
    spark: SparkSession, path: str, split: str, version: Version | None = None
) -> DataFrame | None:
    """The lines `value` of a split; None where there is none of that name.

    A published split without lines is empty. Pass the version to read several splits of
    the same one.
    """
    version = version or published_version(spark, path)
    reader = spark.read.option("lineSep", "\n")
    found = _read(reader, "text", split_folder(spark, path, split, version))
    if found is None and version and split in version.splits:
        return spark.createDataFrame([], "value string")
    return found
