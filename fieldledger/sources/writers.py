"""Sinks for the splits and the profile tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.records import decoded
from fieldledger.sources.published import Version, next_version, publish
from fieldledger.sources.readers import scan_text_lines

_OPEN_SETTING, _OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 16


def sink_jsonl_splits(
    lines: DataFrame,
    path: str,
    splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS),
    files_per_split: int | None = None,
    max_records_per_file: int = 0,
    keep: int = 1,
    compression: str | None = None,
) -> Version:
    """Publish the lines `(value, split)` as the next version of the splits below `path`.

    One pass writes all splits side by side into a folder that no reader looks at; then
    a manifest makes it the version that `scan_text_lines` and the others read
    (`published`). A writer that stops at any point leaves the version before it whole.
    A split of `splits` without lines is published as empty. `files_per_split` deals the
    finished lines out by split and content, so the work before it stays parallel.
    `compression` is a codec of Spark's text files, such as gzip; readers tell it by the
    file's name.
    """
    spark = lines.sparkSession
    rows = lines.select("value", "split")
    if files_per_split:
        part = F.pmod(F.xxhash64("value"), F.lit(files_per_split))
        rows = rows.repartition(len(splits) * files_per_split, "split", part)
    version = next_version(spark, path, splits)
    writer = _lines_writer(rows, max_records_per_file, compression)
    with _unsorted(spark):
        writer.mode("errorifexists").text(f"{path}/{version.folder}")
    publish(spark, path, version, keep)
    return version


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Tasks of the block keep a file open for each split, instead of sorting whole lines by
    it. Beyond so many splits the rest is sorted. A number that the session sets stays."""
    before = spark.conf.get(_OPEN_SETTING, "0")
    if int(before):
        yield
        return
    spark.conf.set(_OPEN_SETTING, str(_OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_SETTING, before)


def _lines_writer(rows: DataFrame, max_records_per_file: int, compression: str | None) -> DataFrameWriter:
    """Lines repeat much of each other, so gzip's fastest level already leaves a small part."""
    writer = rows.write.partitionBy("split").option("maxRecordsPerFile", max_records_per_file)
    return writer.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED"} if compression else {})


def sink_jsonl_partitioned(
    lines: DataFrame, path: str, max_records_per_file: int = 0, compression: str | None = None
) -> None:
    """Overwrite `<path>/split=<split>/` in a single pass, without a staged table."""
    writer = _lines_writer(lines.select("value", "split"), max_records_per_file, compression)
    with _unsorted(lines.sparkSession):
        writer.mode("overwrite").text(path)


def sink_verify_readback(
    spark: SparkSession,
    path: str,
    splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS),
    preview: int = fv.RECORD_PREVIEW,
) -> DataFrame:
    """Per split: lines, lines that do not parse, and the start of the first record.

    The first record is the smallest by instruction and output, so that it does
    not depend on file order. A split without lines has a row with count 0.
    """
    found, report = scan_text_lines(spark, path, splits)
    counted = None
    for split, lines in found.items():
        with_json, record = decoded(lines)
        parsed = with_json.select(
            record.is_object.alias("ok"),
            F.when(
                record.is_object,
                F.struct(record.text("instruction").alias("instruction"), record.text("output").alias("output")),
            ).alias("record"),
        )
        one = parsed.agg(
            F.count("*").alias("n_records"),
            F.count_if(~F.col("ok")).alias("n_unparsed"),
            F.min("record").alias("first"),
        ).select(
            F.lit(split).alias("split"),
            "n_records",
            "n_unparsed",
            F.col("first.instruction").alias("instruction"),
            F.substring("first.output", 1, preview).alias("output_preview"),
        )
        counted = one if counted is None else counted.unionByName(one)
    if counted is None:
        return report.select(
            "split",
            F.lit(0).cast("bigint").alias("n_records"),
            F.lit(0).cast("bigint").alias("n_unparsed"),
            F.lit(None).cast("string").alias("instruction"),
            F.lit(None).cast("string").alias("output_preview"),
        )
    return report.select("split").join(F.broadcast(counted), "split", "left").fillna(0, ["n_records", "n_unparsed"])


def sink_profile_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Overwrite one parquet folder per profile table (histogram, labels, split shares)."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
