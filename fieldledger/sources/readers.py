"""Scans. Each returns a lazy DataFrame; none infers types from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldledger import fixed_values as fv
from fieldledger.functions.records import decoded, record_columns, unread_kind
from fieldledger.sources.published import published_version, split_lines

CORRUPT = "_corrupt_record"
ROWS_PER_TASK = 250_000


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def positional_schema(width: int = fv.ACTIVITY_WIDTH) -> T.StructType:
    return text_schema([f"_c{i}" for i in range(width)])


def scan_headered_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Headered CSV with every column as a string; `""` inside quotes is one quote.

    Names come from the header. With `columns` the header must match them.
    `multiline` lets a quoted field hold line feeds, at the price of one task
    per file.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
    )
    if columns is not None:
        reader = reader.schema(text_schema(columns)).option("enforceSchema", False)
    return reader.csv(path)


def spread(scan: DataFrame, partitions: int | None, rows: int = 0, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The scan, dealt out over `partitions`; as it is for None.

    For input that is known not to split (compressed or multi-line files, one row
    group), which would otherwise leave the work after it to a task per file. With the
    number of its `rows` there are as many more partitions as keep each to about
    `per_task` rows, so that what a task sorts or writes does not grow with the input.
    """
    return scan.repartition(max(partitions, -(-rows // per_task))) if partitions else scan


def year_globs(base: str, years: Sequence[int] = fv.ACTIVITY_YEARS, pattern: str = "{base}/{year}*.csv") -> list[str]:
    """One path pattern per allowed year, so that other years are never listed or read."""
    return [pattern.format(base=base.rstrip("/"), year=year) for year in years]


def scan_positional_tsv(
    spark: SparkSession, paths: str | list[str], width: int = fv.ACTIVITY_WIDTH
) -> DataFrame:
    """Headerless TSV with columns `_c0`, `_c1`, ...; the width is given, not guessed."""
    return spark.read.schema(positional_schema(width)).option("delimiter", "\t").option("header", False).csv(paths)


def scan_text_lines(
    spark: SparkSession, base: str, splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS)
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Lines of each split, all of one version, and a report of what could be read.

    Splits are those that were published below `base`, or the folders `<base>/<split>.jsonl`.
    """
    version = published_version(spark, base)
    lines = {split: split_lines(spark, base, split, version) for split in splits}
    found = {split: df for split, df in lines.items() if df is not None}
    report = spark.createDataFrame(
        [(split, split in found) for split in splits], "split string, readable boolean"
    )
    return found, report


def scan_jsonl_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines as columns of `RECORD_KEYS`; a line that is no record is kept in `_corrupt_record`.

    Lines are read as everywhere else, by `decoded`: a record is one object on its line
    whose instruction and output are texts. Those two are empty where their key is
    missing, the others NULL.
    """
    return jsonl_records(spark.read.option("lineSep", "\n").text(path))


def jsonl_records(lines: DataFrame) -> DataFrame:
    """`scan_jsonl_records` of the lines `value`."""
    parsed, record = decoded(lines, keys=fv.RECORD_KEYS)
    columns = [column.alias(key) for key, column in record_columns(record).items()]
    return parsed.select(*columns, F.when(unread_kind(record).isNotNull(), F.col("value")).alias(CORRUPT))


def scan_split_records(spark: SparkSession, base: str, split: str) -> DataFrame:
    """`scan_jsonl_records` of a split, published below `base` or in `<base>/<split>.jsonl`."""
    lines = split_lines(spark, base, split)
    if lines is None:
        raise FileNotFoundError(f"no split {split} below {base}")
    return jsonl_records(lines)


def scan_part_files(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """Lines of all part files of a folder, or of all its files where none is a part file."""
    parts = _lines_with_file(spark.read.option("pathGlobFilter", pattern), path)
    return _lines_with_file(spark.read, path) if parts.isEmpty() else parts


def _lines_with_file(reader, path: str) -> DataFrame:
    return reader.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def lookup_table(spark: SparkSession, names: Mapping[str, str] = fv.COUNTRY_NAMES) -> DataFrame:
    """Code and name of a literal mapping; codes are unique because they are its keys."""
    return spark.createDataFrame(list(names.items()), "code string, name string")


def lookup_from_table(table: DataFrame, code: str, name: str) -> DataFrame:
    """Code and name of a reference table, one row per code; two names of a code are an error."""
    names = table.groupBy(F.col(code).alias("code")).agg(F.min(name).alias("name"), F.max(name).alias("last"))
    clash = F.raise_error(F.concat(F.lit("two names of code "), F.col("code"))).cast("string")
    return names.select("code", F.when(F.col("name") == F.col("last"), F.col("name")).when(F.col("last").isNotNull(), clash).alias("name"))
