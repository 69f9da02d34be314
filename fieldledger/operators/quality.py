"""Schema checks, gates and quality tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.records import DecodedRecord, decoded, unread_kind
from fieldledger.functions.report import ReportTemplate
from fieldledger.functions.text import label_of, word_count


class MissingColumnsError(ValueError):
    """The input lacks columns that the next step reads."""


class EmptyStageError(ValueError):
    """A stage has no rows."""


def schema_presence_report(
    df: DataFrame,
    mapping: Mapping[str, str] = fv.INCIDENT_COLUMNS,
    optional: Sequence[str] = fv.OPTIONAL_INCIDENT_COLUMNS,
    count_filled: bool = True,
) -> DataFrame:
    """Expected columns: required, present, and rows that fill them. One pass for all.

    Raises `MissingColumnsError` with the names of required columns that are not
    there. Without `count_filled` the table comes from the header alone, and no row
    is read.
    """
    missing = [name for name, target in mapping.items() if target not in optional and name not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing {missing} in {df.columns[:20]}")
    if not count_filled:
        rows = [(name, target, target not in optional, name in df.columns) for name, target in mapping.items()]
        return df.sparkSession.createDataFrame(rows, "column string, target string, required boolean, present boolean")
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(target).alias("target"),
            F.lit(target not in optional).alias("required"),
            F.lit(name in df.columns).alias("present"),
            (F.count(name) if name in df.columns else F.lit(0).cast("bigint")).alias("n_filled"),
        )
        for name, target in mapping.items()
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def min_column_count_gate(widths: DataFrame) -> DataFrame:
    """`widths`, a staged `width_distribution`, if any of its lines is wide enough.

    Raises `MissingColumnsError` otherwise; too narrow lines are counted in the table.
    """
    if widths.filter("wide_enough").isEmpty():
        raise MissingColumnsError("no line has enough columns")
    return widths


def _width(column: str, delimiter: str) -> Column:
    return F.regexp_count(F.col(column), F.lit(delimiter)) + 1


def width_distribution(
    lines: DataFrame, least: int = fv.ACTIVITY_MIN_WIDTH, delimiter: str = "\t", column: str = "value"
) -> DataFrame:
    """Rows per number of delimited fields, and whether that is enough."""
    counts = lines.groupBy(_width(column, delimiter).alias("n_columns")).agg(F.count("*").alias("n_rows"))
    return counts.withColumn("wide_enough", F.col("n_columns") >= least)


def required_fields_gate(records: DataFrame, required: Sequence[str] = fv.REQUIRED_RECORD_KEYS) -> DataFrame:
    """`records`, if it has the required columns."""
    missing = [name for name in required if name not in records.columns]
    if missing:
        raise MissingColumnsError(f"missing {missing}")
    return records


def missing_field_counts(lines: DataFrame, keys: Sequence[str] = fv.RECORD_KEYS, column: str = "value") -> DataFrame:
    """Per key: JSON objects, objects without it, objects where it is no string. One pass."""
    parsed, record = decoded(lines, column, keys)
    entries = [
        F.struct(
            F.lit(key).alias("field"),
            F.lit(key in fv.REQUIRED_RECORD_KEYS).alias("required"),
            F.count_if(record.is_object).alias("n_objects"),
            F.count_if(record.is_object & ~record.has_key(key)).alias("n_missing"),
            F.count_if(record.is_object & ~record.has_text_or_nothing(key)).alias("n_not_text"),
        )
        for key in keys
    ]
    return parsed.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def non_empty_gate(df: DataFrame, stage: str) -> DataFrame:
    """`df`, if it has a row."""
    if df.isEmpty():
        raise EmptyStageError(f"{stage} has no rows")
    return df


def stage_gate(counts: DataFrame) -> DataFrame:
    """Stage counts with a pass mark."""
    return counts.withColumn("passes", F.col("n_rows") > 0)


def corrupt_kind(record: DecodedRecord, output: Column) -> Column:
    return F.coalesce(unread_kind(record), F.when(label_of(output).isNull(), "no_label").otherwise("ok"))


def corrupt_record_report(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines by what keeps them out of the profile."""
    parsed, record = decoded(lines, column)
    kind = corrupt_kind(record, record.text("output"))
    return parsed.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_rows"))


def doubled_terminator_check(
    texts: DataFrame, marker: str = fv.CHAT_END_OF_TURN, column: str = "text"
) -> DataFrame:
    """Texts, and those that end in two end-of-turn markers."""
    return texts.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(column).endswith(marker * 2)).alias("n_doubled")
    )


def layout_flags(text: Column, template: ReportTemplate = ReportTemplate()) -> dict[str, Column]:
    """Whether the text has the header, the context section and the assessment section."""
    header = F.substring_index(text, "\n", 1)
    flags = {
        "has_header": header.startswith(template.header_opening) & header.rlike(r".\|[^|]*\|."),
        "has_context": text.contains("\n" + template.context_heading),
        "has_assessment": text.contains("\n" + template.assessment_heading),
    }
    flags["has_layout"] = flags["has_header"] & flags["has_context"] & flags["has_assessment"]
    return flags


def report_layout_check(
    reports: DataFrame, template: ReportTemplate = ReportTemplate(), text: str = "output", label: str = "label"
) -> DataFrame:
    """Reports per label, and how many have each part of the layout."""
    flags = layout_flags(F.col(text), template)
    return (
        reports.withColumns(flags)
        .groupBy(label)
        .agg(
            F.count("*").alias("n_rows"),
            *[F.count_if(flag).alias(flag.replace("has_", "n_")) for flag in flags],
        )
        .withColumn("layout_pct", F.floor(100 * F.col("n_layout") / F.col("n_rows")))
    )


def max_length_check(
    texts: DataFrame, limit: int = fv.MAX_SEQUENCE_LENGTH, column: str = "text"
) -> DataFrame:
    """Per split: texts, texts with more words than the limit, and the longest."""
    counted = texts.select("split", word_count(F.col(column)).alias("words"))
    return counted.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("words") > limit).alias("n_over"),
        F.max("words").alias("longest"),
    )
