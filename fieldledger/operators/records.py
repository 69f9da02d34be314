"""Incident rows to JSON lines, and JSON lines to profile rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.records import decoded, encode_record, encode_record_spaced, record_columns, unread_kind
from fieldledger.functions.report import ReportTemplate, instruction_text, report_text
from fieldledger.functions.text import label_of, word_count
from fieldledger.operators.clean import KEY_FIELDS, keep_not_null
from fieldledger.operators.quality import layout_flags

#: The two outputs of a sift.
RECORDS, REJECTED = "records", "rejected"


def render_reports(enriched: DataFrame, template: ReportTemplate = ReportTemplate()) -> DataFrame:
    """The enriched incidents with `system`, `instruction` and `output` texts."""
    c = F.col
    return enriched.withColumns(
        {
            "system": F.lit(template.system),
            "instruction": instruction_text(template, c("attack_type"), c("country"), c("year")),
            "output": report_text(
                template,
                label=c("attack_type"),
                country=c("country"),
                year=c("year"),
                kills=c("kills"),
                wounds=c("wounds"),
                target=c("target_type"),
                weapon=c("weapon_type"),
                group=c("group_name"),
                count=c("evt_count"),
            ),
        }
    )


def format_incident_records(
    enriched: DataFrame, template: ReportTemplate = ReportTemplate(), spaced: bool = False
) -> DataFrame:
    """Enriched incidents with their JSON line in `value`.

    Rows without year, country or label are dropped by those columns, before any
    text is made: a filter on the line would render every record twice.
    """
    encode = encode_record_spaced if spaced else encode_record
    line = encode(F.col("system"), F.col("instruction"), F.col("output"))
    return render_reports(keep_not_null(enriched, *KEY_FIELDS), template).withColumn("value", line)


def tag_split(lines: DataFrame, split: str) -> DataFrame:
    return lines.withColumn("split", F.lit(split))


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of the splits, each with its split's name."""
    return reduce(DataFrame.unionByName, (tag_split(df, name) for name, df in splits.items()))


def profile_rows(lines: DataFrame, template: ReportTemplate = ReportTemplate()) -> DataFrame:
    """Split, word count and label of every JSON line; NULL where the line does not give one.

    The word count needs both texts, the label only the output. `parsed` marks
    the rows that have both, `kind` tells what keeps a line out, and `has_layout`
    whether the output is a whole report.
    """
    parsed, record = decoded(lines)
    texts = parsed.select(
        "split",
        record.text("instruction").alias("i"),
        record.text("output").alias("o"),
        record.is_json.alias("is_json"),
        record.is_object.alias("is_object"),
    )
    measured = texts.select(
        "split",
        word_count(F.concat("i", F.lit(" "), "o")).alias("token_len"),
        label_of(F.col("o")).alias("label"),
        (F.col("i").isNotNull() & F.col("o").isNotNull()).alias("has_texts"),
        F.when(~F.col("is_json"), "not_json")
        .when(~F.col("is_object"), "not_object")
        .when(F.col("i").isNull() | F.col("o").isNull(), "not_text")
        .alias("unread"),
        F.coalesce(layout_flags(F.col("o"), template)["has_layout"], F.lit(False)).alias("has_layout"),
    )
    labelled = F.when(F.col("label").isNull(), "no_label").otherwise("ok")
    return measured.select(
        "split",
        "token_len",
        "label",
        # Not from the word count, so that no words are counted where only this is read.
        (F.col("has_texts") & F.col("label").isNotNull()).alias("parsed"),
        F.coalesce("unread", labelled).alias("kind"),
        "has_layout",
    )


def sifted_lines(lines: DataFrame) -> DataFrame:
    """Every line `value` of a file scan with its `split`, `RECORDS` or `REJECTED`, and its
    record's keys.

    `rejected` is, for a line that is no record, a JSON object with the line, what is
    wrong with it (not_json, not_object or not_text) and where it stood: the file's name,
    the offset of the block of the file that a task read, and the number of the row in
    that task's reading. One pass can so write both outputs (`sink_jsonl_splits`).
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = lines.select(
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        row.alias("row"),
    )
    parsed, record = decoded(placed, keys=fv.RECORD_KEYS)
    kind = unread_kind(record)
    told = F.to_json(F.struct("value", kind.alias("kind"), "file_name", "block_start", "row"))
    return parsed.select(
        "value",
        F.when(kind.isNull(), RECORDS).otherwise(REJECTED).alias("split"),
        F.when(kind.isNotNull(), told).alias("rejected"),
        *(column.alias(key) for key, column in record_columns(record).items()),
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(value, kind, file_name, block_start, row) of the written `rejected` lines."""
    schema = "value string, kind string, file_name string, block_start bigint, row bigint"
    return lines.select(F.inline(F.array(F.from_json("value", schema))))
