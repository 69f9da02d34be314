"""Job: incidents and activity log to JSON lines in three splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.report import ReportTemplate
from fieldledger.operators import clean, enrich, profile, quality, records, splits
from fieldledger.scratch import scratch_run, staged
from fieldledger.sources import readers, writers


@dataclass(frozen=True)
class DatasetConfig:
    """Paths and parameters; the defaults are the fixed values.

    `max_records` bounds the cleaned incidents, 0 keeps all. `spread` deals incidents
    that are read by few tasks (multi-line or compressed files) out over so many.
    """

    incidents_path: str
    log_paths: Sequence[str]
    output_path: str
    columns: Mapping[str, str] = field(default_factory=lambda: fv.INCIDENT_COLUMNS)
    names: Mapping[str, str] = field(default_factory=lambda: fv.COUNTRY_NAMES)
    years: Sequence[int] = fv.ACTIVITY_YEARS
    log_width: int = fv.ACTIVITY_WIDTH
    max_records: int = 0
    spread: int | None = None
    fractions: Mapping[str, float] = field(default_factory=lambda: fv.SPLIT_FRACTIONS)
    seed: int = fv.SEED
    random: bool = False
    multiline: bool = False
    spaced_json: bool = True
    files_per_split: int | None = None
    template: ReportTemplate = ReportTemplate()


@dataclass(frozen=True)
class DatasetReport:
    """Small tables about a finished run, also written below `<output>/_report`."""

    schema: DataFrame
    log_widths: DataFrame
    stages: DataFrame
    match_rate: DataFrame
    split_sizes: DataFrame
    readback: DataFrame


def build_dataset(spark: SparkSession, config: DatasetConfig) -> DatasetReport:
    """Publish the splits below `output_path`, written once, and report on them.

    The log is read for its widths and for the count per year and country. The incidents
    are read once, into a typed table that all counts and the records come from; counts
    of its committed rows are exact whatever tasks were repeated. Records are rendered in
    the pass that writes them; counts of the splits come from the read-back. Staged
    tables are removed at the end.
    """
    with scratch_run(spark):
        tables = _build(spark, config)
        path = f"{config.output_path}/_report"
        writers.sink_profile_tables(tables, path)
    return DatasetReport(**{name: spark.read.parquet(f"{path}/{name}") for name in tables})


def _build(spark: SparkSession, config: DatasetConfig) -> dict[str, DataFrame]:
    raw = readers.scan_headered_csv(spark, config.incidents_path, multiline=config.multiline)
    schema = quality.schema_presence_report(raw, config.columns, count_filled=False)
    judged = staged(clean.judged_incidents(readers.spread(raw, config.spread), config.columns), "incidents")
    incidents = clean.kept_incidents(judged)
    if config.max_records:
        incidents = staged(splits.bounded_sample(incidents, config.max_records, config.seed), "sample")

    widths = staged(quality.width_distribution(spark.read.text(list(config.log_paths))), "widths")
    quality.min_column_count_gate(widths)
    log = readers.scan_positional_tsv(spark, list(config.log_paths), config.log_width)
    activity = staged(
        enrich.activity_by_year_country(
            clean.activity_rows(log, config.years), readers.lookup_table(spark, config.names)
        ),
        "activity",
    )
    quality.non_empty_gate(activity, "activity")

    enriched = enrich.enrich_left(incidents, activity)
    lines = records.format_incident_records(enriched, config.template, config.spaced_json)
    has_keys = reduce(Column.__and__, (F.col(name).isNotNull() for name in clean.KEY_FIELDS))
    counts = staged(
        profile.stage_counts(
            (judged, {"raw": None, **{name: F.col(name) for name in clean.FLAGS}}),
            (enriched, {"sampled": None, "rendered": has_keys, "matched": has_keys & (F.col("evt_count") > 0)}),
            (activity, {"activity": None}),
        ),
        "stages",
    )
    quality.non_empty_gate(counts.filter("stage = 'rendered' and n_rows > 0"), "records")
    if config.random:
        drawn = splits.drawn_split(enriched, config.fractions, config.seed)
        tagged = records.format_incident_records(drawn, config.template, config.spaced_json)
    else:
        tagged = splits.hash_split(lines, ["instruction", "output"], config.fractions, config.seed)
    writers.sink_jsonl_splits(tagged, config.output_path, list(config.fractions), config.files_per_split)

    readback = staged(
        writers.sink_verify_readback(spark, config.output_path, list(config.fractions)), "readback"
    )
    named = {name: F.max(F.when(F.col("stage") == name, F.col("n_rows"))) for name in ("matched", "rendered")}
    return {
        "schema": schema,
        "log_widths": widths,
        "stages": quality.stage_gate(counts),
        "match_rate": counts.agg(named["matched"].alias("n_matched"), named["rendered"].alias("n_rows")).withColumn(
            "match_pct", F.floor(100 * F.col("n_matched") / F.col("n_rows"))
        ),
        "split_sizes": profile.estimated_split_sizes(readback, config.fractions, weight="n_records"),
        "readback": readback,
    }
