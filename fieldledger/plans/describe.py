"""Job: profile of the written splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldledger import fixed_values as fv
from fieldledger.operators import profile, quality, records
from fieldledger.scratch import staged
from fieldledger.sources import readers, writers


def describe_dataset(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS),
) -> dict[str, DataFrame]:
    """Histogram, length statistics, labels, split shares and summary of the splits below `input_path`.

    The lines are read and parsed once, into staged counts per split, label and
    length; every table is made from those. A split that cannot be read is left
    out and marked in the table `readable`.
    """
    found, readable = readers.scan_text_lines(spark, input_path, splits)
    if not found:
        raise quality.EmptyStageError(f"no split of {list(splits)} under {input_path}")
    rows = records.profile_rows(records.union_splits(found))
    counts = quality.non_empty_gate(staged(profile.profile_counts(rows), "profile-counts"), "records")
    tables = {**profile.profile_tables(counts), "readable": readable}
    if output_path:
        writers.sink_profile_tables(tables, output_path)
    return tables
