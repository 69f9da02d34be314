"""Activity per year and country, and its join onto the incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.functions.casts import normalise_code
from fieldledger.operators.joins import MAX_BROADCAST_ROWS, join_dimension


def code_lookup_join(
    rows: DataFrame, lookup: DataFrame, code: str = "g_code", name: str = "g_country",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows with the name of their normalised code; rows without a name are dropped."""
    names = lookup.select(F.col("code").alias("_code"), F.col("name").alias(name))
    coded = rows.withColumn("_code", normalise_code(F.col(code)))
    return join_dimension(coded, names, ["_code"], "inner", max_rows).drop("_code")


def activity_by_year_country(
    rows: DataFrame, lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Number of log rows per year and country.

    Rows are counted by year and code before the lookup, so the join sees a few
    counts instead of the whole log, and a code with a large share of the log is
    already one row per task when it is shuffled. The second sum folds the
    spellings of one country.
    """
    per_code = rows.groupBy("g_year", "g_code").agg(F.count("*").alias("n"))
    named = code_lookup_join(per_code, lookup, max_rows=max_rows)
    return named.groupBy("g_year", "g_country").agg(F.sum("n").alias("evt_count"))


def join_activity(
    incidents: DataFrame, activity: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Every incident with the activity count of its year and country, NULL without one.

    `activity` has one row per year and country. Its size is measured, so pass a
    staged or otherwise cheap table.
    """
    keyed = activity.select(
        F.col("g_year").alias("year"), F.col("g_country").alias("country"), "evt_count"
    )
    return join_dimension(incidents, keyed, ["year", "country"], "left", max_rows)


def fill_missing_count(df: DataFrame, column: str = "evt_count") -> DataFrame:
    return df.fillna(0, [column])


def enrich_left(
    incidents: DataFrame, activity: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Every incident once, with its activity count or 0."""
    return join_activity(incidents, activity, max_rows).transform(fill_missing_count)


def match_rate(enriched: DataFrame, column: str = "evt_count") -> DataFrame:
    """Matched rows, all rows, and the whole percent rounded down; one pass."""
    return enriched.agg(
        F.count_if(F.col(column) > 0).alias("n_matched"), F.count("*").alias("n_rows")
    ).withColumn("match_pct", F.floor(100 * F.col("n_matched") / F.greatest(F.col("n_rows"), F.lit(1))))
