"""Cleaning steps for the incident table and the activity log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.casts import double_or_zero, lenient_year, year_prefix
from fieldledger.functions.records import decoded

KEY_FIELDS = ("year", "country", "attack_type")
FLAGS = ("cleaned", "kills_missing", "kills_replaced", "wounds_missing", "wounds_replaced")


def project_rename(df: DataFrame, mapping: Mapping[str, str] = fv.INCIDENT_COLUMNS) -> DataFrame:
    """The mapped columns that exist, under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items() if old in df.columns])


def cast_measures(df: DataFrame) -> DataFrame:
    """Year as int, casualties as doubles that default to 0.0."""
    return df.withColumns(
        {
            "year": lenient_year(F.col("year")),
            "kills": double_or_zero(F.col("kills")),
            "wounds": double_or_zero(F.col("wounds")),
        }
    )


def drop_null_subset(df: DataFrame, subset: Sequence[str] = KEY_FIELDS) -> DataFrame:
    return df.na.drop(subset=list(subset))


def exclude_sentinel(df: DataFrame, column: str = "attack_type", sentinel: str = fv.UNKNOWN) -> DataFrame:
    """Rows whose column is set and is not exactly the sentinel."""
    return df.filter(F.col(column) != sentinel)


def keep_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def code_length_filter(df: DataFrame, column: str, length: int = fv.CODE_LENGTH) -> DataFrame:
    """Rows whose code has the length before any trimming."""
    return df.filter(F.length(column) == length)


def year_allow_list(df: DataFrame, column: str, years: Sequence[int] = fv.ACTIVITY_YEARS) -> DataFrame:
    return df.filter(F.col(column).isin([int(year) for year in years]))


def outlier_cap(df: DataFrame, column: str = "token_len", cap: int = fv.TOKEN_CAP) -> DataFrame:
    return df.filter(F.col(column) <= cap)


def matched_only(df: DataFrame, column: str = "evt_count") -> DataFrame:
    return df.filter(F.col(column) > 0)


def clean_incidents(raw: DataFrame, mapping: Mapping[str, str] = fv.INCIDENT_COLUMNS) -> DataFrame:
    """Renamed, typed incidents with year, country and a known attack type.

    Optional columns are not carried: nothing reads them later.
    """
    needed = {old: new for old, new in mapping.items() if new not in fv.OPTIONAL_INCIDENT_COLUMNS}
    return (
        raw.transform(project_rename, needed)
        .transform(cast_measures)
        .transform(drop_null_subset)
        .transform(exclude_sentinel)
    )


def cleaning_flags(
    raw: DataFrame, mapping: Mapping[str, str] = fv.INCIDENT_COLUMNS, sentinel: str = fv.UNKNOWN
) -> dict[str, Column]:
    """Conditions on raw incidents: what `clean_incidents` keeps, and what it replaces by 0."""
    source = {new: F.col(old) for old, new in mapping.items()}
    keys = (lenient_year(source["year"]).isNotNull(), source["country"].isNotNull(), source["attack_type"] != sentinel)
    flags = {"cleaned": F.coalesce(keys[0] & keys[1] & keys[2], F.lit(False))}
    for name in ("kills", "wounds"):
        given = source[name].try_cast("double")
        finite = F.coalesce(F.abs(given) < float("inf"), F.lit(False))
        flags[f"{name}_missing"] = flags["cleaned"] & source[name].isNull()
        flags[f"{name}_replaced"] = flags["cleaned"] & source[name].isNotNull() & ~finite
    return flags


def judged_incidents(raw: DataFrame, mapping: Mapping[str, str] = fv.INCIDENT_COLUMNS) -> DataFrame:
    """All raw incidents, renamed and typed, beside the `cleaning_flags`.

    Stage it: counts of what was dropped or replaced and the kept incidents then come
    from one reading of the source.
    """
    needed = {old: new for old, new in mapping.items() if new not in fv.OPTIONAL_INCIDENT_COLUMNS}
    typed = project_rename(raw.withColumns(cleaning_flags(raw, mapping)), {**needed, **{n: n for n in FLAGS}})
    return cast_measures(typed)


def kept_incidents(judged: DataFrame) -> DataFrame:
    """The incidents that `clean_incidents` keeps, of a staged `judged_incidents`."""
    return judged.where("cleaned").drop(*FLAGS)


def activity_rows(
    log: DataFrame,
    years: Sequence[int] = fv.ACTIVITY_YEARS,
    date: str = fv.ACTIVITY_DATE,
    code: str = fv.ACTIVITY_CODE,
) -> DataFrame:
    """Year and raw code of the log rows that have an allowed year and a full-length code."""
    return (
        log.select(year_prefix(F.col(date)).alias("g_year"), F.col(code).alias("g_code"))
        .transform(keep_not_null, "g_year", "g_code")
        .transform(code_length_filter, "g_code")
        .transform(year_allow_list, "g_year", years)
    )


def records_having_key(lines: DataFrame, key: str = "loss", step: str = "step", column: str = "value") -> DataFrame:
    """Step and key of the JSON log lines that hold the key, whatever its value.

    A null or a value that is no number gives NULL; `is_number` tells which rows have one.
    """
    parsed, record = decoded(lines, column, (key, step))
    number = record.number(key)
    return parsed.filter(record.has_key(key)).select(
        record.number(step).try_cast("bigint").alias(step), number.alias(key), number.isNotNull().alias("is_number")
    )
