"""Profile of a record set. Every table is a distributed aggregate; nothing is collected.

The tables can be made from rows, or from `profile_counts` of the rows: name its
count column as `weight`, and one pass over the data serves all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldledger import fixed_values as fv
from fieldledger.functions.text import thousands, whole_percent

WEIGHT = "n_rows"
BALANCE_KEYS = "split", "label", "parsed"
PROFILE_KEYS = (*BALANCE_KEYS, "token_len", "kind", "has_layout")


def _rows(weight: str | None) -> Column:
    return F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count("*")


def profile_counts(rows: DataFrame, keys: Sequence[str] = PROFILE_KEYS) -> DataFrame:
    """Number of rows per split, label and length: what the tables below need.

    With fewer `keys`, what the others are made of is not worked out: `BALANCE_KEYS` are
    enough for `label_balance` and `dataset_summary`, and count no words.

    Stage the result before making more than one table from it. A filter on it
    would otherwise be moved below the parsing, and parse every line again.
    """
    return rows.groupBy(*keys).agg(F.count("*").alias(WEIGHT))


def label_balance(df: DataFrame, label: str = "label", weight: str | None = None) -> DataFrame:
    return df.groupBy(label).agg(_rows(weight).alias("n_rows"))


def top_k_labels(balance: DataFrame, k: int = fv.TOP_LABELS, label: str = "label") -> DataFrame:
    """The k most frequent labels; equal counts are ordered by label."""
    return balance.orderBy(F.col("n_rows").desc(), F.col(label)).limit(k)


def head_preview(df: DataFrame, key: list[str], text: str, rows: int, width: int) -> DataFrame:
    """The first rows by key, with the beginning of their text."""
    return df.orderBy(*key).limit(rows).withColumn(text, F.substring(text, 1, width))


def stage_counts(*passes: tuple[DataFrame, Mapping[str, Column | None]]) -> DataFrame:
    """Rows per stage: for each table, the rows that each stage's condition holds for.

    One pass per table; a stage without a condition is all of its rows.
    """
    counted = [
        df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("stage"),
                        (F.count("*") if holds is None else F.count_if(holds)).alias("n_rows"),
                    )
                    for name, holds in stages.items()
                ]
            ).alias("entries")
        ).select(F.inline("entries"))
        for df, stages in passes
    ]
    return reduce(DataFrame.unionByName, counted)


def split_counts(
    df: DataFrame, weight: str | None = None, splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS)
) -> DataFrame:
    """Rows of every split, also of an empty one and of one that is not listed."""
    counts = df.groupBy("split").agg(_rows(weight).alias("n_rows"))
    none = F.lit(0).cast("bigint").alias("n_rows")
    listed = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, splits))).alias("split"), none)
    return counts.unionByName(listed).groupBy("split").agg(F.sum("n_rows").alias("n_rows"))


def _with_total(counts: DataFrame) -> DataFrame:
    # One row per split by now, so the single window partition is a handful of rows.
    return counts.withColumn("total", F.sum("n_rows").over(Window.partitionBy()))


def split_shares(
    df: DataFrame, weight: str | None = None, splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS)
) -> DataFrame:
    """Rows and rounded percentage per split."""
    counts = _with_total(split_counts(df, weight, splits))
    share = whole_percent(F.col("n_rows"), F.greatest("total", F.lit(1)))
    return counts.select("split", "n_rows", share.alias("share"))


def estimated_split_sizes(
    df: DataFrame, fractions: Mapping[str, float] = fv.SPLIT_FRACTIONS, weight: str | None = None
) -> DataFrame:
    """Rows per split beside the size that the fraction of the total suggests."""
    fraction = F.coalesce(*[F.when(F.col("split") == name, float(f)) for name, f in fractions.items()])
    counts = _with_total(split_counts(df, weight, tuple(fractions)))
    return counts.select("split", "n_rows", (F.col("total") * fraction).cast("bigint").alias("estimated"))


def training_schedule(
    df: DataFrame,
    batch: int = fv.BATCH_SIZE,
    accumulation: int = fv.GRADIENT_ACCUMULATION,
    max_steps: int = fv.MAX_STEPS,
    weight: str | None = None,
    splits: Sequence[str] = tuple(fv.SPLIT_FRACTIONS),
) -> DataFrame:
    """Steps per epoch and epochs covered by `max_steps`, per split; no epochs of no rows."""
    per_epoch = F.col("n_rows") / F.lit(batch * accumulation)
    return split_counts(df, weight, splits).select(
        "split",
        "n_rows",
        per_epoch.alias("steps_per_epoch"),
        F.round(F.lit(max_steps) / F.nullif(per_epoch, F.lit(0.0)), 2).alias("effective_epochs"),
    )


def token_length_histogram(
    df: DataFrame,
    length: str = "token_len",
    width: int = fv.TOKEN_BIN_WIDTH,
    cap: int = fv.TOKEN_CAP,
    weight: str | None = None,
) -> DataFrame:
    """Rows per bin of lengths, empty bins included; the bins hold every row with a length.

    The last bin below the cap holds the cap itself. One more bin, without an upper end,
    holds the lengths beyond it.
    """
    if cap % width:
        raise ValueError(f"the cap {cap} is no multiple of the width {width}")
    bins = cap // width
    within = F.least(F.floor(F.col(length) / width), F.lit(bins - 1))
    number = F.when(F.col(length) > cap, bins).otherwise(within).cast("int")
    given = df.filter(F.col(length).isNotNull())
    counts = given.groupBy(number.alias("bin")).agg(_rows(weight).alias("n_rows"))
    every = df.sparkSession.range(0, bins + 1, 1, 1).select(F.col("id").cast("int").alias("bin"))
    # `counts` has one row per bin, whatever the data.
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("bin") * width).alias("from_len"),
        F.when(F.col("bin") < bins, (F.col("bin") + 1) * width).alias("to_len"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
    )


def token_length_stats(
    df: DataFrame, length: str = "token_len", cap: int = fv.TOKEN_CAP, weight: str | None = None
) -> DataFrame:
    """Least, greatest and whole mean length up to the cap, and of all rows."""
    value = F.col(length)
    n = F.col(weight) if weight else F.lit(1)
    capped = value <= cap
    rows, kept = F.sum(F.when(value.isNotNull(), n)), F.sum(F.when(capped, n))
    return df.agg(
        F.coalesce(kept, F.lit(0)).cast("bigint").alias("n_capped"),
        F.min(F.when(capped, value)).alias("min_capped"),
        F.max(F.when(capped, value)).alias("max_capped"),
        F.floor(F.sum(F.when(capped, value * n)) / kept).alias("mean_capped"),
        F.coalesce(rows, F.lit(0)).cast("bigint").alias("n_all"),
        F.min(value).alias("min_all"),
        F.max(value).alias("max_all"),
        F.floor(F.sum(value * n) / rows).alias("mean_all"),
    )


def dataset_summary(counts: DataFrame, splits: list[str] = list(fv.SPLIT_FRACTIONS)) -> DataFrame:
    """One row: parsed rows, raw rows per split, distinct labels, most frequent label.

    `counts` is `profile_counts`. Rows are first folded to one per label, so
    that distinct labels and the most frequent one come out of the same pass.
    """
    n = F.col(WEIGHT)
    per_label = counts.groupBy("label").agg(
        F.coalesce(F.sum(F.when(F.col("parsed"), n)), F.lit(0)).alias("n_parsed"),
        *[F.coalesce(F.sum(F.when(F.col("split") == s, n)), F.lit(0)).alias(f"n_{s}") for s in splits],
    )
    found = F.col("n_parsed") > 0
    # The greatest count wins; among equal counts the smallest label, as above.
    best = F.min(F.when(found, F.struct((-F.col("n_parsed")).alias("minus_n"), F.col("label"))))
    return per_label.agg(
        F.sum("n_parsed").alias("n_parsed"),
        *[F.sum(f"n_{s}").alias(f"n_{s}") for s in splits],
        F.count_if(found).alias("n_labels"),
        best.alias("best"),
    ).select(
        "n_parsed",
        *[f"n_{s}" for s in splits],
        "n_labels",
        F.col("best.label").alias("top_label"),
        (-F.col("best.minus_n")).alias("top_count"),
    )


def split_display(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per split as they are printed: with thousands separators and a whole percentage."""
    return split_shares(df, weight).withColumn("n_rows_text", thousands(F.col("n_rows")))


def profile_tables(counts: DataFrame) -> dict[str, DataFrame]:
    """All tables of the profile from the staged `profile_counts`; `layout` only if it is a key."""
    parsed = counts.filter("parsed")
    tables = {
        "histogram": token_length_histogram(parsed, weight=WEIGHT),
        "length_stats": token_length_stats(parsed, weight=WEIGHT),
        "labels": label_balance(parsed, weight=WEIGHT),
        "top_labels": top_k_labels(label_balance(parsed, weight=WEIGHT)),
        "splits": split_shares(counts, weight=WEIGHT),
        "summary": dataset_summary(counts),
        "kinds": counts.groupBy("kind").agg(_rows(WEIGHT).alias("n_rows")),
    }
    if "has_layout" in counts.columns:
        tables["layout"] = parsed.groupBy("label").agg(
            _rows(WEIGHT).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("has_layout"), F.col(WEIGHT))), F.lit(0)).alias("n_layout"),
        )
    return tables
