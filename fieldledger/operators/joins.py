"""Joins against a dimension: broadcast when it is small, spread over salts when not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 32
_SALT = "_salt"


def is_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether `df` stays within both bounds; looks no further than one row beyond the first."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    row = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("size")).first()
    return row.n <= max_rows and (row.size or 0) <= max_bytes


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join of any number of facts with a dimension whose key is unique.

    The dimension's size is measured. Up to `max_rows` it is broadcast and the
    facts are not shuffled. Beyond, both sides are shuffled on the key and a
    salt, so that one key with a large share of the facts meets `salts` tasks
    instead of one. The salt comes from the fact's content and the number of its
    partition: a repeated task gives it again, and facts that are already dealt out
    by their key are spread as well.
    """
    if is_small(dimension, max_rows):
        return facts.join(F.broadcast(dimension), list(on), how)
    return salted_join(facts, dimension, on, how, salts)


def salted_join(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """The join on the key and a salt; beyond the bounds, so nothing is broadcast.

    Without the hint Spark may broadcast the copies: it takes them to be as large as the
    dimension they are made of.
    """
    salted = facts.withColumn(_SALT, F.pmod(F.xxhash64(*facts.columns) + F.spark_partition_id(), F.lit(salts)).cast("int"))
    copies = dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, _SALT], how).drop(_SALT)
