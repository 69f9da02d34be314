"""Helpers that several operators share: slices of batches, sized joins, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.scratch import staged

#: Rows of a side that may be broadcast; a few long or short binary columns each.
BROADCAST_ROWS = 2_000_000

#: Bytes of text that one vectorised step takes at once, unless one text alone is longer.
SLICE_BYTES = 500_000

#: Edges that one task may hold while components are made.
FEW_EDGES = 250_000


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about `limit` bytes in all."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for at, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += size
        yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system at the end of a task.

    Workers serve many tasks of many stages, and would else stay as large as the largest
    of them made them. Where the C library has no such call, nothing is done.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def sized(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`small`, a staged table, marked for broadcast if it has at most `rows` rows.

    A larger one is left to a sort-merge join, whose hot keys adaptive execution
    splits, as both sides are shuffled for it.
    """
    return F.broadcast(small) if small.count() <= rows else small


def without_rows(df: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """The rows of `df` whose `row` is not among the staged `dropped`, without that column."""
    return df.join(sized(dropped), row, "left_anti").drop(row)


def numbered_rows(df: DataFrame, doc: str) -> tuple[DataFrame, str]:
    """`df` with a number for each row, under a column name that it does not have.

    The number is the id where ids are whole numbers, all different. Otherwise rows are
    numbered in a table that is written once.
    """
    row = "__row"
    while row in df.columns:
        row += "_"
    if dict(df.dtypes)[doc] in ("tinyint", "smallint", "int", "bigint"):
        ids = df.groupBy(F.col(doc).alias("id")).count()
        if ids.where("id is null or count > 1").isEmpty():
            return df.withColumn(row, F.col(doc).cast("long")), row
    return staged(df.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _signature(edges: DataFrame) -> tuple:
    mixed = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    return tuple(edges.agg(F.count("*"), F.sum(mixed), F.sum("v")).first())


def _least(edges: DataFrame, name: str) -> DataFrame:
    return sized(staged(edges.groupBy("u").agg(F.min("v").alias("m")), name))


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Alternates large and small stars, each an aggregate and a join on it. A round is
    written before the next one, so nothing is recomputed from far back. Up to `few`
    edges lie in one partition, where a round needs no shuffle; more are dealt out. Nodes
    are longs. Edges with a null end count for nothing; a node linked only with itself is
    its own root.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    ends = edges.where(a.isNotNull() & b.isNotNull())
    given = staged(
        ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    small = given.count() <= few

    def near(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if small else df

    now, seen = near(given).where("u > v"), None
    while seen != (signature := _signature(now)):
        seen = signature
        both = near(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = both.join(_least(both, "large-least"), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = near(staged(large.where("u > v").distinct(), "large-star"))
        stars = large.join(_least(large, "small-least"), "u")
        stars = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            large.groupBy("u").agg(F.min("v").alias("v"))
        )
        now = near(staged(near(stars).where("u > v").distinct(), "small-star"))
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    lows = near(given).select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return lows.join(linked, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))
