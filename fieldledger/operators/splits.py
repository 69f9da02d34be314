"""Bounded samples and splits."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldledger import fixed_values as fv
from fieldledger.scratch import staged

_BUCKETS = 10_000
_KEY, _BUCKET, _COPIES, _BEFORE, _TAKE = "_key", "_bucket", "_copies", "_before", "_take"
# Leading zeros and three digits of a hex hash: buckets that get finer toward zero.
_HASH_BUCKET = "^0*[1-9a-f]?[0-9a-f]?[0-9a-f]?"
_COPY_BLOCK = 4096
# Row groups are small, so that a file can be cut about where Spark cuts it.
_PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": 6, "parquet.block.size": 8 << 20}
_FILE, _FEW_FILES, _EVEN = "_file", 16, 1.25


def row_key(columns: Sequence[str], missing: str = "\\N") -> Column:
    """The columns as one string."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(missing)) for name in columns]
    return texts[0] if len(texts) == 1 else F.concat_ws("\x1f", *texts)


def seeded_md5(key: Column, seed: int = fv.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def bounded_sample(df: DataFrame, limit: int = 0, seed: int = fv.SEED) -> DataFrame:
    """The `limit` rows with the smallest seeded hash of their content; all rows for 0.

    The same rows are kept however the input is partitioned, and the result
    keeps its partitions. Copies of a row are interchangeable and may be kept
    in part.

    No task sorts the input. A first pass counts rows per hash bucket; buckets
    are finer toward zero, so the one that crosses the limit holds about
    `limit / 256` distinct rows whatever the size of the input. Only rows of
    the buckets up to that one are shuffled, after their copies are counted
    where they lie.
    """
    if limit <= 0:
        return df
    columns = df.columns
    keyed = df.withColumn(_KEY, seeded_md5(row_key(columns), seed)).withColumn(
        _BUCKET, F.regexp_extract(_KEY, _HASH_BUCKET, 0)
    )
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        keyed.groupBy(_BUCKET)
        .agg(F.count("*").alias("n"))
        .select(_BUCKET, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
        .filter(F.col(_BEFORE) < limit)
    )
    # At most 16 * 256 buckets per leading zero of the hash, hence the broadcast.
    distinct = (
        keyed.join(F.broadcast(reached), _BUCKET)
        .groupBy(*columns, _KEY, _BUCKET, _BEFORE)
        .agg(F.count("*").alias(_COPIES))
    )
    within = (
        Window.partitionBy(_BUCKET).orderBy(_KEY, *columns).rowsBetween(Window.unboundedPreceding, -1)
    )
    taken = distinct.withColumn(
        _TAKE,
        F.least(
            F.col(_COPIES),
            F.lit(limit) - F.col(_BEFORE) - F.coalesce(F.sum(_COPIES).over(within), F.lit(0)),
        ),
    ).filter(F.col(_TAKE) > 0)
    return _repeat_rows(taken, _TAKE).select(*columns)


def _repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its count says, in blocks that are spread before they unfold."""
    last_block = F.floor((F.col(times) - 1) / _COPY_BLOCK)
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    blocks = blocks.repartition(_KEY, "_block")
    left = F.col(times) - F.col("_block") * _COPY_BLOCK
    size = F.least(left, F.lit(_COPY_BLOCK)).cast("int")
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))


def split_bucket(key: Column, seed: int = fv.SEED) -> Column:
    """Number from 0 to 9999 that depends on the key's content only."""
    head = F.conv(F.substring(seeded_md5(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(_BUCKETS))


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    fractions: Mapping[str, float] = fv.SPLIT_FRACTIONS,
    seed: int = fv.SEED,
) -> DataFrame:
    """Rows with a `split` name; equal keys always share a split. No shuffle."""
    return df.withColumn("split", _cut(split_bucket(row_key(key), seed), fractions))


def _cut(bucket: Column, fractions: Mapping[str, float]) -> Column:
    """The split of a number from 0 to 9999. A finer fraction is refused, not rounded away."""
    fine = {name: f for name, f in fractions.items() if abs(f * _BUCKETS - round(f * _BUCKETS)) > 1e-6}
    if fine:
        raise ValueError(f"fractions must be whole parts of {_BUCKETS}: {fine}")
    *names, last = fractions
    upper = accumulate(fractions[name] for name in names)
    below = [F.when(bucket < round(cut * _BUCKETS), name) for name, cut in zip(names, upper)]
    return F.coalesce(*below, F.lit(last))


def random_split(
    df: DataFrame, fractions: Mapping[str, float] = fv.SPLIT_FRACTIONS, seed: int = fv.SEED
) -> DataFrame:
    """Rows with a `split` name drawn for each row; one pass, no sort.

    The draw depends on how `df` is partitioned, so write the result once before reading
    it more than once.
    """
    # The draw is a column of its own, or each comparison would draw anew.
    drawn = df.withColumn(_BUCKET, F.floor(F.rand(seed) * _BUCKETS))
    return drawn.withColumn("split", _cut(F.col(_BUCKET), fractions)).drop(_BUCKET)


def drawn_split(
    df: DataFrame, fractions: Mapping[str, float] = fv.SPLIT_FRACTIONS, seed: int = fv.SEED
) -> DataFrame:
    """Rows with a `split` name drawn for each copy of a row, from its content and number.

    The draw is the same however `df` is partitioned and whatever tasks are repeated.
    Equal rows are numbered 1, 2, ... without being gathered: they are counted where they
    lie, the counts are added and written once, and each row unfolds from its count. Rows
    with many copies are spread in blocks before that. Columns must be groupable (no maps);
    NULL is a value like any other.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count("*").alias(_TAKE)).withColumn(_KEY, row_key(columns))
    counted = staged(counted, "copies")
    few = counted.filter(F.col(_TAKE) <= _COPY_BLOCK).withColumn(
        "_number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_TAKE)))
    )
    many = _repeat_rows(counted.filter(F.col(_TAKE) > _COPY_BLOCK), _TAKE).withColumn(
        "_number", F.col("_block") * _COPY_BLOCK + F.col("_copy")
    )
    numbered = few.select(*columns, _KEY, "_number").unionByName(many.select(*columns, _KEY, "_number"))
    draw = split_bucket(F.concat_ws("\x1f", _KEY, F.col("_number").cast("string")), seed)
    return numbered.select(*columns, _cut(draw, fractions).alias("split"))


def coalesce_output(df: DataFrame, files: int | None) -> DataFrame:
    """The rows in `files` partitions, spread evenly; unchanged for None.

    A file is written by one task, so each task reads its share of the rows, however they
    get there. For few files, where that share is large, the tasks of `df` deal their rows
    out to a staged folder per file, as tightly packed columns, and each partition reads
    a folder: about half the bytes that a shuffle of rows would bring to it. For
    more files, and where the folders do not give even partitions, the rows are shuffled.
    """
    if not files:
        return df
    if files > _FEW_FILES:
        return df.repartition(files)
    number = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(files))
    packed = staged(df.withColumn(_FILE, number), "packed", partition_by=_FILE, options=_PACKED)
    folders = [packed.filter(F.col(_FILE) == n).drop(_FILE) for n in range(files)]
    # Folders are cut into equally many pieces, and coalesce joins neighbours.
    dealt = reduce(DataFrame.unionAll, folders).coalesce(files)
    # No column is read, so the rows come from the files' footers.
    rows = [n for _, n in dealt.groupBy(F.spark_partition_id()).count().collect()]
    even = len(rows) == files and max(rows) * files <= _EVEN * sum(rows)
    return dealt if even else packed.drop(_FILE).repartition(files)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """`df` kept for the length of the block and released after it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
