"""Exact deduplication by deterministic naming of blocks.

A normalised text is cut into blocks of `BLOCK` bytes. Blocks that occur more than
once are sorted, and a block's place in that order is its integer name; a block that
occurs once needs no name of its own, as its document can equal no other. Names of
adjacent blocks are then paired, repeated pairs are sorted into new names, and so on
until a document is left with one name. Equal names mean equal texts: no hash
decides, so there are no collisions. Documents of different block counts end at
different levels, which are part of the identity.

Only DataFrame functions are used. Counts of blocks and pairs are combined before the
shuffle, and the joins that bring names back have both sides shuffled, so adaptive
execution splits a name that a third of all rows carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import numbered_rows, text_or_empty, without_rows
from fieldledger.llm.registry import query, table
from fieldledger.scratch import staged

#: Bytes of a block. Most texts are one block, long ones a few dozen.
BLOCK = 4096

#: The name of a block or pair that occurs once, and of what stands beside an odd last block.
ALONE, NOTHING = 1, 0


def normalised(text: Column) -> Column:
    """`text` with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _blocks(df: DataFrame, row: str, doc: str, text: str, block: int) -> DataFrame:
    size = F.lit(block)
    texts = df.select(
        F.col(row).alias("row"),
        F.col(doc).alias("doc"),
        normalised(text_or_empty(text)).cast("binary").alias("bytes"),
    )
    counted = texts.select(
        "row",
        "doc",
        "bytes",
        F.sha2("bytes", 256).alias("sha"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / size)).cast("int").alias("n"),
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.substring(F.col("bytes"), i * size + 1, size),
    )
    return counted.select("row", "doc", "sha", "n", F.posexplode(cut).alias("at", "block"))


def _names(values: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The repeated values, named -1, -2, ... by partition and order; gaps do no harm.

    The count has dealt the values out by hash and each is in one place, so they are
    sorted where they lie.
    """
    repeated = values.groupBy(*keys).count().where("count > 1").drop("count")
    ordered = repeated.sortWithinPartitions(*keys)
    return staged(ordered.withColumn("name", -F.monotonically_increasing_id() - 1), name)


def identities(df: DataFrame, row: str, doc: str, text: str, block: int = BLOCK) -> DataFrame:
    """(row, doc, sha, level, name): rows of one text, and only they, share (level, name).

    `name` is ALONE for a text that occurs once. Null texts count as empty ones.
    `row` must number the rows, for instance of a written table.
    """
    blocks = _blocks(df, row, doc, text, block)
    named = blocks.join(_names(blocks.select("block"), ["block"], "block-names"), "block", "left")
    name = F.coalesce("name", F.lit(ALONE).cast("long")).alias("name")
    first = F.when(F.col("at") == 0, F.col("sha")).alias("sha")
    now = staged(named.select("row", "doc", "n", "at", first, name), "named-blocks")
    texts = now.where("at = 0").select("row", "doc", "sha")
    level, done = 0, []
    while True:
        ended = F.lit(level).alias("level")
        done.append(now.where("n = 1").select("row", ended, "name"))
        now = now.where("n > 1").select("row", "n", "at", "name")
        if now.isEmpty():
            break
        level += 1
        even = F.col("at") % 2 == 0
        pairs = now.groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            F.max("n").alias("n"),
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NOTHING)).alias("b"),
        )
        shared = pairs.where(f"a < {NOTHING} and b <= {NOTHING}").select("a", "b")
        pairs = pairs.join(_names(shared, ["a", "b"], "pair-names"), ["a", "b"], "left")
        half = F.ceil(F.col("n") / 2).cast("int").alias("n")
        now = staged(pairs.select("row", half, "at", name), "named-pairs")
    ends = done[0]
    for other in done[1:]:
        ends = ends.unionByName(other)
    return texts.join(ends, "row")


def exact_groups(
    df: DataFrame,
    row: str | None = None,
    doc: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of `df`: its document, the one that stays, and its text's digest.

    Columns (row,) doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the
    smallest id stays, a null id last; of rows with the same id and text the first one
    read. An empty table gives an empty result. Other columns of `df` are not read.
    """
    given = row
    if row is None:
        row = "__row"
        df = df.select(doc, text).withColumn(row, F.monotonically_increasing_id())
    rows = staged(identities(df, row, doc, text, block), "identities")
    shared = rows.where(F.col("name") < NOTHING)
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    groups = shared.groupBy("level", "name").agg(
        F.min(order).alias("first"), F.count("*").alias("size")
    )
    groups = staged(groups.select("level", "name", "first.*", "size").drop("none"), "groups")
    groups = groups.withColumnsRenamed({"doc": "keep", "row": "keep_row"})
    joined = rows.join(groups, ["level", "name"], "left")
    alone = F.col("size").isNull()
    columns = [
        F.col("doc").alias("doc_id"),
        F.when(alone, F.col("doc")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ]
    return joined.select(*([F.col("row").alias(row)] if given else []), *columns)


def exact_dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the rows whose normalised text an earlier id has; all columns stay."""
    numbered, row = numbered_rows(docs, doc)
    groups = exact_groups(numbered, row, doc, text)
    return without_rows(numbered, row, staged(groups.where("not kept").select(row), "copies"))


@query(
    "op9_exact_dedup",
    r"""
    WITH n AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
      FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """,
)
def op9_exact_dedup(spark, folder):
    return exact_groups(table(spark, folder, "documents"))
