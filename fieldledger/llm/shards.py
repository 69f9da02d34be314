"""Sharding by extendible hashing.

A document's key is hashed, and the directory is indexed by the leading bits of the
hash. It begins with one bucket; a bucket that holds more than the byte limit splits on
its next bit, others stay, until every shard fits. A shard's name is the bits that its
documents share, so the directory tells a new document's shard as well.

The hash has 40 bits of the document's id and text, and below them 20 bits that differ
between rows, so that even many equal rows can be split. A document larger than the
limit has a shard of its own.

Bytes are summed up by leading bits first, all depths at once, and only rows of cells
that are still too large are counted again with more bits.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import numbered_rows, sized, text_or_empty
from fieldledger.llm.registry import query, table
from fieldledger.scratch import staged

#: Byte limit of a shard.
LIMIT = 16 << 20

#: Bits of the hash, those of them that come from the document, and how many a round adds.
BITS, OWN_BITS, STEP = 60, 40, 8


def document_hash(doc: Column, text: Column, row: Column) -> Column:
    """60 bits: 40 of the id and the text, 20 of the row's number."""
    own = F.md5(F.concat_ws(":", F.coalesce(doc.cast("string"), F.lit("")), F.md5(text)))
    high = F.conv(F.substring(own, 1, OWN_BITS // 4), 16, 10).cast("long")
    low = F.pmod(F.xxhash64(row), F.lit(1 << (BITS - OWN_BITS)))
    return F.shiftleft(high, BITS - OWN_BITS) + low


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(depth, prefix, bytes, docs) for each shard, from staged (bytes, hash)."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(STEP, ceil(log2(max(1, total / limit))) + 4))
    found, last, open_rows = None, None, rows
    while True:
        cells = open_rows.groupBy(F.shiftright("hash", BITS - high).alias("cell"))
        cells = cells.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
        prefix = F.expr(f"shiftright(cell, {high} - depth)").alias("prefix")
        buckets = depths.groupBy("depth", prefix).agg(
            F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")
        )
        fits = (F.col("bytes") <= limit) | (F.col("docs") <= 1) | (F.col("depth") == BITS)
        buckets = staged(buckets.withColumn("fits", fits), "buckets")
        above = buckets.where("not fits").select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        fit = buckets.where("fits").withColumn("parent", F.expr("shiftright(prefix, 1)"))
        leaves = fit.join(above, ["depth", "parent"]).drop("parent", "fits")
        if low == 0:
            leaves = leaves.unionByName(buckets.where("fits and depth = 0").drop("fits"))
        found = leaves if found is None else found.unionByName(leaves)
        last = buckets.where(f"not fits and depth = {high}").select(F.col("prefix").alias("cell"))
        if high == BITS or last.isEmpty():
            return staged(found, "directory")
        shifted = open_rows.withColumn("cell", F.shiftright("hash", BITS - high))
        open_rows = staged(shifted.join(sized(last), "cell", "left_semi").drop("cell"), "open-rows")
        low, high = high, min(BITS, high + STEP)


def shard_name() -> Column:
    """The bits of (depth, prefix); empty for a directory of one shard."""
    return F.when(F.col("depth") == 0, "").otherwise(
        F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    )


def _slim(docs: DataFrame, row: Column, doc: str, text: str) -> DataFrame:
    plain = text_or_empty(text)
    size = F.octet_length(plain).cast("long").alias("bytes")
    slim = docs.select(row.alias("row"), F.col(doc).alias("doc"), size, plain.alias("text"))
    hashed = document_hash(F.col("doc"), F.col("text"), F.col("row")).alias("hash")
    return staged(slim.select("row", "doc", "bytes", hashed), "hashes")


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    shards = directory(rows, limit)
    depths = [r[0] for r in shards.select("depth").distinct().collect()]  # at most BITS
    each = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in sorted(depths)])))
    each = each.withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - depth)"))
    named = shards.withColumnsRenamed({"bytes": "shard_bytes", "docs": "shard_docs"})
    return each.join(sized(named), ["depth", "prefix"]).withColumn("shard", shard_name())


def shard_documents(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per document: doc, shard, depth, shard_bytes, shard_docs.

    Null texts have no bytes, null ids a hash of their own. Equal rows may go to
    different shards. An empty table gives an empty result; other columns are not read.
    """
    rows = _slim(docs, F.monotonically_increasing_id(), doc, text)
    if rows.isEmpty():
        rows = rows.withColumn("depth", F.lit(0)).withColumn("shard", F.lit(""))
        nothing = F.lit(0).cast("long")
        return rows.select("doc", "shard", "depth", nothing.alias("shard_bytes"), nothing.alias("shard_docs"))
    return _placed(rows, limit).select("doc", "shard", "depth", "shard_bytes", "shard_docs")


def write_shards(
    docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> None:
    """Writes `docs` under `path`, one folder for each shard, with all their columns."""
    numbered, row = numbered_rows(docs, doc)
    name = "shard"
    while name in docs.columns:
        name += "_"
    rows = _slim(numbered, F.col(row), doc, text)
    placed = staged(_placed(rows, limit).select(F.col("row").alias(row), F.col("shard").alias(name)), "placed")
    near = numbered.join(sized(placed), row).drop(row).withColumn(name, F.concat(F.lit("b"), name))
    near.repartition(name).write.partitionBy(name).parquet(path)


@query(
    "op5_sharding",
    rf"""
    WITH hashed AS (
      SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
             ('0x' || substring(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, {OWN_BITS // 4}))::BIGINT AS h
      FROM documents),
    buckets AS (
      SELECT depth, h >> ({OWN_BITS} - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
      FROM hashed, (SELECT unnest(range(0, 25)) AS depth) GROUP BY ALL),
    shards AS (
      SELECT b.* FROM buckets b LEFT JOIN buckets a ON a.depth = b.depth - 1 AND a.prefix = b.prefix >> 1
      WHERE (b.shard_bytes <= {LIMIT} OR b.shard_docs <= 1)
        AND (b.depth = 0 OR (a.shard_bytes > {LIMIT} AND a.shard_docs > 1)))
    SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
           depth::INTEGER AS depth, shard_bytes, shard_docs
    FROM hashed JOIN shards ON prefix = h >> ({OWN_BITS} - depth)
    """,  # noqa: E501
)
def op5_sharding(spark, folder):
    return shard_documents(table(spark, folder, "documents")).withColumnRenamed("doc", "doc_id")
