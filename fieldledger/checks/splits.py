"""Samples, splits and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.operators import profile, records, splits
from fieldledger.scratch import scratch_path, staged

SAMPLE = 20_000
ROW_KEY = " || chr(31) || ".join(
    f"coalesce({name}, '\\N')"
    for name in (
        "iyear", "country_txt", "attacktype1_txt", "targtype1_txt", "weaptype1_txt", "nkill", "nwound", "gname"
    )
)


@query(
    "bounded_sample",
    f"with {sql.INCIDENTS_RAW} select * from incidents_raw order by md5('42:' || {ROW_KEY}) limit {SAMPLE}",
)
def bounded_sample(spark: SparkSession, folder: str) -> DataFrame:
    return splits.bounded_sample(proxies.incidents_raw(spark, folder), SAMPLE)


@query(
    "random_split",
    "select cast(count(*) as bigint) as n_rows, cast(count(*) as bigint) as n_split, true as disjoint, true as exhaustive, "
    "true as near_fractions from documents",
)
def random_split(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.table(spark, folder, "documents")
    drawn = staged(splits.random_split(docs.select("doc_id"), fv.SPLIT_FRACTIONS), "drawn")
    per_doc = (
        drawn.select("doc_id", "split", F.lit(1).alias("taken"), F.lit(0).alias("given"))
        .unionByName(docs.select("doc_id", F.lit(None).cast("string").alias("split"), F.lit(0).alias("taken"), F.lit(1).alias("given")))
        .groupBy("doc_id")
        .agg(F.sum("taken").alias("taken"), F.sum("given").alias("given"), F.max("split").alias("split"))
    )
    rows = F.count("*")
    # Within five standard deviations of a Bernoulli draw.
    near = [
        F.abs(F.count_if(F.col("split") == name) - rows * f) <= 5 * F.sqrt(rows * f * (1 - f))
        for name, f in fv.SPLIT_FRACTIONS.items()
    ]
    return per_doc.agg(
        F.sum("given").alias("n_rows"),
        F.sum("taken").alias("n_split"),
        F.bool_and(F.col("taken") <= F.col("given")).alias("disjoint"),
        F.bool_and(F.col("taken") >= F.col("given")).alias("exhaustive"),
        reduce(Column.__and__, near).alias("near_fractions"),
    )


@query(
    "random_split_drawn",
    f"select lang, source, {sql.split_of('key || chr(31) || copy')} as split, cast(count(*) as bigint) as n_rows from ("
    "select lang, source, coalesce(lang, '\\N') || chr(31) || coalesce(source, '\\N') as key, "
    "row_number() over (partition by lang, source) as copy from documents) group by 1, 2, 3",
)
def random_split_drawn(spark: SparkSession, folder: str) -> DataFrame:
    copies = proxies.table(spark, folder, "documents").select("lang", "source")
    return splits.drawn_split(copies).groupBy("lang", "source", "split").agg(F.count("*").alias("n_rows"))


@query("hash_split", f"with {sql.DOC_SPLITS} select doc_id, split from doc_splits")
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.table(spark, folder, "documents").select("doc_id")
    return splits.hash_split(docs, ["doc_id"])


@query(
    "coalesce_output",
    "select cast(count(*) as bigint) as n_rows, cast(3 as bigint) as n_files from documents",
)
def coalesce_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.table(spark, folder, "documents")
    path = scratch_path(spark, "coalesced")
    splits.coalesce_output(docs, 3).write.parquet(path)
    read = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"))
    return read.agg(F.count("*").alias("n_rows"), F.count_distinct("file").alias("n_files"))


@query(
    "persist_stage",
    f"with {sql.SPLIT_REPORTS} select split, cast(count(*) as bigint) as n_rows from split_reports group by 1",
)
def persist_stage(spark: SparkSession, folder: str) -> DataFrame:
    with splits.persisted(proxies.record_lines(spark, folder).select("split")) as lines:
        lines.count()
        return staged(profile.split_counts(lines), "persisted-counts")


@query("union_splits", f"with {sql.DOC_SPLITS} select split, doc_id, text, lang, source, n_chars from doc_splits")
def union_splits(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "split-folders")
    proxies.document_splits(spark, folder).write.partitionBy("split").parquet(path)
    parts = {s: spark.read.parquet(f"{path}/split={s}") for s in fv.SPLIT_FRACTIONS}
    return records.union_splits(parts)
