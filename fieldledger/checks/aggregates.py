"""Aggregates, top-k and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.functions.text import word_count
from fieldledger.operators import clean, enrich, profile, records
from fieldledger.operators.joins import join_dimension
from fieldledger.operators.splits import hash_split
from fieldledger.scratch import staged


def profile_counts(
    spark: SparkSession, folder: str, keys: Sequence[str] = profile.PROFILE_KEYS
) -> DataFrame:
    rows = records.profile_rows(proxies.record_lines(spark, folder))
    return staged(profile.profile_counts(rows, keys), "profile-counts")


def document_lengths(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.documents(spark, folder)
    return docs.select("doc_id", word_count(F.col("text")).alias("token_len"))


ALL_SPLITS = (
    "c as (select s.split, count(d.split) as n from (values ('train'), ('val'), ('test'), ('holdout')) s(split) "
    "left join doc_splits d on d.split = s.split group by 1)"
)

DOC_WORDS = f"lengths as (select cast({sql.words('text')} as int) as token_len from documents)"


@query("activity_by_year_country", f"with {sql.ACTIVITY} select * from activity")
def activity_by_year_country(spark: SparkSession, folder: str) -> DataFrame:
    return proxies.activity(spark, folder)


@query(
    "label_balance",
    "select quality as label, cast(count(*) as bigint) as n_rows from labels group by 1",
)
def label_balance(spark: SparkSession, folder: str) -> DataFrame:
    labels = proxies.table(spark, folder, "labels")
    return profile.label_balance(labels.withColumnRenamed("quality", "label"))


@query(
    "label_balance_records",
    f"with {sql.TAGGED} select label, cast(count(*) as bigint) as n_rows from tagged group by 1",
)
def label_balance_records(spark: SparkSession, folder: str) -> DataFrame:
    counts = profile_counts(spark, folder, profile.BALANCE_KEYS)
    return profile.label_balance(counts.filter("parsed"), weight=profile.WEIGHT)


@query(
    "stage_counts",
    f"with {sql.ENRICHED} select stage, cast(n as bigint) as n_rows from ("
    "select 'incidents_raw' as stage, (select count(*) from incidents_raw) as n union all "
    "select 'incidents', (select count(*) from incidents) union all "
    "select 'activity', (select count(*) from activity) union all "
    "select 'matched', (select count(*) from enriched where evt_count > 0))",
)
def stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    activity = staged(proxies.activity(spark, folder), "activity")
    judged = staged(clean.judged_incidents(proxies.incidents_raw(spark, folder)), "incidents")
    cleaned, matched = F.col("cleaned"), F.col("cleaned") & (F.col("evt_count") > 0)
    return profile.stage_counts(
        (enrich.enrich_left(judged, activity), {"incidents_raw": None, "incidents": cleaned, "matched": matched}),
        (activity, {"activity": None}),
    )


@query(
    "match_rate",
    f"with {sql.ENRICHED} select cast(count(*) filter (evt_count > 0) as bigint) as n_matched, "
    "cast(count(*) as bigint) as n_rows, "
    "cast(floor(100 * count(*) filter (evt_count > 0) / greatest(count(*), 1)) as bigint) as match_pct from enriched",
)
def match_rate(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.match_rate(proxies.enriched(spark, folder))


@query(
    "token_length_histogram",
    f"with {DOC_WORDS}, bins as (select case when token_len > 800 then 32 else least(token_len // 25, 31) end as bin, count(*) as n "
    "from lengths group by 1) "
    "select cast(b as int) as bin, cast(b * 25 as int) as from_len, cast(case when b < 32 then b * 25 + 25 end as int) as to_len, "
    "cast(coalesce(n, 0) as bigint) as n_rows from range(33) r(b) left join bins on bin = b",
)
def token_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.token_length_histogram(document_lengths(spark, folder))


@query(
    "token_length_stats",
    f"with {DOC_WORDS} select cast(count(*) filter (token_len <= 800) as bigint) as n_capped, "
    "min(token_len) filter (token_len <= 800) as min_capped, max(token_len) filter (token_len <= 800) as max_capped, "
    "cast(floor(avg(token_len) filter (token_len <= 800)) as bigint) as mean_capped, cast(count(*) as bigint) as n_all, "
    "min(token_len) as min_all, max(token_len) as max_all, cast(floor(avg(token_len)) as bigint) as mean_all from lengths",
)
def token_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return profile.token_length_stats(document_lengths(spark, folder))


@query(
    "dataset_summary",
    f"with {sql.TAGGED}, balance as (select label, count(*) as n from tagged group by 1 order by n desc, label limit 1) "
    "select cast(count(*) as bigint) as n_parsed, cast(count(*) filter (split = 'train') as bigint) as n_train, "
    "cast(count(*) filter (split = 'val') as bigint) as n_val, cast(count(*) filter (split = 'test') as bigint) as n_test, "
    "cast(count(distinct tagged.label) as bigint) as n_labels, any_value(balance.label) as top_label, "
    "cast(any_value(balance.n) as bigint) as top_count from tagged, balance",
)
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.dataset_summary(profile_counts(spark, folder, profile.BALANCE_KEYS))


@query(
    "split_shares",
    f"with {sql.DOC_SPLITS}, {ALL_SPLITS} "
    "select split, cast(n as bigint) as n_rows, format('{:.0f}%', 100 * n / (select sum(n) from c)) as share from c",
)
def split_shares(spark: SparkSession, folder: str) -> DataFrame:
    return profile.split_shares(proxies.document_splits(spark, folder), splits=tuple(proxies.FRACTIONS))


@query(
    "estimated_split_sizes",
    f"with {sql.DOC_SPLITS}, {ALL_SPLITS} "
    "select split, cast(n as bigint) as n_rows, cast(floor((select sum(n) from c) * "
    "cast(case split when 'train' then 0.8 when 'holdout' then 0 else 0.1 end as double)) as bigint) as estimated from c",
)
def estimated_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return profile.estimated_split_sizes(proxies.document_splits(spark, folder), proxies.FRACTIONS)


@query(
    "training_schedule",
    f"with {sql.DOC_SPLITS}, {ALL_SPLITS} "
    "select split, cast(n as bigint) as n_rows, n / 8.0::double as steps_per_epoch, "
    "case when n > 0 then round(500.0::double / (n / 8.0::double), 2) end as effective_epochs from c",
)
def training_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return profile.training_schedule(proxies.document_splits(spark, folder), splits=tuple(proxies.FRACTIONS))


@query(
    "top_k_labels",
    "select p_brand as label, cast(count(*) as bigint) as n_rows from lineitem join part on l_partkey = p_partkey "
    "group by 1 order by 2 desc, 1 limit 12",
)
def top_k_labels(spark: SparkSession, folder: str) -> DataFrame:
    lines, parts = proxies.table(spark, folder, "lineitem"), proxies.table(spark, folder, "part")
    keyed = lines.select(F.col("l_partkey").alias("part"))
    named = parts.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("label"))
    # Counted by part before the join, so that no part has more than one row to join.
    per_part = profile.label_balance(keyed, "part")
    brands = join_dimension(per_part, named, ["part"], "inner", salts=1)
    return profile.top_k_labels(profile.label_balance(brands, weight=profile.WEIGHT))


@query(
    "head_preview",
    "select doc_id, source, substr(text, 1, 120) as text from documents order by source, doc_id limit 5",
)
def head_preview(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.table(spark, folder, "documents").select("doc_id", "source", "text")
    return profile.head_preview(docs, ["source", "doc_id"], "text", 5, 120)


@query(
    "thousands_format",
    f"with c as (select {sql.split_of('cast(l_orderkey as varchar)')} as split, count(*) as n from lineitem group by 1) "
    "select split, cast(n as bigint) as n_rows, format('{:,}', n) as n_rows_text, "
    "format('{:.0f}%', 100 * n / (select sum(n) from c)) as share from c",
)
def thousands_format(spark: SparkSession, folder: str) -> DataFrame:
    lines = proxies.table(spark, folder, "lineitem").select("l_orderkey")
    return profile.split_display(hash_split(lines, ["l_orderkey"]))
