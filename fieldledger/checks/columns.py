"""Projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.functions.casts import double_or_zero, lenient_year, year_prefix
from fieldledger.functions.text import word_count
from fieldledger.scratch import staged
from fieldledger.operators import clean, compare, enrich, records

RENAMED = (
    "iyear as year, country_txt as country, attacktype1_txt as attack_type, targtype1_txt as target_type, "
    "weaptype1_txt as weapon_type, nkill as kills, nwound as wounds, gname as group_name"
)


@query("project_rename", f"with {sql.INCIDENTS_RAW} select {RENAMED} from incidents_raw")
def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return clean.project_rename(proxies.incidents_raw(spark, folder))


@query(
    "cast_year_lenient",
    "select l_orderkey, l_linenumber, case when l_returnflag = 'N' then null when l_returnflag = 'A' "
    "then cast(trunc(l_tax * 100 + l_quantity) as int) else year(l_shipdate)::int end as year from lineitem",
)
def cast_year_lenient(spark: SparkSession, folder: str) -> DataFrame:
    lines = proxies.table(spark, folder, "lineitem")
    text = (
        F.when(F.col("l_returnflag") == "N", "19x0")
        .when(F.col("l_returnflag") == "A", (F.col("l_tax") * 100 + F.col("l_quantity")).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.year("l_shipdate").cast("string"), F.lit(" ")))
    )
    return lines.select("l_orderkey", "l_linenumber", lenient_year(text).alias("year"))


@query(
    "cast_double_default",
    f"with {sql.INCIDENTS_RAW} select nkill, nwound, coalesce(try_cast(nkill as double), 0.0) as kills, "
    "coalesce(try_cast(nwound as double), 0.0) as wounds from incidents_raw",
)
def cast_double_default(spark: SparkSession, folder: str) -> DataFrame:
    raw = proxies.incidents_raw(spark, folder)
    return raw.select(
        "nkill",
        "nwound",
        double_or_zero(F.col("nkill")).alias("kills"),
        double_or_zero(F.col("nwound")).alias("wounds"),
    )


@query(
    "year_from_yyyymmdd",
    f"with {sql.ACTIVITY_RAW} select c0, c1, cast(substr(c1, 1, 4) as int) as g_year from activity_raw",
)
def year_from_yyyymmdd(spark: SparkSession, folder: str) -> DataFrame:
    return proxies.activity_raw(spark, folder).select("c0", "c1", year_prefix(F.col("c1")).alias("g_year"))


@query(
    "fill_missing_count",
    f"with {sql.INCIDENTS}, {sql.ACTIVITY} select year, country, coalesce(evt_count, 0) as evt_count "
    "from incidents left join activity on year = g_year and country = g_country",
)
def fill_missing_count(spark: SparkSession, folder: str) -> DataFrame:
    activity = staged(proxies.activity(spark, folder), "activity")
    joined = enrich.join_activity(proxies.incidents(spark, folder), activity)
    return enrich.fill_missing_count(joined).select("year", "country", "evt_count")


@query(
    "drop_join_keys",
    f"with {sql.INCIDENTS}, {sql.ACTIVITY} select i.*, evt_count "
    "from incidents i left join activity on year = g_year and country = g_country",
)
def drop_join_keys(spark: SparkSession, folder: str) -> DataFrame:
    activity = staged(proxies.activity(spark, folder), "activity")
    return enrich.join_activity(proxies.incidents(spark, folder), activity)


@query("tag_split", "select doc_id, text, 'train' as split from documents")
def tag_split(spark: SparkSession, folder: str) -> DataFrame:
    return records.tag_split(proxies.table(spark, folder, "documents").select("doc_id", "text"), "train")


@query(
    "stringify_args",
    f"with {sql.ENRICHED} select cast(year as varchar) as year, format('{{:.1f}}', kills) as kills, "
    "format('{:.1f}', wounds) as wounds, cast(evt_count as varchar) as evt_count from enriched",
)
def stringify_args(spark: SparkSession, folder: str) -> DataFrame:
    numbers = ["year", "kills", "wounds", "evt_count"]
    return proxies.enriched(spark, folder).select([F.col(name).cast("string") for name in numbers])


@query(
    "drop_null_subset",
    f"with {sql.INCIDENTS_RAW} select {RENAMED} from incidents_raw "
    "where iyear is not null and country_txt is not null and attacktype1_txt is not null",
)
def drop_null_subset(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_null_subset(clean.project_rename(proxies.incidents_raw(spark, folder)))


@query(
    "exclude_sentinel",
    f"with {sql.INCIDENTS_RAW} select {RENAMED} from incidents_raw where attacktype1_txt <> 'Unknown'",
)
def exclude_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    return clean.exclude_sentinel(clean.project_rename(proxies.incidents_raw(spark, folder)))


@query("keep_not_null", f"with {sql.ACTIVITY_RAW} select * from activity_raw where c1 is not null and c7 is not null")
def keep_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return clean.keep_not_null(proxies.activity_raw(spark, folder), "c1", "c7")


@query("code_length_filter", f"with {sql.ACTIVITY_RAW} select * from activity_raw where length(c7) = 3")
def code_length_filter(spark: SparkSession, folder: str) -> DataFrame:
    return clean.code_length_filter(proxies.activity_raw(spark, folder), "c7")


@query(
    "year_allow_list",
    f"with {sql.ACTIVITY_RAW} select c0, cast(substr(c1, 1, 4) as int) as g_year from activity_raw "
    "where substr(c1, 1, 4) in ('1996', '1997', '1998')",
)
def year_allow_list(spark: SparkSession, folder: str) -> DataFrame:
    dated = proxies.activity_raw(spark, folder).select("c0", year_prefix(F.col("c1")).alias("g_year"))
    return clean.year_allow_list(dated, "g_year", proxies.YEARS)


@query(
    "outlier_cap",
    f"select doc_id, cast({sql.words('text')} as int) as token_len from documents where {sql.words('text')} <= 800",
)
def outlier_cap(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.documents(spark, folder)
    return clean.outlier_cap(docs.select("doc_id", word_count(F.col("text")).alias("token_len")))


@query("matched_only", f"with {sql.ENRICHED} select * from enriched where evt_count > 0")
def matched_only(spark: SparkSession, folder: str) -> DataFrame:
    return clean.matched_only(proxies.enriched(spark, folder))


@query(
    "records_having_key",
    "select event_id as step, case when event_id % 10 not in (3, 4) then value end as loss, event_id % 10 not in (3, 4) as is_number "
    "from events where event_type <> 'error' and (value is not null or event_id % 10 in (3, 4))",
)
def records_having_key(spark: SparkSession, folder: str) -> DataFrame:
    return clean.records_having_key(proxies.training_log(spark, folder))


@query("enrich_left_broadcast", f"with {sql.ENRICHED} select * from enriched")
def enrich_left_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    return proxies.enriched(spark, folder)


@query(
    "code_lookup_join",
    f"with {sql.LOG_ROWS}, {sql.LOOKUP} select g_year, g_code, name as g_country "
    "from log_rows join country_lookup on upper(trim(g_code)) = code",
)
def code_lookup_join(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.code_lookup_join(proxies.log_rows(spark, folder), proxies.country_lookup(spark, folder))


@query(
    "paired_response_compare",
    "with answers as (select conv_id, conv_id || '-' || turn as prompt_id, text, turn from conversations where role = 'assistant'), "
    "base_rows as (select prompt_id, text from answers where conv_id % 9 <> 2 union all "
    "select prompt_id, text || ' again' from answers where conv_id % 5 = 1), "
    f"base as (select prompt_id, count(*) as n, min(text) as text, avg({sql.words('text')}) as words from base_rows group by 1), "
    "tuned_rows as (select prompt_id, turn, 'INCIDENT REPORT — ANSWER | assistant | 1' || chr(10) || chr(10) || text "
    "|| case when turn > 1 then '' else chr(10) || chr(10) || 'CONTEXT: none' end || chr(10) || chr(10) || 'ASSESSMENT: none' as text "
    "from answers where conv_id % 9 <> 4), "
    f"tuned as (select prompt_id, count(*) as n, min(text) as text, avg({sql.words('text')}) as words, "
    "count(*) filter (turn <= 1) as layout from tuned_rows group by 1) "
    "select coalesce(b.prompt_id, t.prompt_id) as prompt_id, cast(coalesce(b.n, 0) as bigint) as base_n, "
    "cast(coalesce(t.n, 0) as bigint) as tuned_n, b.text as base_response, t.text as tuned_response, "
    "cast(b.words as double) as base_words, cast(t.words as double) as tuned_words, cast(0 as bigint) as base_layout, "
    "cast(coalesce(t.layout, 0) as bigint) as tuned_layout, cast(t.words - b.words as double) as words_delta, "
    "case when b.n is null then 'tuned' when t.n is null then 'base' else 'both' end as answered_by "
    "from base b full join tuned t on b.prompt_id = t.prompt_id",
)
def paired_response_compare(spark: SparkSession, folder: str) -> DataFrame:
    return compare.paired_response_compare(*proxies.responses(spark, folder))


@query(
    "paired_response_rows",
    "with answers as (select conv_id, conv_id || '-' || turn as prompt_id, text, turn from conversations where role = 'assistant'), "
    "base_rows as (select prompt_id, text from answers where conv_id % 9 <> 2 union all "
    "select prompt_id, text || ' again' from answers where conv_id % 5 = 1), "
    "tuned_rows as (select prompt_id, turn <= 1 as layout, 'INCIDENT REPORT — ANSWER | assistant | 1' || chr(10) || chr(10) || text "
    "|| case when turn > 1 then '' else chr(10) || chr(10) || 'CONTEXT: none' end || chr(10) || chr(10) || 'ASSESSMENT: none' as text "
    "from answers where conv_id % 9 <> 4), "
    f"base as (select prompt_id, text, count(*) as n, any_value(cast({sql.words('text')} as int)) as words, false as layout, "
    "row_number() over (partition by prompt_id order by md5(text), text) as i from base_rows group by prompt_id, text), "
    f"tuned as (select prompt_id, text, count(*) as n, any_value(cast({sql.words('text')} as int)) as words, any_value(layout) as layout, "
    "row_number() over (partition by prompt_id order by md5(text), text) as i from tuned_rows group by prompt_id, text) "
    "select coalesce(b.prompt_id, t.prompt_id) as prompt_id, cast(coalesce(b.i, t.i) as bigint) as ordinal, "
    "b.text as base_response, cast(b.n as bigint) as base_copies, b.words as base_words, b.layout as base_layout, "
    "t.text as tuned_response, cast(t.n as bigint) as tuned_copies, t.words as tuned_words, t.layout as tuned_layout, "
    "t.words - b.words as words_delta, case when b.n is null then 'tuned' when t.n is null then 'base' else 'both' end as answered_by "
    "from base b full join tuned t on b.prompt_id = t.prompt_id and b.i = t.i",
)
def paired_response_rows(spark: SparkSession, folder: str) -> DataFrame:
    return compare.paired_response_rows(*proxies.responses(spark, folder))
