"""Scalar text functions and the record stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.functions import report
from fieldledger.functions.casts import double_or_zero, normalise_code, whole_count
from fieldledger.functions.records import decoded, encode_record_spaced
from fieldledger.functions.text import label_of, title_case, word_count
from fieldledger.operators import records

TEMPLATE = report.ReportTemplate()
c = F.col


@query(
    "normalise_code",
    "select c_custkey, upper(regexp_replace(code, '^\\s+|\\s+$', '', 'g')) as code from ("
    "select c_custkey, case when c_nationkey >= 20 then null else ' ' || lower(c_mktsegment) || chr(9) end as code from customer)",
)
def normalise_code_query(spark: SparkSession, folder: str) -> DataFrame:
    code = F.when(c("c_nationkey") < 20, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("\t")))
    return proxies.table(spark, folder, "customer").select("c_custkey", normalise_code(code).alias("code"))


@query(
    "trunc_int_parse",
    "select l_orderkey, l_linenumber, cast(case when l_returnflag = 'N' then 0 else trunc(l_extendedprice * "
    "case when l_returnflag = 'A' then -1 else 1 end) end as bigint) as n from lineitem",
)
def trunc_int_parse(spark: SparkSession, folder: str) -> DataFrame:
    price = c("l_extendedprice")
    text = F.when(c("l_returnflag") == "N", "NaN").when(c("l_returnflag") == "A", (-price).cast("string"))
    value = whole_count(double_or_zero(text.otherwise(price.cast("string"))))
    return proxies.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", value.alias("n"))


@query("instruction_text", f"with {sql.REPORTS} select attack_type, country, year, instruction from reports")
def instruction_text(spark: SparkSession, folder: str) -> DataFrame:
    text = report.instruction_text(TEMPLATE, c("attack_type"), c("country"), c("year"))
    return proxies.incidents(spark, folder).select("attack_type", "country", "year", text.alias("instruction"))


@query(
    "casualty_clause",
    f"with {sql.INCIDENTS} select cast(kills as bigint) as kills, cast(wounds as bigint) as wounds, "
    "case when kills <= 0 and wounds <= 0 then 'with no casualties' "
    "when kills = 1 then 'with 1 death and ' || cast(wounds as bigint) || ' wounded' "
    "else 'with ' || cast(kills as bigint) || ' deaths and ' || cast(wounds as bigint) || ' wounded' end as clause from incidents",
)
def casualty_clause(spark: SparkSession, folder: str) -> DataFrame:
    counted = proxies.incidents(spark, folder).select(
        whole_count(c("kills")).alias("kills"), whole_count(c("wounds")).alias("wounds")
    )
    return counted.withColumn("clause", report.casualty_clause(TEMPLATE, c("kills"), c("wounds")))


@query(
    "optional_clause",
    f"with {sql.INCIDENTS} select target_type, weapon_type, "
    "case when target_type is null then '' else 'Its target was ' || target_type || '.' end as target_text, "
    "case when weapon_type is null then '' else 'The weapon was ' || weapon_type || '.' end as weapon_text from incidents",
)
def optional_clause(spark: SparkSession, folder: str) -> DataFrame:
    return proxies.incidents(spark, folder).select(
        "target_type",
        "weapon_type",
        report.optional_clause(TEMPLATE.target, target=c("target_type")).alias("target_text"),
        report.optional_clause(TEMPLATE.weapon, weapon=c("weapon_type")).alias("weapon_text"),
    )


@query(
    "attribution_clause",
    f"with {sql.INCIDENTS} select group_name, case when group_name is null or trim(group_name) = 'Unknown' then '' "
    "else 'It was attributed to ' || group_name || '.' end as clause from incidents",
)
def attribution_clause(spark: SparkSession, folder: str) -> DataFrame:
    clause = report.attribution_clause(TEMPLATE, c("group_name"))
    return proxies.incidents(spark, folder).select("group_name", clause.alias("clause"))


@query(
    "context_clause",
    f"with {sql.ENRICHED} select country, year, evt_count, case when evt_count = 0 "
    "then 'The activity log holds no events for ' || country || ' in ' || year || '.' "
    "else 'The activity log holds ' || format('{:,}', evt_count * 1000) || ' events for ' || country || ' in ' || year || '.' end as clause from enriched",
)
def context_clause(spark: SparkSession, folder: str) -> DataFrame:
    # Counts times 1000, so that every count has a separator.
    clause = report.context_clause(TEMPLATE, c("evt_count") * 1000, c("country"), c("year"))
    return proxies.enriched(spark, folder).select("country", "year", "evt_count", clause.alias("clause"))


@query(
    "severity_bucket",
    f"with {sql.INCIDENTS} select kills, case when kills >= 10 then 'high' when kills >= 3 then 'moderate' "
    "else 'low' end as severity from incidents",
)
def severity_bucket(spark: SparkSession, folder: str) -> DataFrame:
    severity = report.severity_bucket(whole_count(c("kills")))
    return proxies.incidents(spark, folder).select("kills", severity.alias("severity"))


@query("report_text", f"with {sql.REPORTS} select output from reports")
def report_text(spark: SparkSession, folder: str) -> DataFrame:
    return records.render_reports(proxies.enriched(spark, folder), TEMPLATE).select("output")


@query(
    "encode_json_record",
    "select doc_id, 'S' as system, source as instruction, '' as input, text as output, true as starts_spaced from documents",
)
def encode_json_record(spark: SparkSession, folder: str) -> DataFrame:
    line = encode_record_spaced(F.lit("S"), c("source"), c("text"))
    parsed = F.from_json("value", "system string, instruction string, input string, output string")
    return (
        proxies.table(spark, folder, "documents")
        .select("doc_id", line.alias("value"))
        .select("doc_id", parsed.alias("r"), c("value").startswith('{"system": "S", "instruction": "').alias("starts_spaced"))
        .select("doc_id", "r.*", "starts_spaced")
    )


@query(
    "format_incident_records",
    f"with {sql.REPORTS} select year, country, attack_type, system, instruction, '' as input, output from reports",
)
def format_incident_records(spark: SparkSession, folder: str) -> DataFrame:
    lines = records.format_incident_records(proxies.enriched(spark, folder), TEMPLATE)
    parsed = F.from_json("value", "system string, instruction string, input string, output string")
    return lines.select("year", "country", "attack_type", parsed.alias("r")).select(
        "year", "country", "attack_type", "r.*"
    )


@query("decode_json_fields", f"with {sql.DAMAGED} select doc_id, kind, instruction, output from decoded")
def decode_json_fields(spark: SparkSession, folder: str) -> DataFrame:
    lines, record = decoded(proxies.damaged_lines(spark, folder))
    return lines.select(
        "doc_id", "kind", record.text("instruction").alias("instruction"), record.text("output").alias("output")
    )


@query(
    "token_length",
    f"with {sql.DAMAGED} select doc_id, cast({sql.words("instruction || ' ' || output")} as int) as token_len from decoded",
)
def token_length(spark: SparkSession, folder: str) -> DataFrame:
    lines, record = decoded(proxies.damaged_lines(spark, folder))
    text = F.concat(record.text("instruction"), F.lit(" "), record.text("output"))
    return lines.select("doc_id", word_count(text).alias("token_len"))


@query("extract_label", f"with {sql.DAMAGED} select doc_id, label from decoded")
def extract_label(spark: SparkSession, folder: str) -> DataFrame:
    lines, record = decoded(proxies.damaged_lines(spark, folder))
    return lines.select("doc_id", label_of(record.text("output")).alias("label"))


@query(
    "title_case",
    f"select p_partkey, {sql.title("upper(p_name) || '/' || p_type || ' (' || p_brand || 'x)'")} as label from part",
)
def title_case_query(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.upper("p_name"), F.lit("/"), c("p_type"), F.lit(" ("), c("p_brand"), F.lit("x)"))
    return proxies.table(spark, folder, "part").select("p_partkey", title_case(text).alias("label"))
