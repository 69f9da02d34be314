"""Schema and quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.operators import chat, clean, profile, quality, records
from fieldledger.scratch import scratch_path, staged


@query(
    "schema_presence_report",
    f"with {sql.INCIDENTS_RAW}, filled as (select count(iyear) a, count(country_txt) b, count(attacktype1_txt) c, "
    "count(targtype1_txt) d, count(weaptype1_txt) e, count(nkill) f, count(nwound) g, count(gname) h from incidents_raw) "
    "select t.column, t.target, t.target <> 'summary' as required, t.target <> 'summary' as present, "
    "cast(t.n as bigint) as n_filled from filled, lateral (values ('iyear', 'year', a), ('country_txt', 'country', b), "
    "('attacktype1_txt', 'attack_type', c), ('targtype1_txt', 'target_type', d), ('weaptype1_txt', 'weapon_type', e), "
    "('nkill', 'kills', f), ('nwound', 'wounds', g), ('gname', 'group_name', h), ('summary', 'summary', 0)) t(\"column\", target, n)",
)
def schema_presence_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.schema_presence_report(proxies.incidents_raw(spark, folder))


@query(
    "min_column_count_gate",
    "select cast(2 + length(props) - length(replace(props, ' ', '')) + case when event_type = 'error' then 0 else 6 end as int) "
    "as n_columns, cast(count(*) as bigint) as n_rows, "
    "2 + length(props) - length(replace(props, ' ', '')) + case when event_type = 'error' then 0 else 6 end >= 8 as wide_enough "
    "from events group by 1, 3",
)
def min_column_count_gate(spark: SparkSession, folder: str) -> DataFrame:
    # Log lines of two fields and the words of `props`; six more unless the event is an error.
    events = proxies.table(spark, folder, "events")
    more = F.when(F.col("event_type") == "error", "").otherwise("\t" * 6)
    line = F.concat(F.col("event_id").cast("string"), F.lit("\t"), F.translate("props", " ", "\t"), more)
    path = scratch_path(spark, "log-lines")
    events.select(line.alias("value")).write.text(path)
    return quality.min_column_count_gate(staged(quality.width_distribution(spark.read.text(path)), "widths"))


@query(
    "required_fields_gate",
    f"with {sql.DAMAGED}, objects as (select * from damaged where kind not in (0, 1, 7)) "
    "select field, field in ('instruction', 'output') as required, cast(count(*) as bigint) as n_objects, "
    "cast(count(*) filter (field in ('system', 'input') or (field = 'instruction' and kind = 3) or (field = 'output' and kind = 6)) as bigint) as n_missing, "
    "cast(count(*) filter (field = 'instruction' and kind in (2, 4)) as bigint) as n_not_text "
    "from objects, (values ('system'), ('instruction'), ('input'), ('output')) f(field) group by field",
)
def required_fields_gate(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_field_counts(proxies.damaged_lines(spark, folder))


@query(
    "non_empty_gate",
    f"with {sql.REPORTS} select stage, cast(n as bigint) as n_rows, n > 0 as passes from ("
    "select 'incidents' as stage, (select count(*) from incidents) as n union all "
    "select 'activity', (select count(*) from activity) union all "
    "select 'joined', (select count(*) from enriched) union all "
    "select 'formatted', (select count(*) from reports))",
)
def non_empty_gate(spark: SparkSession, folder: str) -> DataFrame:
    activity = quality.non_empty_gate(staged(proxies.activity(spark, folder), "activity"), "activity")
    judged = staged(clean.judged_incidents(proxies.incidents_raw(spark, folder)), "incidents")
    joined = proxies.enrich_left(clean.kept_incidents(judged), activity)
    lines = staged(records.format_incident_records(joined).select("value"), "lines")
    return quality.stage_gate(
        profile.stage_counts(
            (judged, {"incidents": F.col("cleaned")}),
            (activity, {"activity": None}),
            (joined, {"joined": None}),
            (lines, {"formatted": F.col("value").isNotNull()}),
        )
    )


@query(
    "corrupt_record_report",
    f"with {sql.DAMAGED} select case when kind in (0, 7) then 'not_json' when kind = 1 then 'not_object' "
    "when kind in (2, 4) then 'not_text' when label is null then 'no_label' else 'ok' end as kind, "
    "cast(count(*) as bigint) as n_rows from decoded group by 1",
)
def corrupt_record_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.corrupt_record_report(proxies.damaged_lines(spark, folder))


@query(
    "doubled_terminator_check",
    "select cast(count(*) as bigint) as n_rows, "
    "cast(count(*) filter (n_chars % 3 = 2 and source = 'src7') as bigint) as n_doubled from documents",
)
def doubled_terminator_check(spark: SparkSession, folder: str) -> DataFrame:
    # Some outputs already end in the marker.
    given = proxies.context_records(spark, folder)
    marked = (F.col("input") == "src7")
    output = F.when(marked, F.concat("output", F.lit("<|eot_id|>"))).otherwise(F.col("output"))
    return quality.doubled_terminator_check(chat.chat_render_single(given.withColumn("output", output)))


@query(
    "report_layout_check",
    "select label, cast(count(*) as bigint) as n_rows, cast(count(*) filter (tuned) as bigint) as n_header, "
    "cast(count(*) filter (tuned and turn <= 1) as bigint) as n_context, cast(count(*) filter (tuned) as bigint) as n_assessment, "
    "cast(count(*) filter (tuned and turn <= 1) as bigint) as n_layout, "
    "cast(floor(100 * count(*) filter (tuned and turn <= 1) / count(*)) as bigint) as layout_pct from ("
    "select turn, false as tuned, 'base' as label from conversations where role = 'assistant' and conv_id % 9 <> 2 union all "
    "select turn, false, 'base' from conversations where role = 'assistant' and conv_id % 5 = 1 union all "
    "select turn, true, 'tuned' from conversations where role = 'assistant' and conv_id % 9 <> 4) group by label",
)
def report_layout_check(spark: SparkSession, folder: str) -> DataFrame:
    base, tuned = proxies.responses(spark, folder)
    both = base.withColumn("label", F.lit("base")).unionByName(tuned.withColumn("label", F.lit("tuned")))
    return quality.report_layout_check(both, text="response")


@query(
    "max_length_check",
    f"with {sql.DOC_SPLITS} select split, cast(count(*) as bigint) as n_rows, "
    f"cast(count(*) filter ({sql.words('text')} > 2048) as bigint) as n_over, cast(max({sql.words('text')}) as int) as longest "
    "from doc_splits group by 1",
)
def max_length_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.max_length_check(proxies.document_splits(spark, folder))
