"""Chat texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.checks import proxies, sql
from fieldledger.checks.registry import query
from fieldledger.functions.chat import with_context
from fieldledger.operators import chat, history

CONTEXT_RECORDS = """
context_records as (
  select doc_id, case when lang <> 'en' then 'Answer in ' || lang end as system, 'Quote ' || source as instruction,
    case when n_chars % 3 = 0 then '' when n_chars % 3 = 1 then '  ' else source end as input, text as output
  from documents),
with_context as (
  select *, case when trim(input) <> '' then instruction || chr(10) || chr(10) || 'Context: ' || input else instruction end as asked
  from context_records)
"""

PIECE = (
    "'<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) "
    "|| regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '<|eot_id|>'"
)


@query(
    "chat_render_single",
    f"with {CONTEXT_RECORDS} select doc_id, '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) "
    "|| coalesce(system, 'You are an analyst who combines incident records with event activity.') "
    "|| '<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || asked "
    "|| '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || output || '<|eot_id|>' as text from with_context",
)
def chat_render_single(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_render_single(proxies.context_records(spark, folder)).select("doc_id", "text")


@query("context_injection", f"with {CONTEXT_RECORDS} select doc_id, input, asked as instruction from with_context")
def context_injection(spark: SparkSession, folder: str) -> DataFrame:
    asked = with_context(F.col("instruction"), F.col("input"))
    return proxies.context_records(spark, folder).select("doc_id", "input", asked.alias("instruction"))


@query(
    "build_message_list",
    f"with {CONTEXT_RECORDS} select doc_id, cast(p - case when system is null then 1 else 0 end as int) as place, role, content "
    "from (select doc_id, system, unnest([0, 1, 2]) as p, unnest(['system', 'user', 'assistant']) as role, "
    "unnest([system, instruction, output]) as content from context_records) where content is not null",
)
def build_message_list(spark: SparkSession, folder: str) -> DataFrame:
    listed = chat.build_message_list(
        proxies.context_records(spark, folder), "system", "instruction", "output"
    )
    return listed.select("doc_id", F.posexplode("messages").alias("place", "message")).select(
        "doc_id", "place", "message.role", "message.content"
    )


MESSAGES = """
messages as (
  select distinct conv_id, turn, case when (conv_id + turn) % 17 <> 4 then role end as given_role,
    case when (conv_id + turn) % 13 <> 5 then text end as given_text,
    coalesce(given_role, 'unknown') as role, coalesce(given_text, '') as text,
    given_role is null or given_text is null as filled
  from conversations)
"""
ANSWER = "'<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"
WHOLE = (
    f"with {MESSAGES} select conv_id, cast(count(*) as int) as n_turns, cast(count(*) filter (filled) as int) as n_filled, "
    f"'<|begin_of_text|>' || string_agg({PIECE}, '' order by turn) {{ending}} as text from messages group by conv_id"
)


@query("chat_render_multi_turn", WHOLE.format(ending=""))
def chat_render_multi_turn(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_render_multi_turn(proxies.broken_messages(spark, folder))


@query("chat_render_multi_turn_prompted", WHOLE.format(ending=f"|| {ANSWER}"))
def chat_render_multi_turn_prompted(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_render_multi_turn(proxies.broken_messages(spark, folder), generation_prompt=True)


@query("chat_render_messages", f"with {MESSAGES} select conv_id, turn, {PIECE} as piece, filled from messages")
def chat_render_messages(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_render_messages(proxies.broken_messages(spark, folder).distinct())


PAIRS = f"""
{MESSAGES},
pairs as (
  select u.conv_id, u.turn, min(u.given_text) as prompt, min(a.given_text) as response,
    cast(count(distinct u.given_text) as int) as n_prompts, cast(count(distinct a.given_text) as int) as n_responses
  from messages u join messages a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  where u.given_role = 'user' and a.given_role = 'assistant' and u.given_text is not null and a.given_text is not null
  group by u.conv_id, u.turn)
"""


@query("sft_pairs", f"with {PAIRS} select * from pairs")
def sft_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return chat.sft_pairs(proxies.broken_messages(spark, folder))


def prompts_sql(kept: str = "true") -> str:
    """Each pair with the messages before it for which `kept` holds: `back` of them from
    the prompt, with `chars` characters from there on."""
    return (
        f"with {PAIRS}, pieces as (select conv_id, turn, {PIECE} as piece from messages), "
        "before as (select p.conv_id, p.turn as upto, m.turn, m.piece, "
        "row_number() over w as back, sum(length(m.piece)) over w as chars "
        "from pairs p join pieces m on m.conv_id = p.conv_id and m.turn < p.turn "
        "window w as (partition by p.conv_id, p.turn order by m.turn desc rows unbounded preceding)), "
        "history as (select conv_id, upto, string_agg(piece, '' order by turn) as text, count(*) as n "
        f"from before where {kept} group by 1, 2) "
        "select p.conv_id, p.turn, '<|begin_of_text|>' || coalesce(h.text, '') || o.piece "
        f"|| {ANSWER} as messages_text, p.response, cast(coalesce(h.n, 0) as bigint) as n_history "
        "from pairs p join pieces o on o.conv_id = p.conv_id and o.turn = p.turn "
        "left join history h on h.conv_id = p.conv_id and h.upto = p.turn"
    )


def prompts(spark: SparkSession, folder: str, **bounds: int) -> DataFrame:
    messages = proxies.broken_messages(spark, folder)
    return history.sft_prompts(chat.sft_pairs(messages), messages, **bounds)


@query("sft_prompts", prompts_sql())
def sft_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder)


@query("sft_prompts_turns", prompts_sql("back <= 2"))
def sft_prompts_turns(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder, max_turns=2)


@query("sft_prompts_chars", prompts_sql("chars <= 1500 and back <= 4"))
def sft_prompts_chars(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder, max_turns=4, max_chars=1500)
