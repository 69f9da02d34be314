"""Chat texts from records and from conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions.chat import (
    CONVERSATION_CHAT,
    RECORD_CHAT,
    ChatTemplate,
    chat_record,
    message_list,
    with_context,
)
from fieldledger.functions.report import ReportTemplate

NO_ROLE = "unknown"


def chat_render_single(
    records: DataFrame,
    template: ChatTemplate = RECORD_CHAT,
    default_system: str = ReportTemplate().system,
) -> DataFrame:
    """Records with their chat text in `text`. Only instruction and output must be there."""
    present = set(records.columns)
    system = F.col("system") if "system" in present else F.lit(None).cast("string")
    instruction = F.col("instruction")
    if "input" in present:
        instruction = with_context(instruction, F.coalesce("input", F.lit("")))
    return records.withColumn("text", chat_record(template, system, instruction, F.col("output"), default_system))


def build_message_list(df: DataFrame, system: str | None, user: str, assistant: str | None = None) -> DataFrame:
    """Rows with `messages`, an array of `{role, content}`."""
    column = lambda name: F.col(name) if name else None
    return df.withColumn("messages", message_list(column(system), column(user), column(assistant)))


def _filled(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """Role and text with something in place of NULL, and whether something was."""
    missing = role.isNull() | text.isNull()
    return F.coalesce(role, F.lit(NO_ROLE)), F.coalesce(text, F.lit("")), missing


def chat_render_messages(messages: DataFrame, template: ChatTemplate = CONVERSATION_CHAT) -> DataFrame:
    """Every message `(conv_id, turn, role, text)` with its chat text in `piece`; no shuffle.

    Pieces in order of `turn`, after the opening marker, are the conversation's text. A
    message without text, or without a role, is kept with an empty text or the role
    `unknown`, and marked in `filled`.
    """
    role, text, filled = _filled(F.col("role"), F.col("text"))
    return messages.select("conv_id", "turn", template.message(role, text).alias("piece"), filled.alias("filled"))


def chat_render_multi_turn(
    messages: DataFrame, template: ChatTemplate = CONVERSATION_CHAT, generation_prompt: bool = False
) -> DataFrame:
    """One chat text per conversation, from `(conv_id, turn, role, text)`.

    `turn` is the message's place in its conversation; copies of a message in its place
    are one message. `n_filled` counts messages that had no text or no role. A text
    holds its whole conversation; `chat_render_messages` has the same pieces for
    conversations that are too long for one row.
    """
    pieces = chat_render_messages(messages, template)
    gathered = pieces.groupBy("conv_id").agg(F.collect_set(F.struct("turn", "piece", "filled")).alias("pieces"))
    body = F.array_join(F.transform(F.array_sort("pieces"), lambda m: m.piece), "")
    ending = [template.opening(F.lit("assistant"))] if generation_prompt else []
    return gathered.select(
        "conv_id",
        F.size("pieces").alias("n_turns"),
        F.size(F.filter("pieces", lambda m: m.filled)).alias("n_filled"),
        F.concat(F.lit(template.begin), body, *ending).alias("text"),
    )


def sft_pairs(messages: DataFrame) -> DataFrame:
    """User messages with the assistant message that follows at once.

    Both fall into one group by conversation and the user's turn, so a long conversation
    is spread like any other rows. Equal texts of a place are folded first, and a group
    keeps the smallest text and a number of each side: copies of a message in its place
    never multiply, and a place with very many texts is not gathered. Of several texts
    in one place the smallest is taken; `n_prompts` and `n_responses` count them. What
    came before a pair is named by (conv_id, turn) and rendered by `history.sft_prompts`.
    """
    turn = F.when(F.col("role") == "assistant", F.col("turn") - 1).otherwise(F.col("turn"))
    texts = (
        messages.where(F.col("role").isin("user", "assistant") & F.col("text").isNotNull())
        .groupBy("conv_id", turn.alias("turn"), "role", "text")
        .agg(F.count("*").alias("n_copies"))
    )
    sides = {"prompt": F.col("role") == "user", "response": F.col("role") == "assistant"}
    kept = [F.min(F.when(side, F.col("text"))).alias(name) for name, side in sides.items()]
    counted = [F.count_if(side).cast("int").alias(f"n_{name}s") for name, side in sides.items()]
    pairs = texts.groupBy("conv_id", "turn").agg(*kept, *counted)
    return pairs.where("n_prompts > 0 and n_responses > 0")
