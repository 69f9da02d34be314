"""Prompts with the history of their conversation, by prefix sums and a range join.

Messages are put in order of conversation and turn by range, so a conversation with a large
share of all messages lies in many partitions. Sums within the partitions and the partitions'
totals give each message how many messages and characters stand before it. A bounded
history is then a range of these sums. Blocks as wide as the bound cut it into two at most,
which are joined by conversation and block, so no task holds a conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.functions.chat import CONVERSATION_CHAT, ChatTemplate
from fieldledger.operators.chat import chat_render_messages
from fieldledger.operators.joins import join_dimension
from fieldledger.scratch import staged

#: Messages of a block where the history has no bound.
BLOCK = 256


def numbered_places(messages: DataFrame, template: ChatTemplate = CONVERSATION_CHAT) -> DataFrame:
    """(conv_id, turn, piece, n_before, c_before), staged: one row per place of a conversation.

    `n_before` and `c_before` are the messages and characters before it in the order of all
    conversations, so their differences within a conversation are those of its history. Of
    several texts in one place the smallest one that was given counts, as in `sft_pairs`;
    messages without a turn have no place.
    """
    pieces = chat_render_messages(messages, template).where("turn is not null")
    best = F.min(F.struct("filled", "piece"))["piece"].alias("piece")
    ordered = pieces.groupBy("conv_id", "turn").agg(best).repartitionByRange("conv_id", "turn")
    places = staged(ordered.withColumn("part", F.spark_partition_id()), "places")
    size = F.length("piece").cast("bigint")
    totals = places.groupBy("part").agg(F.count("*").alias("n"), F.sum(size).alias("c"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = totals.select("part", *(F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_base") for x in "nc"))
    within = Window.partitionBy("part").orderBy("conv_id", "turn").rowsBetween(Window.unboundedPreceding, -1)
    sums = places.withColumns(
        {
            "n_in": F.coalesce(F.count("*").over(within), F.lit(0)),
            "c_in": F.coalesce(F.sum(size).over(within), F.lit(0)),
        }
    )
    placed = sums.join(F.broadcast(bases), "part")
    return staged(
        placed.select(
            "conv_id",
            "turn",
            "piece",
            (F.col("n_base") + F.col("n_in")).alias("n_before"),
            (F.col("c_base") + F.col("c_in")).alias("c_before"),
        ),
        "numbered-places",
    )


def sft_prompts(
    pairs: DataFrame,
    messages: DataFrame,
    template: ChatTemplate = CONVERSATION_CHAT,
    max_turns: int = 0,
    max_chars: int = 0,
) -> DataFrame:
    """The pairs of `sft_pairs` with their history and prompt as `messages_text`.

    The history are the messages before the pair's, of all roles: the last `max_turns` of
    them, and of these the last ones that have `max_chars` characters or fewer together,
    markers counted; 0 stands for all. A message is there whole or not at all, and the
    prompt always is. `n_history` counts them.

    With a bound the result grows with the pairs. Without one every pair repeats all that
    was before it, and the result grows with the square of a long conversation; blocks of
    messages that lie before a pair's own are joined as one text each.
    """
    places = numbered_places(messages, template)
    asked = pairs.select("conv_id", "turn", "prompt", "response").join(
        places.select("conv_id", "turn", F.col("n_before").alias("n_own"), F.col("c_before").alias("c_own")),
        ["conv_id", "turn"],
    )
    if max_turns > 0 or max_chars > 0:
        found = _bounded(asked, places, max_turns, max_chars)
    else:
        found = _whole(asked, places)
    history = found.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"), F.sum("n").alias("n_history")
    )
    told = asked.select("conv_id", "turn", "prompt", "response").join(history, ["conv_id", "turn"], "left")
    body = F.coalesce(F.array_join(F.col("parts.text"), ""), F.lit(""))
    prompt = template.message(F.lit("user"), F.col("prompt"))
    text = F.concat(F.lit(template.begin), body, prompt, template.opening(F.lit("assistant")))
    return told.select(
        "conv_id",
        "turn",
        text.alias("messages_text"),
        "response",
        F.coalesce("n_history", F.lit(0)).cast("bigint").alias("n_history"),
    )


def _bounded(asked: DataFrame, places: DataFrame, max_turns: int, max_chars: int) -> DataFrame:
    """Messages of each pair's history, (conv_id, turn, place, text, n)."""
    unit, width = ("n", max_turns) if max_turns > 0 else ("c", max_chars)
    own = F.floor(F.col(f"{unit}_own") / width)
    wanted = asked.select("conv_id", "turn", "n_own", "c_own", F.explode(F.array(own - 1, own)).alias("block"))
    given = places.select(
        "conv_id",
        F.floor(F.col(f"{unit}_before") / width).alias("block"),
        "n_before",
        "c_before",
        F.col("piece").alias("text"),
    )
    before = given.join(wanted, ["conv_id", "block"]).where("n_before < n_own")
    for name, bound in (("n", max_turns), ("c", max_chars)):
        if bound > 0:
            before = before.where(F.col(f"{name}_own") - F.col(f"{name}_before") <= bound)
    return before.select("conv_id", "turn", F.col("n_before").alias("place"), "text", F.lit(1).alias("n"))


def _whole(asked: DataFrame, places: DataFrame) -> DataFrame:
    """All messages before each pair; of earlier blocks, all messages as one text."""
    block = F.floor(F.col("n_before") / BLOCK).alias("block")
    blocks = places.groupBy("conv_id", block).agg(
        F.array_sort(F.collect_list(F.struct("n_before", "piece"))).alias("pieces")
    )
    texts = staged(
        blocks.select(
            "conv_id",
            "block",
            F.col("pieces")[0]["n_before"].alias("place"),
            F.array_join(F.col("pieces.piece"), "").alias("text"),
            F.size("pieces").alias("n"),
        ),
        "blocks",
    )
    own = F.floor(F.col("n_own") / BLOCK)
    first = texts.groupBy("conv_id").agg(F.min("block").alias("first"))
    wanted = join_dimension(asked.select("conv_id", "turn", "n_own"), staged(first, "firsts"), ["conv_id"], "inner")
    earlier = wanted.where(F.col("first") < own).select(
        "conv_id", "turn", F.explode(F.sequence("first", own - 1)).alias("block")
    )
    earlier = earlier.join(texts, ["conv_id", "block"]).select("conv_id", "turn", "place", "text", "n")
    given = places.select("conv_id", block, "n_before", F.col("piece").alias("text"))
    inner = asked.select("conv_id", "turn", "n_own", own.alias("block")).join(given, ["conv_id", "block"])
    inner = inner.where("n_before < n_own")
    return earlier.unionByName(
        inner.select("conv_id", "turn", F.col("n_before").alias("place"), "text", F.lit(1).alias("n"))
    )
