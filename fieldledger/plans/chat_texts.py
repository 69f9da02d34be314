"""Jobs: records and conversations to chat texts, and a comparison of responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.functions.chat import CONVERSATION_CHAT, RECORD_CHAT, ChatTemplate
from fieldledger.functions.report import ReportTemplate
from fieldledger.operators import chat, compare, history, profile, quality, records
from fieldledger.scratch import scratch_run, staged
from fieldledger.sources import writers
from fieldledger.sources.published import split_lines


def prepare_chat_texts(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    split: str = "train",
    template: ChatTemplate = RECORD_CHAT,
    default_system: str = ReportTemplate().system,
) -> dict[str, DataFrame]:
    """Write the chat texts of a split below `input_path` as JSON lines `{text}` and report on them.

    One pass publishes two outputs below `output_path`: `texts`, and `rejected` with the
    lines that are no records, what is wrong with each and where it stood
    (`records.sifted_lines`), so that they can be repaired. The written texts are read
    once, into counts.
    """
    lines = split_lines(spark, input_path, split)
    if lines is None:
        raise FileNotFoundError(f"no split {split} below {input_path}")
    sifted = records.sifted_lines(lines)
    texts = chat.chat_render_single(quality.required_fields_gate(sifted), template, default_system)
    value = F.when(F.col("split") == records.RECORDS, F.to_json(F.struct("text"))).otherwise(F.col("rejected"))
    name = F.when(F.col("split") == records.RECORDS, "texts").otherwise(F.col("split"))
    made = texts.select(value.alias("value"), name.alias("split"))
    version = writers.sink_jsonl_splits(made, output_path, ["texts", records.REJECTED])
    found = {name: split_lines(spark, output_path, name, version) for name in version.splits}
    written = found["texts"].select(F.from_json("value", "text string")["text"].alias("text"), F.lit(split).alias("split"))
    kinds = records.rejected_lines(found[records.REJECTED]).groupBy("kind").agg(F.count("*").alias("n_rows"))
    lengths = staged(quality.max_length_check(written), "lengths")
    return {
        "records": found["texts"].agg(F.count("*").alias("n_rows")),
        "rejected": kinds,
        "terminators": quality.doubled_terminator_check(written, template.end_of_turn),
        "lengths": lengths,
        "schedule": profile.training_schedule(lengths, weight="n_rows", splits=[split]),
    }


def prepare_conversations(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    template: ChatTemplate = CONVERSATION_CHAT,
    generation_prompt: bool = False,
    history_turns: int = 0,
    history_chars: int = 0,
) -> dict[str, DataFrame]:
    """Write chat texts, messages, pairs and prompts of the conversations in JSON lines.

    The lines hold `conv_id`, `turn`, `role` and `text`. Below the output lie `texts`,
    `messages`, `pairs` and `prompts` (pairs with their history), as JSON lines. A
    history has at most the last `history_turns` messages and `history_chars` characters;
    0 stands for all, which grows with the square of a long conversation.
    """
    schema = "conv_id bigint, turn bigint, role string, text string"
    messages = spark.read.schema(schema).json(input_path)
    made = {
        "texts": chat.chat_render_multi_turn(messages, template, generation_prompt),
        "messages": chat.chat_render_messages(messages, template),
        "pairs": chat.sft_pairs(messages),
    }
    for name, table in made.items():
        table.write.mode("overwrite").json(f"{output_path}/{name}")
    pair = "conv_id bigint, turn bigint, prompt string, response string"
    with scratch_run(spark):
        prompts = history.sft_prompts(
            spark.read.schema(pair).json(f"{output_path}/pairs"), messages, template, history_turns, history_chars
        )
        prompts.write.mode("overwrite").json(f"{output_path}/prompts")
    told = spark.read.schema("n_history bigint").json(f"{output_path}/prompts")
    pieces = spark.read.schema("filled boolean").json(f"{output_path}/messages")
    pairs = spark.read.schema("n_prompts int, n_responses int").json(f"{output_path}/pairs")
    return {
        "messages": pieces.agg(F.count("*").alias("n_rows"), F.count_if("filled").alias("n_filled")),
        "pairs": pairs.agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("n_prompts") + F.col("n_responses") > 2).alias("n_with_several"),
        ),
        "prompts": told.agg(F.count("*").alias("n_rows"), F.max("n_history").alias("longest_history")),
    }


def compare_responses(
    spark: SparkSession, base_path: str, tuned_path: str, output_path: str, report: ReportTemplate = ReportTemplate()
) -> dict[str, DataFrame]:
    """Compare two sets of responses in JSON lines `(prompt_id, response)`.

    Writes `<output>/prompts`, one row per prompt, and `<output>/responses`, where all
    different responses of both sides stand beside each other.
    """
    schema = "prompt_id string, response string"
    base, tuned = (spark.read.schema(schema).json(path) for path in (base_path, tuned_path))
    compare.paired_response_compare(base, tuned, report).write.mode("overwrite").json(f"{output_path}/prompts")
    compare.paired_response_rows(base, tuned, report).write.mode("overwrite").json(f"{output_path}/responses")
    both = base.withColumn("label", F.lit("base")).unionByName(tuned.withColumn("label", F.lit("tuned")))
    rows = spark.read.schema("answered_by string, words_delta double").json(f"{output_path}/prompts")
    pairs = spark.read.schema("answered_by string, words_delta bigint").json(f"{output_path}/responses")
    return {
        "layout": quality.report_layout_check(both, report, text="response"),
        "prompts": rows.groupBy("answered_by").agg(
            F.count("*").alias("n_prompts"), F.avg("words_delta").alias("mean_words_delta")
        ),
        "responses": pairs.groupBy("answered_by").agg(
            F.count("*").alias("n_rows"), F.avg("words_delta").alias("mean_words_delta")
        ),
    }


def sift_records(spark: SparkSession, input_path: str, output_path: str) -> dict[str, DataFrame]:
    """Publish the records of any JSON lines below `output_path` as `records`, and as `rejected`
    the lines that are none, in one pass; returns how many there are of each."""
    lines = spark.read.option("lineSep", "\n").text(input_path)
    sifted = records.sifted_lines(lines)
    value = F.coalesce("rejected", "value").alias("value")
    names = [records.RECORDS, records.REJECTED]
    version = writers.sink_jsonl_splits(sifted.select(value, "split"), output_path, names)
    found = {name: split_lines(spark, output_path, name, version) for name in names}
    return {
        "records": found[records.RECORDS].agg(F.count("*").alias("n_rows")),
        "rejected": records.rejected_lines(found[records.REJECTED]).groupBy("kind").agg(F.count("*").alias("n_rows")),
    }
