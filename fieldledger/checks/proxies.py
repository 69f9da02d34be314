"""The test tables in the shape of the real inputs.

`incidents_raw`, `activity_raw` and `country_lookup` follow FIXTURES.md. Each
has the sentinels, missing values and broken values that the operators are about.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.chat import message_list
from fieldledger.operators.clean import activity_rows, clean_incidents
from fieldledger.operators.enrich import activity_by_year_country, enrich_left
from fieldledger.operators.joins import is_small
from fieldledger.operators.records import format_incident_records
from fieldledger.operators.splits import hash_split
from fieldledger.scratch import staged
from fieldledger.sources.readers import spread

YEARS = (1996, 1997, 1998)
RAW_COLUMNS = [name for name in fv.INCIDENT_COLUMNS if name != "summary"]
LOG_WIDTH = 8
TASKS = 8
#: Rows of a table of parts or suppliers that is broadcast; with a larger one the lines are shuffled.
SENT_ROWS = 500_000
#: The splits, and one that no row falls into.
FRACTIONS = {**fv.SPLIT_FRACTIONS, "holdout": 0.0}
LINE_KEY = ["instruction", "output"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def incidents_raw(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    if is_small(parts, SENT_ROWS):
        parts = F.broadcast(parts)
        # The small test table is one file with one row group; the rows come from the file's footers.
        lines = spread(lines, TASKS, lines.count())
    else:
        # The join deals the rows out by part, so they are not dealt out before it as well.
        parts = parts.hint("merge")
    if is_small(suppliers, SENT_ROWS):
        suppliers = F.broadcast(suppliers)
    c = F.col
    quantity = c("l_quantity")
    placed = lines.join(suppliers, c("l_suppkey") == c("s_suppkey")).select(
        "l_partkey",
        "s_nationkey",
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        F.year("l_shipdate").alias("year"),
        (F.round(c("l_discount") * 100).cast("int") % 4).alias("wounds"),
    )
    joined = placed.join(parts, c("l_partkey") == c("p_partkey")).join(
        F.broadcast(nations), c("s_nationkey") == c("n_nationkey")
    )
    return joined.select(
        c("year").cast("string").alias("iyear"),
        c("n_name").alias("country_txt"),
        F.when(c("p_type") == "PROMO", "Unknown")
        .when(c("p_type") != "SMALL", c("p_type"))
        .alias("attacktype1_txt"),
        F.nullif(c("l_returnflag"), F.lit("N")).alias("targtype1_txt"),
        F.nullif(c("l_linestatus"), F.lit("F")).alias("weaptype1_txt"),
        F.when(quantity > 48, None)
        .when(quantity > 46, "n/a")
        .otherwise((quantity.cast("int") % 13).cast("string"))
        .alias("nkill"),
        c("wounds").cast("string").alias("nwound"),
        F.when(c("p_size") % 5 == 0, " Unknown ")
        .when(c("p_size") % 7 == 0, None)
        .otherwise(c("p_brand"))
        .alias("gname"),
    )


def activity_raw(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    nation = F.col("c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("c0"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("c1"),
        F.when(nation >= 20, None)
        .when(nation >= 18, "X")
        .otherwise(F.concat(F.lit("N"), F.lpad(nation.cast("string"), 2, "0")))
        .alias("c7"),
    )


def activity_log(spark: SparkSession, folder: str) -> DataFrame:
    """`activity_raw` at the log's positions `_c0` to `_c7`."""
    raw = activity_raw(spark, folder)
    named = {0: "c0", 1: "c1", 7: "c7"}
    return raw.select(
        *[
            (F.col(named[i]) if i in named else F.lit(None).cast("string")).alias(f"_c{i}")
            for i in range(LOG_WIDTH)
        ]
    )


def country_lookup(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        table(spark, folder, "nation")
        .filter(key < 15)
        .select(
            F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("code"),
            F.col("n_name").alias("name"),
        )
    )


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    return clean_incidents(incidents_raw(spark, folder))


def log_rows(spark: SparkSession, folder: str) -> DataFrame:
    return activity_rows(activity_log(spark, folder), YEARS)


def activity(spark: SparkSession, folder: str) -> DataFrame:
    return activity_by_year_country(log_rows(spark, folder), country_lookup(spark, folder))


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_left(incidents(spark, folder), staged(activity(spark, folder), "activity"))


def record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines `(value, split)` of all incidents, with the columns they came from."""
    return format_incident_records(enriched(spark, folder)).transform(hash_split, LINE_KEY)


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON line per document; the length of its text decides how it is damaged.

    `value` is the line, `kind` a number from 0 to 10: 0 is no JSON, 1 an array,
    2 has a number for the instruction, 3 no instruction, 4 a null instruction,
    5 no label mark, 6 no output, 7 more text after the object, the rest are sound.
    """
    docs = documents(spark, folder)
    c = F.col
    instruction = F.concat(F.lit("Describe a text from "), c("source"))
    header = F.concat(F.lit("TEXT — "), F.upper("source"), F.lit("/"), F.upper("lang"), F.lit(" | x\n"))
    output = F.concat(header, c("text"))
    sound = F.to_json(F.struct(instruction.alias("instruction"), output.alias("output")))
    only_output = F.to_json(F.struct(output.alias("output")))
    kind = c("n_chars") % 11
    value = (
        F.when(kind == 0, F.concat(F.lit("x"), c("text")))
        .when(kind == 1, F.concat(F.lit("["), sound, F.lit("]")))
        .when(kind == 2, F.to_json(F.struct(c("n_chars").alias("instruction"), output.alias("output"))))
        .when(kind == 3, only_output)
        .when(kind == 4, F.concat(F.lit('{"instruction": null, '), F.substring(only_output, F.lit(2), F.length(only_output))))
        .when(kind == 5, F.to_json(F.struct(instruction.alias("instruction"), c("text").alias("output"))))
        .when(kind == 6, F.to_json(F.struct(instruction.alias("instruction"))))
        .when(kind == 7, F.concat(sound, F.lit(" {}")))
        .otherwise(sound)
    )
    return docs.select("doc_id", kind.cast("int").alias("kind"), value.alias("value"))


def training_log(spark: SparkSession, folder: str) -> DataFrame:
    """JSON log lines: `step`, and `loss` unless the event is an error; some are null or no number."""
    events = table(spark, folder, "events")
    number = F.to_json(F.struct(F.col("event_id").alias("step"), F.col("value").alias("loss")))
    step = F.to_json(F.struct(F.col("event_id").alias("step")))
    head = F.substring(step, F.lit(1), F.length(step) - F.lit(1))
    line = (
        F.when(F.col("event_type") == "error", step)
        .when(F.col("event_id") % 10 == 3, F.concat(head, F.lit(', "loss": null}')))
        .when(F.col("event_id") % 10 == 4, F.concat(head, F.lit(', "loss": "n/a"}')))
        .otherwise(number)
    )
    return events.select(line.alias("value"))


def document_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with their split, from one scan."""
    return hash_split(documents(spark, folder), ["doc_id"], FRACTIONS)


def context_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with an input that is blank for some, and a system text that is missing for some."""
    docs = documents(spark, folder)
    return docs.select(
        "doc_id",
        F.when(F.col("lang") != "en", F.concat(F.lit("Answer in "), F.col("lang"))).alias("system"),
        F.concat(F.lit("Quote "), F.col("source")).alias("instruction"),
        F.when(F.col("n_chars") % 3 == 0, "").when(F.col("n_chars") % 3 == 1, "  ").otherwise(F.col("source")).alias("input"),
        F.col("text").alias("output"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def broken_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The messages, some without text and some without role."""
    place = F.col("conv_id") + F.col("turn")
    return messages(spark, folder).select(
        "conv_id",
        "turn",
        F.when(place % 17 != 4, F.col("role")).alias("role"),
        F.when(place % 13 != 5, F.col("text")).alias("text"),
    )


def message_arrays(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "messages", message_list(F.col("system"), F.col("instruction"), F.col("output"))
    )


def responses(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Assistant messages as base answers, and the same in the report layout as tuned answers.

    Some prompts have two base answers, some are answered by one side only.
    """
    answers = messages(spark, folder).filter(F.col("role") == "assistant")
    prompt = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("prompt_id")
    conv = F.col("conv_id")
    again = answers.filter(conv % 5 == 1).select(prompt, F.concat("text", F.lit(" again")).alias("response"))
    base = answers.filter(conv % 9 != 2).select(prompt, F.col("text").alias("response")).unionByName(again)
    report = F.concat(
        F.lit("INCIDENT REPORT — ANSWER | "),
        F.col("role"),
        F.lit(" | 1\n\n"),
        F.col("text"),
        F.when(F.col("turn") > 1, "").otherwise("\n\nCONTEXT: none"),
        F.lit("\n\nASSESSMENT: none"),
    )
    return base, answers.filter(conv % 9 != 4).select(prompt, report.alias("response"))
