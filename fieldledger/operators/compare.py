"""Two sets of responses to the same prompts, side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.functions.report import ReportTemplate
from fieldledger.functions.text import word_count
from fieldledger.operators.quality import layout_flags


def _per_prompt(responses: DataFrame, prefix: str, template: ReportTemplate) -> DataFrame:
    measured = responses.select(
        "prompt_id",
        "response",
        word_count(F.col("response")).alias("words"),
        layout_flags(F.col("response"), template)["has_layout"].alias("layout"),
    )
    return measured.groupBy("prompt_id").agg(
        F.count("*").alias(f"{prefix}_n"),
        F.min("response").alias(f"{prefix}_response"),
        F.avg("words").alias(f"{prefix}_words"),
        F.count_if("layout").alias(f"{prefix}_layout"),
    )


def paired_response_compare(
    base: DataFrame, tuned: DataFrame, template: ReportTemplate = ReportTemplate()
) -> DataFrame:
    """Per prompt: the responses `(prompt_id, response)` of both sides and their measures.

    Each side is first folded to one row per prompt, which shows how many
    responses it had, their mean length, how many have the report layout, and
    the first of them. So a prompt that is repeated on both sides never makes
    pairs of all its responses. A prompt that only one side answered has count 0 and
    no measures on the other, and no delta.
    """
    left, right = _per_prompt(base, "base", template), _per_prompt(tuned, "tuned", template)
    both = left.join(right, "prompt_id", "full")
    return both.fillna(0, ["base_n", "tuned_n", "base_layout", "tuned_layout"]).withColumns(
        {
            "words_delta": F.col("tuned_words") - F.col("base_words"),
            "answered_by": F.when(F.col("base_n") == 0, "tuned").when(F.col("tuned_n") == 0, "base").otherwise("both"),
        }
    )


def numbered_responses(responses: DataFrame) -> DataFrame:
    """(prompt_id, ordinal, response, copies): the different responses of each prompt, from 1.

    The order is that of the content's hash. No prompt is gathered: equal responses are
    folded where they lie, the responses of a prompt fall into 4,096 buckets by their
    hash, and a number is that within the bucket behind the sizes of earlier buckets.
    """
    keyed = responses.groupBy("prompt_id", "response").agg(F.count("*").alias("copies"))
    hashed = F.md5(F.coalesce("response", F.lit(""))).alias("hash")
    keyed = keyed.select("*", hashed).withColumn("bucket", F.substring("hash", 1, 3))
    within = Window.partitionBy("prompt_id", "bucket").orderBy("hash", "response")
    placed = keyed.withColumn("place", F.row_number().over(within))
    sizes = keyed.groupBy(F.col("prompt_id").alias("of"), F.col("bucket").alias("in")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("of").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("of", "in", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    same = F.col("prompt_id").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in"))
    ordinal = (F.col("base") + F.col("place")).alias("ordinal")
    return placed.join(bases, same).select("prompt_id", ordinal, "response", "copies")


def paired_response_rows(
    base: DataFrame, tuned: DataFrame, template: ReportTemplate = ReportTemplate()
) -> DataFrame:
    """All different responses of both sides, the first of a prompt beside the first, and so on.

    Responses are numbered by `numbered_responses` on each side, so the pairing does not
    hang on any order of the input, and a prompt with many responses on both sides makes
    no more rows than the longer side has. A response without a partner has
    `answered_by` of its side and no measures on the other. Measures are words, whether
    it has the report layout, and how many copies of it there were.
    """

    def side(responses: DataFrame, prefix: str) -> DataFrame:
        given = F.lit(True).alias(f"{prefix}_given")
        return numbered_responses(responses).select(
            F.col("prompt_id").alias(f"{prefix}_prompt"),
            F.col("ordinal").alias(f"{prefix}_ordinal"),
            F.col("response").alias(f"{prefix}_response"),
            F.col("copies").alias(f"{prefix}_copies"),
            word_count(F.col("response")).alias(f"{prefix}_words"),
            layout_flags(F.col("response"), template)["has_layout"].alias(f"{prefix}_layout"),
            given,
        )

    left, right = side(base, "base"), side(tuned, "tuned")
    same = F.col("base_prompt").eqNullSafe(F.col("tuned_prompt")) & (F.col("base_ordinal") == F.col("tuned_ordinal"))
    kept = [f"{p}_{name}" for p in ("base", "tuned") for name in ("response", "copies", "words", "layout")]
    answered = F.when(F.col("base_given").isNull(), "tuned").when(F.col("tuned_given").isNull(), "base")
    return left.join(right, same, "full").select(
        F.coalesce("base_prompt", "tuned_prompt").alias("prompt_id"),
        F.coalesce("base_ordinal", "tuned_ordinal").alias("ordinal"),
        *kept,
        (F.col("tuned_words") - F.col("base_words")).alias("words_delta"),
        answered.otherwise("both").alias("answered_by"),
    )
