"""Prompts with history against a plain version, with a conversation that holds a third of the messages."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fieldledger.operators import chat, compare, history

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def talks(rng):
    sizes = {1: 700, **{i: rng.randint(1, 30) for i in range(2, 90)}}
    rows = []
    for conv, n in sizes.items():
        turn = rng.randint(0, 5)
        for k in range(n):
            role = rng.choice(["user", "assistant", "system", None]) if rng.random() < 0.2 else ("user", "assistant")[k % 2]
            text = rng.choice([None, "", " x ", "é" * rng.randint(1, 40), f"m{conv}-{turn}"])
            rows.append((conv, turn, role, text))
            if rng.random() < 0.1:
                rows.append((conv, turn, rng.choice(["user", "assistant"]), f"other {turn}"))
            turn += 1 if rng.random() < 0.9 else rng.randint(2, 9)
    return rows + [(2, None, "user", "nowhere"), (None, 1, "user", "no one")] + rows[:50]


def plain_prompts(rows, max_turns=0, max_chars=0):
    def piece(role, text):
        return f"<|start_header_id|>{role or 'unknown'}<|end_header_id|>\n\n{(text or '').strip()}<|eot_id|>"

    places, sides = {}, {}
    for conv, turn, role, text in rows:
        if turn is None:
            continue
        key = (role is None or text is None, piece(role, text))
        places.setdefault(conv, {}).setdefault(turn, []).append(key)
        if text is not None and role in ("user", "assistant"):
            at = turn - (role == "assistant")
            sides.setdefault((conv, at), {"user": [], "assistant": []})[role].append(text)
    out = []
    for (conv, turn), both in sides.items():
        if conv is None or not both["user"] or not both["assistant"]:
            continue
        before = [min(places[conv][t])[1] for t in sorted(places[conv]) if t < turn]
        kept, chars = [], 0
        for k, text in enumerate(reversed(before), 1):
            chars += len(text)
            if (max_turns and k > max_turns) or (max_chars and chars > max_chars):
                break
            kept.insert(0, text)
        body = "".join(kept) + piece("user", min(both["user"]))
        text = f"<|begin_of_text|>{body}<|start_header_id|>assistant<|end_header_id|>\n\n"
        out.append((conv, turn, text, min(both["assistant"]), len(kept)))
    return sorted(out)


@pytest.mark.parametrize("bounds", [{}, {"max_turns": 1}, {"max_turns": 7}, {"max_chars": 300}, {"max_turns": 5, "max_chars": 200}, {"max_chars": 10}])
def test_prompts_of_a_large_conversation(spark, monkeypatch, bounds):
    monkeypatch.setattr(history, "BLOCK", 50)
    rows = talks(random.Random(7))
    messages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = history.sft_prompts(chat.sft_pairs(messages), messages, **bounds)
    assert sorted(tuple(r) for r in found.collect()) == plain_prompts(rows, **bounds)


def test_no_task_gets_a_conversation(spark):
    messages = spark.range(6000).select(
        F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.lit("some text").alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = history.numbered_places(messages)
        per_file = places.groupBy(F.input_file_name()).agg(F.count_if(F.col("conv_id") == 1).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in per_file) == 2000 and max(r.n for r in per_file) < 1500
    blocks = places.where("conv_id = 1").groupBy(F.floor(F.col("n_before") / 20)).count().collect()
    assert len(blocks) >= 100 and max(r["count"] for r in blocks) == 20


def test_a_place_with_very_many_texts_is_not_gathered(spark):
    messages = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("conv_id"), (F.col("id") % 2).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    pairs = chat.sft_pairs(messages)
    assert [tuple(r) for r in pairs.collect()] == [(1, 0, "0", "1", 2500, 2500)]
    assert "collect" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_nothing_to_prompt(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert history.sft_prompts(chat.sft_pairs(none), none).count() == 0
    assert history.sft_prompts(chat.sft_pairs(none), none, max_turns=3).count() == 0


def test_responses_are_paired_by_their_number(spark):
    rng = random.Random(3)
    schema = "prompt_id string, response string"
    sides = []
    for _ in range(2):
        rows = [("hot", f"r{rng.randint(0, 400)}") for _ in range(900)] + [("copies", "same")] * 300
        rows += [(rng.choice("abcde"), rng.choice(["x", "y", "", None])) for _ in range(20)] + [(None, "z"), ("hot", None)]
        sides.append(rows)
    sides[1] += [("only", "tuned"), ("only", "tuned too")]
    tables = [spark.createDataFrame(rows, schema).repartition(3) for rows in sides]
    found = compare.paired_response_rows(*tables).collect()
    numbered = []
    for rows in sides:
        by_prompt = {}
        for prompt, response in rows:
            by_prompt.setdefault(prompt, set()).add(response)
        digest = lambda r: hashlib.md5((r or "").encode()).hexdigest()
        numbered.append({(p, i): r for p, rs in by_prompt.items() for i, r in enumerate(sorted(rs, key=lambda r: (digest(r), r is not None, r or "")), 1)})
    keys = numbered[0].keys() | numbered[1].keys()
    assert {(r.prompt_id, r.ordinal) for r in found} == keys and len(found) == len(keys)
    for r in found:
        key = (r.prompt_id, r.ordinal)
        both = [key in side for side in numbered]
        assert r.answered_by == {(True, True): "both", (True, False): "base", (False, True): "tuned"}[tuple(both)]
        assert (r.base_response, r.tuned_response) == (numbered[0].get(key), numbered[1].get(key))
    copies = [r for r in found if r.prompt_id == "copies"]
    assert [(r.base_copies, r.tuned_copies, r.words_delta) for r in copies] == [(300, 300, 0)]
