"""Invariants of joins, samples, splits, chats and gates, also with one key that dominates."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.checks import proxies
from fieldledger.operators import chat, history, clean, compare, enrich, joins, profile, quality, splits
from fieldledger.sources import readers, writers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def hot_facts(spark):
    """Half of the rows share one key; some keys are not in the dimension."""
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
    return spark.range(4000, numPartitions=8).select(key.alias("k"), F.col("id"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_broadcast_join(spark, hot_facts, how):
    dimension = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 3)], "k string, n int")
    small = joins.join_dimension(hot_facts, dimension, ["k"], how)
    large = joins.join_dimension(hot_facts, dimension, ["k"], how, max_rows=3)
    assert "Broadcast" in small._jdf.queryExecution().toString()
    assert rows_of(small) == rows_of(large)
    if how == "left":
        assert large.count() == hot_facts.count()


def test_salted_join_spreads_the_hot_key(spark, hot_facts):
    dimension = spark.createDataFrame([("hot", 1)], "k string, n int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.salted_join(hot_facts, dimension, ["k"], "inner", salts=8)
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert parts > 1


def test_salted_join_spreads_facts_that_lie_with_their_key(spark, hot_facts):
    dealt = hot_facts.repartition(16, "k")
    salted = joins.salted_join(dealt, spark.createDataFrame([("hot", 1)], "k string, n int"), ["k"], "inner", salts=8)
    facts = dealt.filter("k = 'hot'").select(F.pmod(F.xxhash64("k", "id") + F.spark_partition_id(), F.lit(8)).alias("s"))
    assert salted.count() == 2000
    assert max(r["count"] for r in facts.groupBy("s").count().collect()) < 400


def test_is_small_looks_at_rows_and_bytes(spark):
    assert joins.is_small(spark.range(5).toDF("a"), 5)
    assert not joins.is_small(spark.range(6).toDF("a"), 5)
    assert not joins.is_small(spark.range(2).select(F.repeat(F.lit("x"), 1000)), 5, max_bytes=500)


def test_activity_is_counted_before_the_lookup(spark):
    codes = ["USA"] * 300 + ["usa"] * 20 + ["FRA"] * 5 + ["ZZZ"] * 7
    rows = spark.createDataFrame([(2015, code) for code in codes], "g_year int, g_code string")
    got = rows_of(enrich.activity_by_year_country(rows, readers.lookup_table(spark)))
    assert got == [(2015, "France", 5), (2015, "United States", 320)]


def test_lookup_holds_every_country_once(spark):
    assert len(fv.COUNTRY_NAMES) == 83 == len(set(fv.COUNTRY_NAMES.values()))
    assert readers.lookup_table(spark).count() == 83


def test_lookup_from_table_has_one_row_per_code(spark):
    table = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", "z")], "code string, name string")
    assert rows_of(readers.lookup_from_table(table, "code", "name")) == [("A", "x"), ("B", "z")]


def test_enrich_keeps_every_incident(spark):
    incidents = spark.createDataFrame([(2015, "A"), (2015, "A"), (2016, "A"), (2015, "B")], "year int, country string")
    activity = spark.createDataFrame([(2015, "A", 7)], "g_year int, g_country string, evt_count bigint")
    enriched = enrich.enrich_left(incidents, activity)
    assert rows_of(enriched) == [(2015, "A", 7), (2015, "A", 7), (2015, "B", 0), (2016, "A", 0)]
    assert tuple(enrich.match_rate(enriched).first()) == (2, 4, 50)
    assert tuple(enrich.match_rate(enriched.filter("false")).first()) == (0, 0, 0)


def smallest(rows, limit, seed=42):
    def key(row):
        text = "\x1f".join("\\N" if v is None else str(v) for v in row)
        return hashlib.md5(f"{seed}:{text}".encode()).hexdigest(), [repr(v) for v in row]

    return sorted(sorted(rows, key=key)[:limit], key=repr)


@pytest.mark.parametrize("limit", [1, 10, 333, 999, 1000, 5000])
def test_bounded_sample_is_the_smallest_hashes(spark, limit):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(700)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "a string, n bigint")
    expected = smallest(rows, limit)
    assert rows_of(splits.bounded_sample(df, limit)) == expected
    assert rows_of(splits.bounded_sample(df.repartition(5, "n"), limit)) == expected


@pytest.mark.parametrize("limit", [5, 4000, 9000, 9990, 20000])
def test_bounded_sample_with_copies(spark, limit):
    rows = [("hot", 1)] * 9000 + [(f"r{i}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a string, n bigint").repartition(6)
    assert rows_of(splits.bounded_sample(df, limit)) == smallest(rows, limit)


def test_bounded_sample_of_zero_is_everything(spark):
    df = spark.range(10)
    assert splits.bounded_sample(df, 0) is df


def test_hash_split_does_not_depend_on_partitions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
    once = rows_of(splits.hash_split(docs, ["doc_id"]))
    assert once == rows_of(splits.hash_split(docs.repartition(13), ["doc_id"]))
    assert len(once) == docs.count()


def test_hash_split_counts_on_known_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = {r.split: r.n_rows for r in profile.split_counts(splits.hash_split(docs, ["doc_id"])).collect()}
    assert counts == {"train": 803, "val": 93, "test": 104}


def test_hash_split_with_other_fractions(spark):
    tagged = splits.hash_split(spark.range(5000), ["id"], {"a": 0.5, "b": 0.5}, seed=1)
    counts = {r.split: r.n_rows for r in profile.split_counts(tagged, splits=()).collect()}
    assert set(counts) == {"a", "b"} and abs(counts["a"] - 2500) < 200
    assert splits.hash_split(spark.range(3), ["id"], {"all": 1.0}).select("split").distinct().collect()[0][0] == "all"


def test_conversation_texts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f" m{t} ") for t in range(3000)]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    (whole,) = chat.chat_render_multi_turn(messages, generation_prompt=True).collect()
    assert (whole.n_turns, whole.n_filled) == (3000, 0)
    assert whole.text.startswith("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nm0<|eot_id|>")
    assert whole.text.endswith("m2999<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")
    pieces = chat.chat_render_messages(messages).orderBy("turn").collect()
    assert "<|begin_of_text|>" + "".join(p.piece for p in pieces) == chat.chat_render_multi_turn(messages).first().text


def test_messages_without_text_or_role_stay(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "a"), (1, 3, None, "x")]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (whole,) = chat.chat_render_multi_turn(messages).collect()
    assert (whole.n_turns, whole.n_filled, whole.text.count("<|eot_id|>")) == (4, 2, 4)
    assert "user<|end_header_id|>\n\n<|eot_id|>" in whole.text and "unknown<|end_header_id|>\n\nx" in whole.text


def test_copies_of_messages_do_not_multiply(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "open")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    once, often = spark.createDataFrame(rows, schema), spark.createDataFrame(rows * 50, schema).repartition(6)
    assert rows_of(chat.chat_render_multi_turn(often)) == rows_of(chat.chat_render_multi_turn(once))
    assert rows_of(chat.sft_pairs(often)) == rows_of(chat.sft_pairs(once)) == [(1, 0, "q", "a", 1, 1)]


def test_prompts_have_system_and_history(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "r"), (1, 3, "user", "t"), (1, 4, "assistant", "b")]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = chat.sft_pairs(messages)
    assert rows_of(pairs) == [(1, 1, "q", "a", 1, 1), (1, 3, "r", "b", 2, 1)]
    (last,) = history.sft_prompts(pairs.filter("turn = 3"), messages).collect()
    assert [last.messages_text.count(f"\n\n{x}<|eot_id|>") for x in "sqarb"] == [1, 1, 1, 1, 0]
    assert last.messages_text.endswith("assistant<|end_header_id|>\n\n") and last.response == "b"


def test_chat_record_without_system_and_input(spark):
    bare = spark.createDataFrame([("ask", "answer")], "instruction string, output string")
    assert chat.chat_render_single(bare, default_system="S").first().text == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\nS<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\nask<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\nanswer<|eot_id|>"
    )


def test_compare_folds_repeated_prompts(spark):
    base = spark.createDataFrame([("p", f"answer {i}") for i in range(300)], "prompt_id string, response string")
    tuned = spark.createDataFrame([("p", "one two three")] * 200 + [("q", "x")], "prompt_id string, response string")
    row, other = compare.paired_response_compare(base, tuned).orderBy("prompt_id").collect()
    assert (other.answered_by, other.base_n, other.tuned_n, other.words_delta) == ("tuned", 0, 1, None)
    assert row.answered_by == "both"
    assert (row.base_n, row.tuned_n, row.base_words, row.tuned_words, row.words_delta) == (300, 200, 2.0, 3.0, 1.0)


def test_gates(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    with pytest.raises(quality.EmptyStageError):
        quality.non_empty_gate(empty, "stage")
    with pytest.raises(quality.MissingColumnsError, match="iyear"):
        quality.schema_presence_report(empty)
    with pytest.raises(quality.MissingColumnsError):
        quality.required_fields_gate(empty)
    with pytest.raises(quality.MissingColumnsError):
        quality.min_column_count_gate(quality.width_distribution(spark.createDataFrame([("a\tb",)], "value string")))
    mixed = spark.createDataFrame([("a\tb",), ("\t" * 7,), ("\t" * 7,)], "value string")
    widths = quality.min_column_count_gate(quality.width_distribution(mixed))
    assert rows_of(widths) == [(2, 1, False), (8, 2, True)]
    names = [name for name, new in fv.INCIDENT_COLUMNS.items() if new != "summary"]
    schema = ", ".join(f"{name} string" for name in names)
    table = spark.createDataFrame([("1970", *names[1:]), (None, *names[1:])], schema)
    got = {r["column"]: (r.required, r.present, r.n_filled) for r in quality.schema_presence_report(table).collect()}
    assert got["iyear"] == (True, True, 1) and got["summary"] == (False, False, 0)
    header = quality.schema_presence_report(table, count_filled=False)
    assert [tuple(r) for r in header.collect()][0] == ("iyear", "year", True, True)
    with pytest.raises(quality.MissingColumnsError, match="nkill"):
        quality.schema_presence_report(table.drop("nkill"))


def test_csv_with_quoted_line_feed(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('iyear,summary\n1970,"two\nlines"\n1971,"say ""hi"""\n1972,""\n', "utf-8")
    whole = readers.scan_headered_csv(spark, str(path), multiline=True).collect()
    assert [tuple(r) for r in whole] == [("1970", "two\nlines"), ("1971", 'say "hi"'), ("1972", None)]
    assert readers.scan_headered_csv(spark, str(path)).count() == 4


def test_tsv_has_the_given_width(spark, tmp_path):
    (tmp_path / "2015.csv").write_text("1\t20150101\tx\n" + "\t".join("abcdefghij") + "\n", "utf-8")
    (tmp_path / "2014.csv").write_text("never\n", "utf-8")
    scan = readers.scan_positional_tsv(spark, readers.year_globs(str(tmp_path), [2015]), 8)
    assert rows_of(scan.select("_c0", "_c7")) == [("1", None), ("a", "h")]
    assert all("2014" not in name for name in scan.inputFiles())


def test_part_files_fall_back_to_all_files(spark, tmp_path):
    (tmp_path / "train.txt").write_text("a\nb\n", "utf-8")
    assert readers.scan_part_files(spark, str(tmp_path)).count() == 2
    (tmp_path / "part-00000").write_text("c\n", "utf-8")
    assert [r.value for r in readers.scan_part_files(spark, str(tmp_path)).collect()] == ["c"]


def test_split_folders_and_readback(spark, tmp_path):
    rows = [('{"instruction": "i", "output": "%s"}' % ("x" * 200), "train")] * 50 + [("junk", "val")]
    lines = spark.createDataFrame(rows, "value string, split string").repartition(4)
    writers.sink_jsonl_splits(lines, str(tmp_path), files_per_split=1)
    assert len(list(tmp_path.glob("v0*/split=train/part-*"))) == 1
    got = {r.split: r for r in writers.sink_verify_readback(spark, str(tmp_path)).collect()}
    assert (got["train"].n_records, got["train"].n_unparsed, got["train"].output_preview) == (50, 0, "x" * 120)
    assert (got["val"].n_records, got["val"].n_unparsed) == (1, 1)
    assert got["test"].n_records == 0
    nothing = writers.sink_verify_readback(spark, str(tmp_path / "absent")).collect()
    assert [r.n_records for r in nothing] == [0, 0, 0]


def test_broken_json_line_is_kept_beside(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"instruction": "i", "output": "o"}\njunk\n', "utf-8")
    got = rows_of(readers.scan_jsonl_records(spark, str(tmp_path)))
    assert got == [(None, "i", None, "o", None), (None, None, None, None, "junk")]


def test_lines_that_are_no_records_are_kept_beside(spark, tmp_path):
    bad = ['{"instruction": "i", "output": "o"} trailing', '[{"instruction": "i"}, {"output": "o"}]', "5", '{"instruction": {"a": 1}, "output": "o"}', '{"instruction": null, "output": "o"}']
    good = ['{"output": "o"}', '{"instruction": "i", "output": "o", "system": "s", "input": ""}']
    (tmp_path / "a.jsonl").write_text("\n".join(bad + good) + "\n", "utf-8")
    got = rows_of(readers.scan_jsonl_records(spark, str(tmp_path)).filter("_corrupt_record is null"))
    assert got == sorted([(None, "", None, "o", None), ("s", "i", "", "o", None)], key=repr)
    report = quality.corrupt_record_report(spark.read.text(str(tmp_path)))
    assert sum(r.n_rows for r in report.collect() if r.kind in ("ok", "no_label")) == len(good)


def test_only_a_missing_split_is_skipped(spark, tmp_path):
    found, report = readers.scan_text_lines(spark, str(tmp_path), ["train"])
    assert not found and rows_of(report) == [("train", False)]
    with pytest.raises(Exception, match="DATASOURCE|scheme|FileSystem"):
        readers.scan_text_lines(spark, "nosuchscheme://x", ["train"])


def test_two_names_of_one_code_are_an_error(spark):
    table = spark.createDataFrame([("A", "x"), ("A", "y")], "code string, name string")
    with pytest.raises(Exception, match="two names of code A"):
        readers.lookup_from_table(table, "code", "name").collect()


def test_log_lines_with_null_and_other_values(spark):
    lines = ['{"step": 1, "loss": 0.5}', '{"step": 2, "loss": null}', '{"step": 3, "loss": "x"}', '{"step": 4}', "junk"]
    got = rows_of(clean.records_having_key(spark.createDataFrame([(x,) for x in lines], "value string")))
    assert got == [(1, 0.5, True), (2, None, False), (3, None, False)]


def test_histogram_holds_every_row(spark):
    lengths = spark.createDataFrame([(n,) for n in (0, 24, 25, 799, 800, 801, 5000)], "token_len int")
    bins = profile.token_length_histogram(lengths).orderBy("bin").collect()
    assert sum(b.n_rows for b in bins) == 7
    assert (bins[31].n_rows, bins[32].from_len, bins[32].to_len, bins[32].n_rows) == (2, 800, None, 2)
    with pytest.raises(ValueError, match="multiple"):
        profile.token_length_histogram(lengths, cap=810)


def test_empty_splits_have_rows(spark):
    rows = spark.createDataFrame([("train",)] * 5, "split string")
    assert rows_of(profile.split_shares(rows)) == [("test", 0, "0%"), ("train", 5, "100%"), ("val", 0, "0%")]
    assert {r.split: r.n_rows for r in profile.estimated_split_sizes(rows).collect()} == {"train": 5, "val": 0, "test": 0}
    assert {r.split: r.effective_epochs for r in profile.training_schedule(rows).collect()}["val"] is None


def test_fine_fractions_are_refused(spark):
    with pytest.raises(ValueError, match="whole parts"):
        splits.hash_split(spark.range(3), ["id"], {"a": 0.99999, "b": 0.00001})


def test_random_split_is_one_narrow_pass(spark):
    drawn = splits.random_split(spark.range(20_000, numPartitions=4))
    plan = drawn._jdf.queryExecution().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    counts = {r.split: r["count"] for r in drawn.groupBy("split").count().collect()}
    assert abs(counts["train"] - 16_000) < 400 and abs(counts["val"] - 2000) < 300


@pytest.mark.parametrize("copies", [1, 4096, 4097, 9000])
def test_drawn_split_does_not_hang_on_partitioning(spark, copies):
    rows = [("hot", 1)] * copies + [(None, i % 50) for i in range(300)] + [(f"r{i}", None) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, n bigint")
    first, *others = [rows_of(splits.drawn_split(df.repartition(n))) for n in (1, 3, 50)]
    assert all(other == first for other in others)

    def bucket(a, n, number):
        key = "\x1f".join("\\N" if x is None else str(x) for x in (a, n, number))
        return int(hashlib.md5(f"{fv.SEED}:{key}".encode()).hexdigest()[:8], 16) % 10_000

    seen, expected = {}, []
    for row in rows:
        seen[row] = seen.get(row, 0) + 1
        drawn = bucket(*row, seen[row])
        expected.append((*row, "train" if drawn < 8000 else "val" if drawn < 9000 else "test"))
    assert first == sorted(expected, key=repr)


def test_drawn_split_of_nothing(spark):
    assert splits.drawn_split(spark.createDataFrame([], "a string")).collect() == []


def test_drawn_split_counts_copies_before_the_shuffle(spark):
    plan = splits.drawn_split(spark.range(10).selectExpr("id % 2 as id"))._jdf.queryExecution().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_cleaning_flags_agree_with_cleaning(spark, folder):
    raw = proxies.incidents_raw(spark, folder)
    flags = clean.cleaning_flags(raw)
    row = raw.agg(*[F.count_if(c).alias(n) for n, c in flags.items()]).first()
    cleaned = clean.clean_incidents(raw)
    assert row.cleaned == cleaned.count()
    assert row.kills_replaced > 0 and row.wounds_replaced == 0


def test_persisted_is_released(spark):
    df = spark.range(10)
    with splits.persisted(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
