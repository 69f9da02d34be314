"""What the memory of a task and of the driver depends on when tables grow."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldledger.checks import QUERIES, proxies, scans
from fieldledger.operators import joins, profile, records, splits
from fieldledger.scratch import scratch_path
from fieldledger.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_copies_of_a_large_dimension_are_not_broadcast(spark, how):
    facts = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    dimension = spark.range(7).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    joined = joins.join_dimension(facts, dimension, ["k"], how, max_rows=3)
    rows = joined.collect()
    assert "Broadcast" not in plan(joined)
    assert sorted((r.v, r.name) for r in rows) == [(i, str(i % 7)) for i in range(100)]


def test_top_k_labels_joins_counts(spark, tmp_path):
    lines = [(1,), (1,), (2,), (None,), (9,)]
    parts = [(1, "a"), (1, "b"), (2, "b"), (3, "c"), (None, "d")]
    spark.createDataFrame(lines, "l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    top = QUERIES["top_k_labels"](spark, str(tmp_path))
    assert [tuple(r) for r in top.collect()] == [("b", 3), ("a", 2)]
    optimised = top._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in optimised.split("Join", 1)[1]


def test_spread_keeps_tasks_to_a_number_of_rows(spark):
    rows = spark.range(1000)
    assert readers.spread(rows, None, 1000) is rows
    for n, per_task, parts in ((1000, 100, 10), (1000, 300, 4), (0, 100, 3), (1000, 10_000, 3)):
        spread = readers.spread(rows, 3, n, per_task)
        assert spread.groupBy(F.spark_partition_id()).count().count() == parts


def test_incidents_get_more_tasks_as_they_grow(spark, folder, monkeypatch):
    n = proxies.table(spark, folder, "lineitem").count()
    monkeypatch.setattr(readers.spread, "__defaults__", (0, -(-n // 20)))
    assert "RoundRobinPartitioning(20)" in plan(proxies.incidents_raw(spark, folder))


LINES = [
    ('{"instruction":"a b","output":"R — X Y | z\\nc"}', "train"),
    ('{"instruction":"a","output":1}', "train"),
    ('{"output":"no mark"}', "val"),
    ("[1]", "val"),
    ("no json", "test"),
    (None, "test"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return records.profile_rows(spark.createDataFrame(LINES, "value string, split string"))


def test_balance_counts_no_words_and_gives_the_same(rows):
    balance, full = profile.profile_counts(rows, profile.BALANCE_KEYS), profile.profile_counts(rows)
    optimised = balance._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in full._jdf.queryExecution().optimizedPlan().toString()
    assert "x1c-" not in optimised and "parseJson" not in optimised
    for table in (profile.dataset_summary, lambda c: profile.label_balance(c.filter("parsed"), weight=profile.WEIGHT)):
        assert table(balance).collect() == table(full).collect()
    assert profile.dataset_summary(balance).first().n_parsed == 1


def test_an_object_is_not_parsed_again_to_see_whether_it_is_json(rows):
    assert sorted(r.kind for r in rows.select("kind").collect()) == ["no_label", "not_json", "not_json", "not_object", "not_text", "ok"]
    again = rows._jdf.queryExecution().optimizedPlan().toString().split("parseJson(")[1:]
    assert again and all('CASE WHEN NOT' in text[:60] for text in again)


def test_layout_is_left_out_where_it_is_no_key(rows):
    keys = [key for key in profile.PROFILE_KEYS if key != "has_layout"]
    some, every = (profile.profile_tables(profile.profile_counts(rows, k)) for k in (keys, profile.PROFILE_KEYS))
    assert set(every) - set(some) == {"layout"}
    for name in some:
        assert sorted(map(str, some[name].collect())) == sorted(map(str, every[name].collect())), name


def dealt_rows(df):
    return sorted(n for _, n in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("parts, first", [(24, 0), (1, 0), (24, 2300)])
def test_files_are_read_from_packed_folders_and_not_shuffled(spark, parts, first):
    text = F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("text")
    rows = spark.range(0, 2400, 1, parts).select("id", text).filter(F.col("id") >= first)
    dealt = splits.coalesce_output(rows, 3)
    assert "Exchange" not in plan(dealt)
    assert all(name.endswith(".zstd.parquet") for name in dealt.inputFiles())
    counts = dealt_rows(dealt)
    assert len(counts) == 3 and counts[-1] - counts[0] <= parts
    assert dealt.columns == rows.columns
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("name, value", [("_EVEN", 0), ("_FEW_FILES", 2)])
def test_uneven_folders_and_many_files_are_shuffled(spark, monkeypatch, name, value):
    monkeypatch.setattr(splits, name, value)
    rows = spark.range(0, 2400, 1, 24)
    dealt = splits.coalesce_output(rows, 3)
    assert "RoundRobinPartitioning(3)" in plan(dealt)
    assert dealt.columns == ["id"] and sorted(r.id for r in dealt.collect()) == list(range(2400))


def test_no_rows_and_no_number_of_files(spark):
    rows = spark.range(5)
    assert splits.coalesce_output(rows, None) is rows
    assert splits.coalesce_output(rows.filter("id < 0"), 3).collect() == []


def bare(df):
    return sorted(map(str, df.collect()))


def test_many_parts_are_joined_by_one_shuffle_of_the_lines(spark, folder, monkeypatch):
    sent = bare(proxies.incidents_raw(spark, folder))
    monkeypatch.setattr(proxies, "SENT_ROWS", proxies.table(spark, folder, "supplier").count())
    raw = proxies.incidents_raw(spark, folder)
    assert "RoundRobinPartitioning" not in plan(raw) and plan(raw).count("SortMergeJoin") == 1 + plan(raw).count("Initial Plan")
    assert bare(raw) == sent


def test_incidents_of_repeated_and_missing_keys(spark, tmp_path, monkeypatch):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    kinds = "l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate string"
    lines = [(p, s, q, d, "N", "O", t) for p in (1, 2, None) for s in (7, 8, None) for q, d, t in ((5.5, 0.07, "1996-01-02"), (None, None, None), (49.0, -0.03, "1997-01-02"))]
    made = spark.createDataFrame(lines, kinds).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    made.write.parquet(f"{tmp_path}/lineitem.parquet")
    write("supplier", [(7, 1), (7, 2), (8, None), (None, 1)], "s_suppkey bigint, s_nationkey int")
    write("nation", [(1, "A"), (2, "B"), (2, "C"), (None, "D")], "n_nationkey int, n_name string")
    write("part", [(1, "X", 5, "b"), (1, None, None, None), (2, "SMALL", 7, "c"), (None, "X", 1, "d")], "p_partkey bigint, p_type string, p_size int, p_brand string")
    sent = bare(proxies.incidents_raw(spark, str(tmp_path)))
    assert len(sent) == 27
    monkeypatch.setattr(proxies, "SENT_ROWS", 0)
    assert bare(proxies.incidents_raw(spark, str(tmp_path))) == sent


def test_queries_write_packed_lines(spark, folder, monkeypatch):
    made = []
    monkeypatch.setattr(scans, "scratch_path", lambda s, name: made.append(path := scratch_path(s, name)) or path)
    for key in ("sink_jsonl_splits", "sink_verify_readback", "scan_part_files", "scan_text_lines", "sink_jsonl_partitioned"):
        assert QUERIES[key](spark, folder).collect()
    files = [f for path in made for f in Path(path).rglob("part-*") if "split=" in str(f)]
    assert len(made) == 5 and files and all(f.name.endswith(".txt.gz") for f in files)


def test_sinks_sort_no_lines_and_leave_the_setting(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    lines = spark.range(0, 900, 1, 1).select(F.col("id").cast("string").alias("value"), (F.col("id") % 30).cast("string").alias("split"))
    writers.sink_jsonl_partitioned(lines, f"{tmp_path}/many", compression="gzip")
    few = lines.filter("split in ('0', '1', '2')")
    writers.sink_jsonl_splits(few, f"{tmp_path}/few", ["0", "1", "2"], max_records_per_file=7)
    assert spark.conf.get(key) == "0"
    assert bare(spark.read.text(f"{tmp_path}/many")) == bare(lines.withColumn("split", F.col("split").cast("int")))
    assert bare(readers.scan_text_lines(spark, f"{tmp_path}/few", ["2"])[0]["2"]) == bare(few.filter("split = '2'").select("value"))
    spark.conf.set(key, "3")
    with writers._unsorted(spark):
        assert spark.conf.get(key) == "3"
    spark.conf.unset(key)
