"""Physical plans: no Python workers, joins and limits as intended, narrow scans."""

import pytest

from fieldledger.checks import QUERIES, aggregates, proxies
from fieldledger.operators import records, splits


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


#: Scans of a test table or of files, for queries that once read one table several times.
SCANS = {
    "non_empty_gate": 5, "stage_counts": 3, "split_shares": 1, "estimated_split_sizes": 1, "training_schedule": 1,
    "max_length_check": 1, "union_splits": 3, "fill_missing_count": 5, "drop_join_keys": 5, "chat_render_multi_turn_prompted": 1,
    "sft_pairs": 1, "sink_jsonl_splits": 3, "scan_jsonl_records": 1,
}


@pytest.mark.parametrize("key", list(QUERIES))
def test_no_python_and_no_cross_join(spark, folder, key):
    text = plan(QUERIES[key](spark, folder))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    if key in SCANS:
        scans = sum(" Scan " in line or "BatchScan" in line for line in text.split("== Physical Plan ==")[1].split("\n\n")[0].splitlines())
        assert scans <= SCANS[key], f"{scans} scans"


def test_enrichment_broadcasts_the_activity(spark, folder):
    text = plan(QUERIES["enrich_left_broadcast"](spark, folder))
    assert "BroadcastHashJoin LeftOuter BuildRight" in text and "SortMergeJoin" not in text


def test_lookup_is_broadcast(spark, folder):
    assert "BroadcastHashJoin Inner BuildRight" in plan(QUERIES["code_lookup_join"](spark, folder))


def test_top_k_is_not_a_sort(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k_labels"](spark, folder))


def test_scan_reads_only_its_columns(spark, folder):
    text = plan(proxies.activity(spark, folder))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp" in text
    assert "o_totalprice" not in text


def test_split_and_formatting_do_not_shuffle(spark, folder):
    enriched = proxies.enriched(spark, folder)
    before = plan(enriched).count("Exchange")
    assert plan(splits.hash_split(records.format_incident_records(enriched), proxies.LINE_KEY)).count("Exchange") == before


def test_each_line_is_parsed_once(spark, folder):
    lines = proxies.damaged_lines(spark, folder).selectExpr("value", "'train' as split")
    assert plan(records.profile_rows(lines)).count("from_json") == 1


def test_profile_tables_come_from_counts(spark, folder):
    counts = aggregates.profile_counts(spark, folder)
    assert "from_json" not in plan(counts)
