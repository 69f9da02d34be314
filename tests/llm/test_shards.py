import random

import plain
import pytest
from fieldledger.llm.shards import shard_documents, write_shards


@pytest.mark.parametrize("limit", [400, 5_000, 10**9])
def test_shards_fit_and_only_large_ones_split(spark, limit):
    rows = [(i, t, "en") for i, t in enumerate(plain.random_texts(21, 200))]
    found = shard_documents(plain.table(spark, rows), limit=limit).collect()
    assert len(found) == len(rows)
    held = {}
    for r in found:
        assert len(r.shard) == r.depth
        held.setdefault(r.shard, []).append(len(rows[r.doc][1].encode()))
    sizes = {(r.shard, r.shard_bytes, r.shard_docs) for r in found}
    assert sizes == {(k, sum(v), len(v)) for k, v in held.items()}
    for name, own in held.items():
        assert sum(own) <= limit or len(own) == 1
        for depth in range(len(name)):
            above = [s for k, v in held.items() if k.startswith(name[:depth]) for s in v]
            assert sum(above) > limit and len(above) > 1


def test_many_equal_rows_and_odd_ones(spark, tmp_path):
    rows = [(1, "same text", "en")] * 300 + plain.odd_rows(random.Random(22))
    docs = plain.table(spark, rows)
    found = shard_documents(docs, limit=200).collect()
    assert len(found) == len(rows)
    assert all(r.shard_bytes <= 200 or r.shard_docs == 1 for r in found)
    write_shards(docs, str(tmp_path / "shards"), limit=200)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*docs.columns, "shard"}
    text = lambda rows: sorted((str(r[0]), str(r[1])) for r in rows)
    assert text(back.select("doc_id", "text").collect()) == text(rows)
    assert back.select("shard").distinct().count() == len({r.shard for r in found})


def test_empty_table(spark):
    assert shard_documents(plain.table(spark, [])).count() == 0
