import math
import random
import re
from collections import Counter

import plain
import pytest
from fieldledger.llm import ranked
from fieldledger.llm.queries import QUERIES
from fieldledger.llm.ranked import ranked_documents


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def plain_search(docs, items, top=10):
    """(item, rank, doc, score), by scoring every document for every item."""
    counted = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    total = sum(n > 0 for _, _, n in counted)
    length = sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for i, text in items:
        asked = dict.fromkeys(terms(text))
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in asked}
        scored = []
        for d, c, n in counted:
            m = 10 + (90 * n * total) // max(1, length)
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items() if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3]))


def test_query_against_all_scores(spark, folder):
    read = lambda n: spark.read.parquet(f"{folder}/{n}.parquet").collect()
    docs = [(r.doc_id, r.text) for r in read("documents")]
    items = [(r.item_id, r.text) for r in read("benchmark")]
    found = QUERIES["op11_ranked_search"](spark, folder)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()]
    assert sorted(got) == sorted(plain_search(docs, items))
    assert len(got) > 5 * len(items)


@pytest.mark.parametrize(("cells", "leaf", "limit"), [(2_000_000, 1, 200_000), (60, 2, 40), (400, 128, 7)])
def test_sizes_of_blocks_do_not_matter(spark, monkeypatch, cells, leaf, limit):
    rng = random.Random(cells)
    monkeypatch.setattr(ranked, "CELLS", cells)
    monkeypatch.setattr(ranked, "ENTRIES", cells)
    monkeypatch.setattr(ranked, "LEAF", leaf)
    letters = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(letters, k=rng.randint(0, 30)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]
    items = [(i, " ".join(rng.choices(letters, k=rng.randint(1, 12)))) for i in range(12)]
    items.append((99, " ".join(dict.fromkeys(letters))))
    tables = [spark.createDataFrame(x, f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id"))]
    got = ranked_documents(tables[0].repartition(3), tables[1], terms=limit).collect()
    assert sorted(map(tuple, got)) == sorted(plain_search(docs, items))


def test_odd_rows(spark):
    rows = plain.odd_rows(random.Random(4))
    rows += [(30, "ÀÉ Σ x-y_z 0 É", "en"), (31, "Àé\x7fX\x00Y", "en"), (32, "ß" * 9, None)]
    asked = [(1, "x y z a É é"), (2, None), (3, " -_- "), (None, "on the 0"), (4, "À x"), (4, "À x")]
    items = spark.createDataFrame([(i, t, 1, "s") for i, t in asked], "item_id long, text string, score long, doc_id string")
    found = ranked_documents(plain.table(spark, rows), items).collect()
    want = plain_search([(r[0], r[1]) for r in rows], asked)
    assert order(map(tuple, found)) == order(want)
    empty = plain.table(spark, [])
    assert ranked_documents(empty, items).count() == 0
    assert ranked_documents(plain.table(spark, rows), items.limit(0)).count() == 0
    assert ranked_documents(plain.table(spark, rows), items.where("item_id = 2")).count() == 0
