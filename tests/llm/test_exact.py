import random
import re

import plain
from fieldledger.llm.exact import exact_dedup, exact_groups


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_random_texts_of_many_blocks(spark):
    rng = random.Random(1)
    base = [plain.syllables(rng, rng.randint(1, 30)) for _ in range(25)]
    # Equal blocks in other places, and texts that differ in the last byte only.
    base += [b + c for b, c in zip(base, reversed(base), strict=True)] + [b[:-1] + "z" for b in base]
    texts = [rng.choice(base).replace(" ", rng.choice([" ", "\n", " \t "])) for _ in range(300)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    first, size = {}, {}
    for i, t, _ in rows:
        first.setdefault(normal(t), i)
        size[normal(t)] = size.get(normal(t), 0) + 1
    found = exact_groups(plain.table(spark, rows), block=8).collect()
    assert len(found) == len(rows)
    for r in found:
        t = normal(texts[r.doc_id])
        assert (r.keep_id, r.group_size, r.kept) == (first[t], size[t], first[t] == r.doc_id)


def test_odd_rows(spark):
    rows = plain.odd_rows(random.Random(2))
    found = exact_groups(plain.table(spark, rows)).collect()
    assert len(found) == len(rows)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(normal(t), []).append(i)
    assert sum(r.kept for r in found) == len(groups)
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 10)}
    for ids in groups.values():
        least = min((i for i in ids if i is not None), default=None)
        for i in ids:
            if i in by_id:
                assert (by_id[i].keep_id, by_id[i].group_size) == (least, len(ids))
    docs = plain.table(spark, rows)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(normal(r.text) for r in kept.collect()) == sorted(groups)


def test_empty_table(spark):
    assert exact_groups(plain.table(spark, [])).count() == 0
    assert exact_dedup(plain.table(spark, [])).count() == 0
