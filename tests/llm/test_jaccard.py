import random
from collections import Counter

import numpy as np
import plain
import pytest
from fieldledger.llm.jaccard import Index, bands, drop_near_copies, heap_merge, jaccard_components, part_digests


def parts_by_band(n, share):
    return {band: parts for band, parts, _ in bands(n, share)}


def test_pairs_that_may_link_meet_in_a_band():
    for share in (80, 90):
        for n in range(1, 400):
            mine = parts_by_band(n, share)
            for m in range(n, n * 100 // share + 1):
                both = [k for k in mine if k in parts_by_band(m, share)]
                apart = (100 - share) * (n + m) // (100 + share)
                assert any(mine[k] > apart for k in both), (n, m)


def test_linked_sets_share_a_digest():
    rng = np.random.default_rng(31)
    for share in (80, 90):
        for n in [*range(5, 60), 100, 180, 260, 400, 900]:
            for _ in range(12):
                x = rng.integers(0, 2**63, n).astype(np.uint64)
                # As many differences as a link allows, in any way between the two.
                apart = (100 - share) * n // share
                gone = int(rng.integers(0, apart + 1))
                come = 0
                while 100 * (n - gone) >= share * (n + come + 1):
                    come += 1
                if 100 * (n - gone) < share * (n + come):
                    continue
                y = np.concatenate((x[gone:], rng.integers(0, 2**63, come).astype(np.uint64)))
                both = [part_digests(np.unique(s), share) for s in (x, y)]
                equal = gone == come == 0
                assert equal or len(np.intersect1d(*both)), (share, n, gone, come)


def test_heap_merge_counts():
    rng = random.Random(7)
    for _ in range(200):
        lists = [np.array(sorted(rng.sample(range(30), rng.randint(0, 12)))) for _ in range(rng.randint(1, 8))]
        least = rng.randint(1, 5)
        counts = Counter(x for y in lists for x in y.tolist())
        assert heap_merge(lists, least) == {k: v for k, v in counts.items() if v >= least}


def test_search_finds_all_links():
    rng = np.random.default_rng(8)
    base = [rng.integers(0, 60, rng.integers(1, 40)) for _ in range(12)]
    sets = [np.unique(np.where(rng.random(len(b)) < 0.06, 99, b)).astype(np.uint64) for b in base for _ in range(8)]
    for share in (50, 80, 90):
        index = Index(sets, share)
        for x in sets:
            want = [j for j, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= share * len(np.union1d(x, y))]
            assert sorted(index.linked(x)) == want


def check(spark, rows, words, share, **options):
    sets = [plain.grams(t, words) for _, t, _ in rows]
    root = plain.components(plain.linked(sets, share), range(len(rows)))
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if sets[k]:
            least.setdefault(root[k], []).append(i)
    want = sorted(
        (str(i), len(s), str(min((x for x in least[root[k]] if x is not None), default=None) if s else i))
        for k, ((i, _, _), s) in enumerate(zip(rows, sets, strict=True))
    )
    docs = plain.table(spark, rows)
    found = jaccard_components(docs, words=words, share=share, **options).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == want
    assert sum(r.kept for r in found) == len(least) + sum(not s for s in sets)


@pytest.mark.parametrize(("words", "share", "size"), [(3, 90, 2_000_000), (2, 80, 60)])
def test_random_texts(spark, words, share, size):
    rows = [(i, t, "en") for i, t in enumerate(plain.random_texts(size, 220))]
    check(spark, rows, words, share, shard_grams=size)


def test_odd_rows(spark):
    rows = plain.odd_rows(random.Random(11))
    check(spark, rows, 3, 90)
    docs = plain.table(spark, rows)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 5, 7, 11, 12}


def test_empty_table(spark):
    assert jaccard_components(plain.table(spark, [])).count() == 0
